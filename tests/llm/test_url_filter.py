import random

from panelwise.llm import url_filter as U

RULES = [("net", "/", "block"), ("example.net", "/en/", "allow"), ("b.example.net", "/", "block"), ("example.com", "/de/x", "block"), ("org", "", "Block"), ("a.org", None, "allow"), ("Up.Case", "/", "block"), (None, "/", "block"), ("x.y", "/", None), ("net", "/", "block"), ("tie.com", "/aa/", "allow"), ("a.tie.com", "/", "block"), ("deep.com", "/1/2/3/4/5/", "block")]


def judge(url):
    host = path = ""
    if url and "://" in url:
        rest = url.split("://", 1)[1]
        cut = min([rest.find(c) for c in "/?#" if c in rest] or [len(rest)])
        host = "".join(c.lower() if "A" <= c <= "Z" else c for c in rest[:cut])
        rest = rest[cut:]
        path = rest[: min([rest.find(c) for c in "?#" if c in rest] or [len(rest)])]
    best = None
    for h, p, v in RULES:
        if not h or not v:
            continue
        h, p, v = h.lower(), p or "", v.lower()
        if (host == h or host.endswith("." + h)) and path.startswith(p):
            best = max(best or (0,), (len(h) + len(p), len(h), v == "block", h + p, v))
    return (host, path, best[3], best[4]) if best else (host, path, None, "allow")


def test_against_all_rules(spark):
    r = random.Random(1)
    hosts = ["example.net", "b.example.net", "c.b.example.net", "EXAMPLE.com", "xexample.com", "a.org", "b.org", "org", "up.case", "x.y", "a.tie.com", "deep.com", "", ".net", "net.", "h:80"]
    paths = ["", "/", "/en/", "/en", "/EN/", "/en/1", "/de/x", "/de/xy/z", "/de/", "/aa/b", "/1/2/3/4/5/6/7", "//", "/é/?x=/en/", "?q", "#f/en/", "/" * 3000]
    urls = [r.choice(["http://", "https://", "", "x://y://"]) + r.choice(hosts) + r.choice(paths) for _ in range(600)] + [None, "", "no scheme", "http://net/\n/x"] + ["http://net/hot"] * 500
    pages = spark.createDataFrame([(i, u, "p", "h", 1) for i, u in enumerate(urls)], "page_id long, url string, path string, Host string, prefix int")
    got = U.judge_urls(pages, spark.createDataFrame(RULES, "host string, path string, verdict string")).collect()
    assert sorted((x.page_id, x.host, x.path, x.rule or "", x.verdict) for x in got) == [(i, *[y or "" for y in judge(u)]) for i, u in enumerate(urls)]
    assert got[0].prefix == 1
    kept = U.filter_urls(pages, spark.createDataFrame(RULES, "host string, path string, verdict string"))
    assert kept.count() == sum(judge(u)[3] == "allow" for u in urls)


def test_no_rules_and_no_pages(spark):
    none = spark.createDataFrame([], "host string, path string, verdict string")
    pages = spark.createDataFrame([(1, "http://a.b/c"), (1, None)], "page_id long, url string")
    assert sorted((x.host, x.rule, x.verdict) for x in U.judge_urls(pages, none, default="block").collect()) == [("", None, "block"), ("a.b", None, "block")]
    assert U.judge_urls(pages.limit(0), none).count() == 0
