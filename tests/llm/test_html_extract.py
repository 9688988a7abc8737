import random

from panelwise.llm import html_extract as H

SCHEMA = "page_id long, url string, html string"


def test_markup():
    page = """<!DOCTYPE html><html><head><title>no</title></head><body class="has-sidebar"><header>Site</header><nav>a<ul><li>b</ul></nav>
    <div class="cookieNotice">c</div><article class="post"><header><h1>T &amp; &#85;</h1></header><p class=ad>buy<p>one <b>two</b><br>three&nbsp;x
    <!-- <p>no</p> --><script>var t="</p>";</script><aside>no</aside><p title="a > b">x<span class="share">s</span>y<form>f<p>g</form>
    <pre>k
    l</pre><section id="comments"><article>c</article></section><footer>by</footer></article><div id=footer>z</div></body>"""
    assert [t for t, inside in H.page_lines(page) if inside] == ["T & U", "one two three x", "xy", "k l"]
    assert [t for t, inside in H.page_lines(page) if not inside] == []


def test_odd_markup():
    assert H.page_lines("") == [] and H.page_lines("plain &lt;b&gt;") == [("plain <b>", False)]
    assert H.page_lines("<p>a<p>b</p></div><script>never closed") == [("a", False), ("b", False)]
    assert H.page_lines("a < b and <p cut off") == [("a < b and", False)]
    assert H.page_lines("<main><div class=sidebar>x</div>y</main>z") == [("y", True), ("z", False)]
    assert len(H.page_lines("<div>" * 20_000 + "x" + "<p>y" * 20_000)) == 20_001


def test_a_head_ends_without_its_tag():
    head = "<html><head><meta charset=x><title>no <b>t</title><script>'<div>'</script><style>p{}</style>\n"
    for more in ("<body>", "", "</head>", "</head><body>"):
        assert H.page_lines(head + more + "<p>a</p><p>b") == [("a", False), ("b", False)]
    assert H.page_lines(head + "text <i>and</i> more") == [("text and more", False)]
    assert H.page_lines("<head><title>only") == [] and H.page_lines("<head>a") == [("a", False)]


def test_elements_that_close_themselves():
    assert H.page_lines('<p>a<svg class="i"/>b<math/>c<svg a="/">no</svg>d</p><p>e') == [("abcd", False), ("e", False)]
    H.page_lines("<svg '" * 200_000 + "<svg /" * 200_000)


def test_headings_stay_whatever_their_id():
    assert H.page_lines('<article><h2 id="how-to-share-files">a</h2>b</article>') == [("a", True), ("b", True)]


def test_broken_markup_takes_linear_time():
    for page in ("<a " * 200_000, "<a '" * 200_000, '<a "x' * 200_001, "<" * 500_000, "<script" * 100_000, "<!--" * 100_000, "<div " + "a=b " * 300_000):
        H.page_lines(page)


def test_elements_inside_left_out_ones():
    """An inner end tag does not end the outer element, whatever the tag."""
    lines = lambda inner: [t for t, _ in H.page_lines(f"<article><p>a</p>{inner}<p>z</p></article>")]
    assert lines('<span class="share">Share <span>on</span> Twitter</span>') == ["a", "z"]
    assert lines('<ul><li class="menu">M<ul><li>A</li><li>B</li></ul>C</li></ul>') == ["a", "z"]
    assert lines('<div class="ad"><div>x</div><div>y<div>v</div></div>w</div>') == ["a", "z"]
    assert lines('<b class="ad">x<b>y<b>v</b></b>w</b> kept') == ["a", "kept", "z"]
    assert lines('<span class="ad"><i>x</i><span>y</div></span>w</span>') == ["a", "z"]


def test_end_tags_without_a_start_take_linear_time():
    assert H.page_lines("<div>" * 50_000 + "</b>" * 50_000 + "x") == [("x", False)]
    assert H.page_lines("<div>" * 50_000 + "</p>" * 50_000 + "</div>" * 50_000 + "x") == [("x", False)]


def test_longest_common_subsequence():
    r = random.Random(3)
    for _ in range(400):
        a, b = ([r.randrange(6) for _ in range(r.randint(0, 14))] for _ in range(2))
        best = [[0] * (len(b) + 1) for _ in range(len(a) + 1)]
        for i in range(len(a)):
            for j in range(len(b)):
                best[i + 1][j + 1] = best[i][j] + 1 if a[i] == b[j] else max(best[i][j + 1], best[i + 1][j])
        got = H.common_lines(a, b)
        assert len(got) == best[-1][-1] and got == sorted(set(got))
        rest = iter(b)
        assert all(a[i] in rest for i in got)


def site(n, host="h.com"):
    page = "<html><body><div>The Site</div><div>Home | About</div><p>{0}</p><p>Share this text with others</p><p>{1}</p><div>All rights kept</div></body></html>"
    return [(i, f"http://{host}/a/{i:05d}", page.format(f"Text number {i} is long enough to be an article of its own", f"it has a second part {i * 7} as well")) for i in range(n)]


def test_pages_without_an_article_are_differenced(spark):
    rows = site(300) + [(900, "http://z.org/1", "<p>alone</p><p>on its host</p>"), (901, None, None), (902, "x", ""), (903, "http://c.org/1", "<p>copy</p><p>of a page</p>"), (904, "http://c.org/2", "<p>copy</p><p>of a page</p>"), (905, "http://c.org/2", None), (905, "http://c.org/2", None)]
    want = {i: f"Text number {i} is long enough to be an article of its own\n\nit has a second part {i * 7} as well" for i in range(300)}
    want |= {900: "alone\n\non its host", 901: "", 902: "", 903: "copy\n\nof a page", 904: "copy\n\nof a page", 905: ""}
    for partitions in ("1", "16"):  # where a host is cut among tasks changes nothing
        old = spark.conf.get("spark.sql.shuffle.partitions")
        spark.conf.set("spark.sql.shuffle.partitions", partitions)
        try:
            pages = spark.createDataFrame([(*r, "r", 1) for r in rows], SCHEMA + ", lines string, row int").repartition(3)
            got = H.extract_text(pages).collect()
        finally:
            spark.conf.set("spark.sql.shuffle.partitions", old)
        assert len(got) == len(rows) and {r.page_id: r.text for r in got} == want
        assert all(r.n_chars == len(r.text) for r in got)


def test_articles_keep_lines_they_share(spark):
    page = "<div>menu line</div><article><p>quoted passage</p><p>own {0}</p></article>"
    got = H.extract_text(spark.createDataFrame([(i, f"http://h.com/{i}", page.format(i)) for i in range(5)], SCHEMA)).collect()
    assert {r.text for r in got} == {f"quoted passage\n\nown {i}" for i in range(5)}


def test_articles_that_the_site_repeats_are_no_text(spark):
    """Differencing judges marked articles, too: a teaser on every page goes, beside an article of the page's own and beside unmarked text."""
    teaser = "<article><h2>Offer</h2><p>read more</p></article>"
    two = teaser + "<div>menu line</div><main><p>quoted passage</p><article><p>quote</p><p>own text number {0} of this page, with more words</p></article></main>"
    loose = "<div>menu line</div><article><p>teaser</p></article><p>the text of page {0}, which marks no article</p>"
    rows = [(i, f"http://a.com/{i}", two.format(i)) for i in range(4)] + [(10 + i, f"http://b.com/{i}", loose.format(i)) for i in range(4)]
    rows += [(20 + i, f"http://c.com/{i}", "<article>the same</article>x") for i in range(3)]
    got = {r.page_id: r.text for r in H.extract_text(spark.createDataFrame(rows, SCHEMA)).collect()}
    want = {i: f"quote\n\nown text number {i} of this page, with more words" for i in range(4)} | {10 + i: f"the text of page {i}, which marks no article" for i in range(4)} | {20 + i: "the same" for i in range(3)}
    assert got == want


def test_kept_lines():
    assert H.kept_lines([0, 0, 0], [5, 5, 5], [{0}, {2}]) == [1] and H.kept_lines([0, 0], [5, 5], []) == [0, 1]
    assert H.kept_lines([1, 1, 0, 2], [5, 5, 5, 5], [{0, 1, 2}, {0, 1, 2}]) == [3]
    assert H.kept_lines([1, 1, 0, 2], [5, 5, 5, 5], [{0, 1, 2}, {0, 3}]) == [0, 1, 3]  # each neighbour has another one
    assert H.kept_lines([1, 0], [9, 5], [{0}, {0}]) == [0] and H.kept_lines([1, 0], [5, 9], [{0}, {0}]) == [1]


def test_empty_table(spark):
    assert H.extract_text(spark.createDataFrame([], SCHEMA)).count() == 0
