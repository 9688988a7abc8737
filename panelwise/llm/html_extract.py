"""Main text of web pages by differencing neighbouring URLs of a host.

1. A task reads each page's markup into lines (blocks of text). Markup that names its purpose (menus, forms, scripts, classes such
   as ``cookie`` or ``comments``) is left out. Lines inside ``<article>`` or ``<main>`` are numbered by that element.
2. The lines of all pages are differenced: pages are ordered by URL path within their host, each page is paired with the one
   before and the one after, the two lists of lines are aligned by their longest common subsequence, and shared lines are
   deleted. What pages of a site share is the site's; what one page has alone is its text. A neighbour that shares
   more than four fifths of a page's characters is a copy of it and says nothing about the site.
3. A check puts back what is the page's although others share it (:func:`kept_lines`): where a line of a marked article is left, the article
   is the page's own, and all of its lines are its text; articles that quote the same passage would lose it otherwise. A marked
   article that differencing deletes whole is the site's (a teaser on every page), as long as it leaves more text outside.
   On a page without an article the text is what differencing left.

Only addresses and 64-bit line hashes are sorted and joined; hosts of any size are split among tasks, and
what stands at the border of two tasks is paired by a table of one row per task.
"""

from __future__ import annotations

import html as entities
import re
from bisect import bisect_left
from collections.abc import Iterator

import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from panelwise.llm.common import Scratch, broadcast_if_small, col
from panelwise.llm.url_filter import url_host, url_path

# Names of HTML.
RAW = "script|style|noscript|template|iframe|svg|math|textarea|select|object|canvas|audio|video"
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
#: What a head can hold, besides raw elements; anything else ends it.
IN_HEAD = frozenset("base basefont bgsound link meta title".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
NOT_TEXT = frozenset("nav footer aside form button menu dialog search fieldset label datalist".split())
NOT_TEXT_ROLES = frozenset("navigation contentinfo complementary search dialog alertdialog alert banner menu menubar toolbar form".split())
NOT_TEXT_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising adsense sponsor sponsored promo promotion banner nav navigation navbar menu breadcrumb breadcrumbs footer sidebar aside widget cookie cookies consent gdpr notice notification alert popup modal overlay newsletter subscribe signup login share sharing social comment comments disqus reply replies respond related recommended pagination pager search".split()
)

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<(?:svg|math)(?=[\s/])(?:\"[^\"]*\"|'[^']*'|[^'\"<>])*+(?<=/)>|<(?P<raw>" + RAW + r")(?=[\s/>])(?:\"[^\"]*\"|'[^']*'|[^'\"<>])*+>.*?(?:</(?P=raw)\s*>|\Z)|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/<>]*+)(?P<more>(?:\"[^\"]*\"|'[^']*'|[^'\"<>])*+)>|<[!?][^>]*>",
    re.S | re.I,
)
NAMES = re.compile(r"""\b(class|id|role|hidden|aria-hidden)\s*(?:=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+)))?""", re.I)
PARTS = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")


def _left_out(tag: str, more: str, in_article: bool) -> bool:
    """Does an element say of itself that it is no part of the text?"""
    if tag in NOT_TEXT or tag == "head" or tag == "header" and not in_article:
        return True
    if not more or tag in ("html", "body", "main"):
        return False
    for m in NAMES.finditer(more):
        name, value = m[1].lower(), m[2] or m[3] or m[4] or ""
        if name == "role" and value.strip().lower() in NOT_TEXT_ROLES or name == "hidden" and "hidden" not in value or name == "aria-hidden" and value.lower() == "true":
            return True
        if name == "class" or name == "id" and tag not in HEADINGS:
            words = {w.lower() for w in PARTS.findall(value)}
            if words & NOT_TEXT_WORDS or "header" in words and not in_article:
                return True
    return False


def page_lines(page: str) -> list[tuple[str, bool]]:
    """The lines of a page that its markup does not leave out, and whether each is part of an article."""
    return [(text, article != 0) for text, article in numbered_lines(page)]


def numbered_lines(page: str) -> list[tuple[str, int]]:
    """The lines of a page that its markup does not leave out, and the number of the article each is part of.

    That is the outermost ``<article>``, or the ``<main>`` around lines that are in none (numbered below zero); 0 is outside of both.
    """
    lines: list[tuple[str, int]] = []
    held: list[str] = []
    open_tags: list[tuple[str, bool, int]] = []  # tag, left out, article
    out, article, articles = False, 0, 0
    opened: dict[str, int] = {}  # how often each tag is open

    def flush() -> None:
        if held:
            text = " ".join("".join(held).split())
            held.clear()
            if text:
                lines.append((text, article))

    def push(tag: str, leaves: bool, number: int) -> None:
        open_tags.append((tag, leaves, number))
        opened[tag] = opened.get(tag, 0) + 1

    def close(depth: int) -> None:
        nonlocal out, article
        for name, _, _ in open_tags[depth:]:
            opened[name] -= 1
        del open_tags[depth:]
        _, out, article = open_tags[-1] if open_tags else ("", False, 0)

    at = 0
    for m in TOKEN.finditer(page):
        if m.start() > at:
            text = page[at : m.start()]
            if out and open_tags[-1][0] == "head" and not text.isspace():
                close(len(open_tags) - 1)
            if not out:
                held.append(entities.unescape(text) if "&" in text else text)
        at = m.end()
        tag = m["tag"]
        if tag is None:
            continue
        tag = tag.lower()
        if open_tags and open_tags[-1][0] == "head" and not m["end"]:
            if tag == "title":
                push(tag, True, article)
                continue
            if tag not in IN_HEAD and tag != "head":
                close(len(open_tags) - 1)
        if tag == "br":
            held.append(" ")
            continue
        is_block = tag in BLOCKS
        if is_block:
            flush()
        if m["end"]:
            if opened.get(tag):
                close(next(i for i in range(len(open_tags) - 1, -1, -1) if open_tags[i][0] == tag))
            continue
        if tag in VOID or m["more"].endswith("/"):
            continue
        if is_block and open_tags and open_tags[-1][0] == "p":
            close(len(open_tags) - 1)  # a paragraph ends where the next block begins
        if tag == "li" and open_tags and open_tags[-1][0] == "li":
            close(len(open_tags) - 1)
        leaves = out or _left_out(tag, m["more"], article != 0)
        # Inside a left-out element every element counts, so that an inner end tag does not end the outer one.
        if is_block and tag not in ("p", "li", "hr") or leaves:
            number = article
            if tag == "article" and article <= 0 or tag == "main" and not article:
                articles += 1
                number = articles if tag == "article" else -articles
            push(tag, leaves, number)
            _, out, article = open_tags[-1]
    if out and open_tags[-1][0] == "head" and page[at:].strip():
        close(len(open_tags) - 1)
    if at < len(page) and not out:
        text = page[at:]
        # A tag that the end of the page cuts off is no text.
        text = re.sub(r"<[a-zA-Z/!][^>]*\Z", "", text)
        held.append(entities.unescape(text))
    flush()
    return lines


def common_lines(a: list[int], b: list[int]) -> list[int]:
    """Places in ``a`` of a longest common subsequence with ``b``."""
    first = 0
    while first < min(len(a), len(b)) and a[first] == b[first]:
        first += 1
    last = 0
    while last < min(len(a), len(b)) - first and a[-1 - last] == b[-1 - last]:
        last += 1
    places: dict[int, list[int]] = {}
    for j in range(len(b) - last - 1, first - 1, -1):
        places.setdefault(b[j], []).append(j)
    # Hunt and Szymanski: ends[n] is the lowest place in b at which a common subsequence of n + 1 lines can end.
    ends: list[int] = []
    links: list[tuple] = []
    for i in range(first, len(a) - last):
        for j in places.get(a[i], ()):
            n = bisect_left(ends, j)
            link = (i, links[n - 1] if n else None)
            if n == len(ends):
                ends.append(j)
                links.append(link)
            elif j < ends[n]:
                ends[n], links[n] = j, link
    middle, link = [], links[-1] if links else None
    while link:
        middle.append(link[0])
        link = link[1]
    return [*range(first), *reversed(middle), *range(len(a) - last, len(a))]


def kept_lines(articles: list[int], sizes: list[int], shared: list[set[int]]) -> list[int]:
    """Places of the lines that are a page's text, by its lines' articles and sizes and the lines that each neighbour shares."""
    cut = set().union(*shared)
    if not any(articles):
        return [i for i in range(len(articles)) if i not in cut]
    # One neighbour may quote an article; what all of them have whole is the site's.
    common = set.intersection(*shared) if shared else cut
    own = {a for i, a in enumerate(articles) if a and i not in common}
    loose = [i for i, a in enumerate(articles) if not a and i not in cut]
    if not own and sum(sizes[i] for i in loose) > sum(n for n, a in zip(sizes, articles) if a):
        return loose
    return [i for i, a in enumerate(articles) if a and (a in own or not own)]


def _parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for begin in range(0, len(whole), 500):
            batch = whole.slice(begin, 500)
            found = [numbered_lines(page) for page in batch.column("html").to_pylist()]
            lines, articles = ([[line[i] for line in page] for page in found] for i in (0, 1))
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in ("page_id", "url", "host", "path")), pa.array(lines, pa.list_(pa.string())), pa.array(articles, pa.list_(pa.int32()))], names=["page_id", "url", "host", "path", "lines", "articles"])


def _neighbours(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """(row, before) of rows sorted by host and path; and the task's first and last row, with its number."""
    task, first, last = TaskContext.get().partitionId(), None, None
    for batch in batches:
        rows, before = [], []
        for host, row in zip(batch.column("host").to_pylist(), batch.column("row").to_pylist()):
            if first is None:
                first = (host, row)
            elif last[0] == host:
                rows.append(row)
                before.append(last[1])
            last = (host, row)
        n = len(rows)
        none, no_host = pa.nulls(n, pa.int64()), pa.nulls(n, pa.string())
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(before, pa.int64()), none, no_host, no_host], names=["row", "before", "task", "first_host", "last_host"])
    if first is not None:
        yield pa.RecordBatch.from_pylist(
            [{"row": first[1], "before": last[1], "task": task, "first_host": first[0], "last_host": last[0]}],
            schema=pa.schema([("row", pa.int64()), ("before", pa.int64()), ("task", pa.int64()), ("first_host", pa.string()), ("last_host", pa.string())]),
        )


def _kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The places of a page's text, for pages where they are not those that stay without neighbours."""
    for batch in batches:
        rows, kept = [], []
        for row, own, sizes, articles, *others in zip(*(batch.column(c).to_pylist() for c in ("row", "hashes", "sizes", "articles", "before_hashes", "after_hashes"))):
            found = [common_lines(own, other) for other in others if other]
            shared = [set(x) for x in found if 5 * sum(sizes[i] for i in x) <= 4 * sum(sizes)]
            keep = kept_lines(articles, sizes, shared)
            if keep != kept_lines(articles, sizes, []):
                rows.append(row)
                kept.append(keep)
        yield pa.RecordBatch.from_arrays([pa.array(rows, pa.int64()), pa.array(kept, pa.list_(pa.int32()))], names=["row", "kept"])


def extract_text(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """One row per page: page_id, url, text (blocks joined by an empty line; empty if there are none), n_chars.

    Null html counts as empty. Pages without ``://`` in their URL, or with a null one, are neighbours of one
    another under the empty host. Repeated rows are pages of their own; ties in the order of URLs go by their order in the table.
    """
    scratch = Scratch(pages.sparkSession, "html")
    kinds = dict(pages.select(col(page_id).alias("page_id"), col(url).alias("url")).dtypes)
    source = pages.select(col(page_id).alias("page_id"), col(url).alias("url"), url_host(col(url)).alias("host"), url_path(col(url)).alias("path"), F.coalesce(col(html).cast("string"), F.lit("")).alias("html"))
    parsed = source.mapInArrow(_parse, f"page_id {kinds['page_id']}, url {kinds['url']}, host string, path string, lines array<string>, articles array<int>")
    parsed = scratch.stage(parsed.withColumn("row", F.monotonically_increasing_id()))
    hashed = parsed.filter("size(lines) > 0").select("row", "host", "path", F.transform("lines", lambda x: F.xxhash64(x)).alias("hashes"), F.transform("lines", lambda x: F.char_length(x)).alias("sizes"), "articles")
    hashed = scratch.stage(hashed)
    n = max(1, min(hashed.count(), int(pages.sparkSession.conf.get("spark.sql.shuffle.partitions"))))
    found = scratch.stage(hashed.select("host", "path", "row").repartitionByRange(n, "host", "path", "row").sortWithinPartitions("host", "path", "row").mapInArrow(_neighbours, "row long, before long, task long, first_host string, last_host string"))
    inside = found.filter("task is null").select("row", "before")
    edges = found.filter("task is not null")
    by_task = Window.orderBy("task")
    across = edges.select("row", F.lag("before").over(by_task).alias("before"), "first_host", F.lag("last_host").over(by_task).alias("host")).filter("first_host = host").select("row", "before")
    pairs = scratch.stage(inside.unionByName(across))

    hashes = hashed.select(F.col("row").alias("other"), F.col("hashes"))
    before = pairs.join(hashes.withColumnRenamed("hashes", "before_hashes"), F.col("before") == F.col("other")).select("row", "before_hashes")
    after = pairs.withColumnRenamed("row", "next").withColumnRenamed("before", "row").join(hashes.withColumnRenamed("hashes", "after_hashes"), F.col("next") == F.col("other")).select("row", "after_hashes")
    differenced = hashed.select("row", "hashes", "sizes", "articles").join(before, "row", "left").join(after, "row", "left")
    kept = scratch.stage(differenced.mapInArrow(_kept, "row long, kept array<int>"))
    joined = parsed.join(broadcast_if_small(kept, kept.count(), 512), "row", "left")
    marked = F.exists("articles", lambda a: a != 0)
    alone = F.filter("lines", lambda x, i: ~marked | (F.get("articles", i) != 0))
    text = F.when(F.col("kept").isNull(), F.array_join(alone, "\n\n")).otherwise(F.array_join(F.transform("kept", lambda i: F.get("lines", i)), "\n\n"))
    return joined.select("page_id", "url", text.alias("text")).withColumn("n_chars", F.char_length("text").cast("long"))
