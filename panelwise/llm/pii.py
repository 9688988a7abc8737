"""Personal data by rules, widened by bootstrapped contextual extraction.

The rules find e-mail addresses, IP numbers, cards and phones. What stands around the found ones seeds the rest:

1. Contexts are lexical patterns: the word before, the two words before, the word before and the one after; and where marks stand
   between word and entity, as in ``key = "..."``, the word with these marks, and the marks with the entity's shape. Every
   found entity and every other identifier-like token (with digits or an ``@``; groups of digits that single blanks part
   are one) is an instance of its patterns. Long hexadecimal tokens seed a kind of their own, ``secret``: no rule reports
   them, so they are reported only where a pattern is trusted for them.
2. Spark scores the graph of patterns and instances in rounds, until no further pattern is trusted. A pattern is trusted for a kind as far as its distinct
   instances are of that kind; an instance belongs to a kind as far as the best pattern it occurs in is trusted.
3. Patterns that are trusted enough, by enough different instances, claim the identifier-like tokens they stand
   around, in all documents. Claims never remove or overlap what the rules found.

Only contexts and hashes are shuffled, never texts.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwise.llm.common import Scratch, broadcast_if_small, col

#: Kinds in their order.
KINDS = ["email", "ip", "card", "phone"]
#: The kinds of learned spans: those of the rules, and what only seeds know.
LEARNED = [*KINDS, "secret"]
#: What a pattern needs to claim tokens: the share of its instances that are of the kind, and how many of them.
TRUST, SUPPORT = 0.9, 8
#: Rounds of scoring at most.
ROUNDS = 20
#: Characters on either side in which context words are looked for.
REACH = 80

LOCAL = "ABCDEFGHIJKLMNOPQRSTUVWXYZabcdefghijklmnopqrstuvwxyz0123456789._%+-"
DOMAIN = re.compile(r"[A-Za-z0-9-]+(?:\.[A-Za-z0-9-]+)+")
IP = re.compile(r"(?<![0-9])([0-9]++)\.([0-9]++)\.([0-9]++)\.([0-9]++)")
CARD = re.compile(r"[0-9](?:[\x20-]?[0-9])++")
PHONE = re.compile(r"\+[0-9][\x20().0-9-]+[0-9]")
DIGIT = re.compile(r"[0-9]")
TOKEN = re.compile(r"\S+")
DIGITS = re.compile(r"\+?[0-9][0-9().\[\]-]*+")
EDGES = "()[]{}<>\"'.,;:!?*#&%$=|"
NOT_WORD = re.compile(r"[\W_]+")
#: What seeds the kind ``secret``.
HEX = re.compile(r"(?=[0-9a-f]*[a-f])(?=[a-f]*[0-9])[0-9a-f]{24,}", re.I)
MARKS = re.compile(r"[^\w\s]*(?:\s[^\w\s]*)*\Z")
RUNS = re.compile(r"0+|a+")


def luhn(digits: str) -> bool:
    total = 0
    for i, d in enumerate(reversed(digits)):
        n = int(d) * (1 + i % 2)
        total += n - 9 * (n > 9)
    return total % 10 == 0


def _emails(text: str) -> Iterator[tuple[int, int]]:
    """What the pattern of an address matches, found from its ``@``, so that long words cost nothing."""
    free, at = 0, text.find("@")
    while at >= 0:
        left = text[free:at]
        start = free + len(left.rstrip(LOCAL))
        free = at + 1
        if start < at and (m := DOMAIN.match(text, at + 1)):
            yield start, m.end()
            free = m.end()
        at = text.find("@", free)


def base_spans(text: str) -> list[tuple[int, int, str]]:
    """(start, end, kind) of all rule matches, by start, then kind; in code points."""
    found = [(a, b, 0) for a, b in _emails(text)] if "@" in text else []
    if DIGIT.search(text):
        found += [(*m.span(), 1) for m in IP.finditer(text) if all(len(p) <= 3 and int(p or 0) <= 255 for p in (g.lstrip("0") for g in m.groups()))]
        for m in CARD.finditer(text):
            digits = m[0].replace(" ", "").replace("-", "")
            if 12 <= len(digits) <= 19 and luhn(digits):
                found.append((*m.span(), 2))
        if "+" in text:
            found += [(*m.span(), 3) for m in PHONE.finditer(text) if 9 <= len(DIGIT.findall(m[0])) <= 15]
    return [(a, b, KINDS[k]) for a, b, k in sorted(found, key=lambda x: (x[0], x[2], x[1]))]


def _word(token: str) -> str:
    return DIGIT.sub("0", NOT_WORD.sub("", token.lower()))


def shape(token: str) -> str:
    """Letters as ``a``, digits as ``0``, runs of either as one with its length; hexadecimal tokens by their length alone."""
    if HEX.fullmatch(token):
        return f"hex{len(token)}"
    plain = "".join("0" if c.isdigit() else "a" if c.isalpha() else c for c in token[:REACH])
    return RUNS.sub(lambda m: f"{m[0][0]}{len(m[0])}", plain)


def contexts(text: str, start: int, end: int) -> list[str]:
    """The patterns around a span; a missing word is empty, and a pattern without a word before is none."""
    ahead = text[max(0, start - REACH) : start]
    before = [w for w in map(_word, ahead.split()) if w][-2:]
    after = [w for w in map(_word, text[end : end + REACH].split()) if w][:1]
    if not before:
        return []
    one = f"{before[-1]} _"
    found = [one, *([f"{before[0]} {one}"] if len(before) == 2 else []), *([f"{one} {after[0]}"] if after else [])]
    marks = "".join(MARKS.search(ahead)[0].split())
    if marks:
        found += [f"{before[-1]}{marks}_", f"{marks}_{shape(text[start:end])}"]
    return found


def likely_tokens(text: str, taken: list[tuple[int, int, str]]) -> Iterator[tuple[int, int]]:
    """Identifier-like tokens outside the spans taken: at least six characters between punctuation, with a digit or an ``@``.

    Tokens of digits, dots, hyphens and brackets that single blanks part are one, as in ``(555) 123-4567``.
    """
    spans: list[tuple[int, int]] = []
    for a, b in sorted((a, b) for a, b, _ in taken):
        if spans and a <= spans[-1][1]:
            spans[-1] = spans[-1][0], max(b, spans[-1][1])
        else:
            spans.append((a, b))
    n = 0
    run: list[int] = []  # start and end of the digits so far, and where their last token ends
    for m in TOKEN.finditer(text):
        token = m[0]
        if not (DIGIT.search(token) or "@" in token):
            continue
        start = m.start() + len(token) - len(token.lstrip(EDGES))
        end = m.start() + len(token.rstrip(EDGES))
        while n < len(spans) and spans[n][1] <= m.start():
            n += 1
        k = n
        while k < len(spans) and spans[k][1] <= start:
            k += 1
        if k < len(spans) and spans[k][0] < end:
            continue
        if not DIGITS.fullmatch(text, start, end):
            if end - start >= 6:
                if run:
                    yield from _whole(text, *run[:2])
                    run = []
                yield start, end
            continue
        if run and m.start() == run[2] + 1 and text[run[2]] == " " and not text[run[1] : run[2]].strip(")]") and not text[m.start() : start].strip("(["):
            run[1:] = end, m.end()
        else:
            if run:
                yield from _whole(text, *run[:2])
            run = [start, end, m.end()]
    if run:
        yield from _whole(text, *run[:2])


def _whole(text: str, start: int, end: int) -> Iterator[tuple[int, int]]:
    """A run of digits, if it is long enough, with the brackets at its ends whose partners it holds."""
    for left, right in ("()", "[]"):
        more = text.count(right, start, end) - text.count(left, start, end)
        if more > 0 and text[start - 1 : start] == left:
            start -= 1
        elif more < 0 and text[end : end + 1] == right:
            end += 1
    if end - start >= 6:
        yield start, end


def _number(text: str) -> int:
    return int.from_bytes(hashlib.blake2b(text.encode(), digest_size=8).digest(), "little", signed=True)


def joined(spans: list[tuple[int, int, str]]) -> str:
    return ",".join(f"{k}:{a}:{b}" for a, b, k in spans)


MARK = "array<struct<start:long,end:long,rule:boolean,kind:string,instance:long,patterns:array<long>>>"


def _scan(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    mark = pa.list_(pa.struct([("start", pa.int64()), ("end", pa.int64()), ("rule", pa.bool_()), ("kind", pa.string()), ("instance", pa.int64()), ("patterns", pa.list_(pa.int64()))]))
    for whole in batches:
        for begin in range(0, len(whole), 256):
            batch = whole.slice(begin, 256)
            counts, base, marks = [[] for _ in KINDS], [], []
            for text in batch.column("text").to_pylist():
                spans = base_spans(text)
                for k, c in zip(KINDS, counts):
                    c.append(sum(s[2] == k for s in spans))
                base.append(joined(spans))
                own = []
                if spans or "@" in text or DIGIT.search(text):
                    others = [(a, b, "secret" if HEX.fullmatch(text, a, b) else None) for a, b in likely_tokens(text, spans)]
                    for n, (a, b, k) in enumerate([*spans, *others]):
                        patterns = [_number(p) for p in contexts(text, a, b)]
                        if patterns:
                            own.append({"start": a, "end": b, "rule": n < len(spans), "kind": k, "instance": _number(text[a:b].lower()), "patterns": patterns})
                marks.append(own)
            yield pa.RecordBatch.from_arrays([batch.column("doc_id"), *[pa.array(c, pa.int64()) for c in counts], pa.array(base, pa.string()), pa.array(marks, mark)], names=["doc_id", *[f"n_{k}" for k in KINDS], "base", "marks"])


def trusted_patterns(edges: DataFrame, scratch: Scratch, rounds: int = ROUNDS, trust: float = TRUST, support: int = SUPPORT) -> DataFrame:
    """(pattern, kind, score) of the patterns to act on, from edges (pattern, instance, kind or null), one per distinct pair.

    Instances that rules or seeds know belong to their kind with weight 1, in every round. The others start at 0 and get
    the best score of the trusted patterns they occur in. Rounds end when no further pattern is trusted.
    """
    total = scratch.stage(edges.groupBy("pattern").agg(F.count(F.lit(1)).alias("total")))
    known = edges.filter("kind is not null").select("pattern", "instance", "kind", F.lit(1.0).alias("weight"))
    open_edges = edges.filter("kind is null").select("pattern", "instance")
    believed, trusted, before = known, None, -1
    for _ in range(rounds):
        held = believed.groupBy("pattern", "kind").agg(F.sum("weight").alias("held"), F.count(F.lit(1)).alias("n"))
        scored = held.join(total, "pattern").select("pattern", "kind", "n", (F.col("held") / F.col("total")).alias("score"))
        trusted = scratch.stage(scored.filter((F.col("score") >= trust) & (F.col("n") >= support)).select("pattern", "kind", "score"))
        now = trusted.count()
        if now == before:
            break
        before = now
        best = open_edges.join(trusted, "pattern").groupBy("instance", "kind").agg(F.max("score").alias("weight"))
        believed = known.unionByName(open_edges.join(scratch.stage(best), "instance").select("pattern", "instance", "kind", "weight"))
    return trusted


def find_personal_data(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", rounds: int = ROUNDS, trust: float = TRUST, support: int = SUPPORT) -> DataFrame:
    """One row per document: doc_id, n_email, n_ip, n_card, n_phone (rule matches), base, spans.

    ``base`` holds the rule matches as ``kind:start:end`` (code points, end exclusive), by start, then kind, parted by
    commas; ``spans`` those and the learned ones, whose kind may also be ``secret``, the last in order. Null and empty texts have none. Repeated rows are documents of
    their own. Learned spans carry the kind of the pattern with the best score, ties by the order of kinds.
    """
    scratch = Scratch(docs.sparkSession, "personal")
    source = docs.select(col(doc_id).alias("doc_id"), F.coalesce(col(text).cast("string"), F.lit("")).alias("text"))
    scanned = source.mapInArrow(_scan, f"doc_id {source.schema['doc_id'].dataType.simpleString()}, " + "".join(f"n_{k} long, " for k in KINDS) + f"base string, marks {MARK}")
    scanned = scratch.stage(scanned.withColumn("row", F.monotonically_increasing_id()))
    marks = scanned.select("row", F.explode("marks").alias("m")).select("row", "m.*")
    edges = scratch.stage(marks.select(F.explode("patterns").alias("pattern"), "instance", "kind").groupBy("pattern", "instance").agg(F.min("kind").alias("kind")))
    patterns = scratch.stage(trusted_patterns(edges, scratch, rounds, trust, support))

    rank = F.struct(F.col("score"), *[(F.col("kind") == k).alias(k) for k in LEARNED], F.col("kind"))
    open_marks = marks.filter("not rule").select("row", "start", "end", F.explode("patterns").alias("pattern"))
    claims = open_marks.join(broadcast_if_small(patterns, patterns.count(), 64), "pattern").groupBy("row", "start", "end").agg(F.max(rank).alias("best"))
    by_row = scratch.stage(claims.groupBy("row").agg(F.collect_list(F.struct("start", "end", F.col("best.kind").alias("kind"))).alias("more")))
    claimed, n_rows = by_row.agg(F.coalesce(F.sum(F.size("more")), F.lit(0)), F.count(F.lit(1))).first()
    spans = scanned.select("row", "doc_id", *[f"n_{k}" for k in KINDS], "base").join(broadcast_if_small(by_row, claimed + n_rows, 64), "row", "left")
    base = F.when(F.col("base") == "", F.array().cast("array<string>")).otherwise(F.split("base", ","))
    parsed = F.transform(base, lambda s: F.struct(F.split_part(s, F.lit(":"), F.lit(2)).cast("long").alias("start"), F.array_position(F.array(*map(F.lit, LEARNED)), F.split_part(s, F.lit(":"), F.lit(1))).alias("rank"), F.split_part(s, F.lit(":"), F.lit(3)).cast("long").alias("end"), F.split_part(s, F.lit(":"), F.lit(1)).alias("kind")))
    learned = F.transform("more", lambda m: F.struct(m["start"].alias("start"), F.array_position(F.array(*map(F.lit, LEARNED)), m["kind"]).alias("rank"), m["end"].alias("end"), m["kind"].alias("kind")))
    everything = F.array_join(F.transform(F.array_sort(F.concat(parsed, learned)), lambda s: F.concat_ws(":", s["kind"], s["start"].cast("string"), s["end"].cast("string"))), ",")
    return spans.select("doc_id", *[f"n_{k}" for k in KINDS], "base", F.when(F.col("more").isNull(), F.col("base")).otherwise(everything).alias("spans"))
