"""Repeated substrings by a distributed merge sort of suffixes that knows common prefixes.

Every byte covered by a ``length``-byte string that also starts earlier is removed. "Earlier" is a smaller doc_id (null last,
then the order of rows), or an earlier place in the same document. Sorting all suffixes would shuffle the corpus many times over, so only
those that can matter are sorted, and this selection is exact:

1. Anchors. Of the 32-byte strings inside a window of ``length`` bytes the one with the smallest hash is the window's anchor.
   Equal windows have equal anchors at equal places, and neighbouring windows mostly share theirs, so an anchor stands
   for some 35 windows. Anchor hashes are counted, and a bit table of those that occur twice goes to all tasks (its size
   is fixed; a wrong alarm costs work, never a result).
2. Copies. Documents that are whole copies are set aside. Anchors with the same context (all bytes of their windows) are
   folded: the earliest stays, the windows of the others are repeats. Where every occurrence of an anchor has one context,
   nothing is left to do.
3. The suffixes that begin at the remaining anchors are sorted. Each task sorts its own into runs, cuts them into ranges and front-codes
   them (a suffix is the number of bytes it shares with the one before, and its other bytes). The runs of a range meet in
   one task, where a loser tree merges them: it remembers how much of each loser agrees with the winner and never
   compares these bytes again. So neighbours come out with their common prefixes, and windows that are equal to
   the right of the anchor stand together; hashes of what lies to the left part them.
4. An anchor with very many different contexts is not sent to one task: its windows are grouped by their hash, which Spark
   adds up before shuffling. Both ways give the same result.
"""

from __future__ import annotations

import hashlib
from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwise.llm.common import SLICE_BYTES, Scratch, broadcast_if_small, byte_views, col, mix, numbered
from panelwise.runtime import MAX_BROADCAST_BYTES

LENGTH = 100
ANCHOR = 32
TABLE_BITS = 1 << 28
#: Suffixes of one run in a task, of a range, and contexts of an anchor beyond which its windows are grouped by hash.
RUN, RANGE, MANY = 50_000, 20_000, 100_000

_PLACE = np.uint64((1 << 24) - 1)
_BASE = 0x9E3779B97F4A7C15
_WIDE = 0x5851F42D4C957F2D


def _code() -> np.ndarray:
    return numbered(256, 77)


def pieces(texts: list[memoryview], length: int) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Up to half a megabyte at a time: the bytes, and for each text in them its number, begin and offset in the whole text.

    A longer text comes in overlapping parts, such that each window lies in exactly one.
    """
    held: list[tuple[int, memoryview, int]] = []
    total = 0

    def out():
        data = np.frombuffer(b"".join(t for _, t, _ in held), np.uint8)
        sizes = np.array([len(t) for _, t, _ in held])
        return data, np.array([n for n, _, _ in held]), np.cumsum(sizes) - sizes, np.array([o for _, _, o in held])

    for n, text in enumerate(texts):
        for at in range(0, max(len(text) - length + 1, 0), SLICE_BYTES):
            part = text[at : at + SLICE_BYTES + length - 1]
            if held and total + len(part) > SLICE_BYTES + length:
                yield out()
                held, total = [], 0
            held.append((n, part, at))
            total += len(part)
    if held:
        yield out()


def anchors(data: np.ndarray, begins: np.ndarray, length: int, code: np.ndarray) -> tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]:
    """For each run of windows with the same anchor: first window, number of windows, the anchor's place and hash.

    All texts in ``data`` have at least ``length`` bytes; windows do not cross from one to the next.
    """
    h, step, power = code[data], 1, _BASE
    while step < ANCHOR:
        h = h[:-step] * np.uint64(power) + h[step:]
        power = power * power & (1 << 64) - 1
        step *= 2
    h = mix(h)
    # The smallest hash in each window; of equal ones the last, since the place counts down in the low bits.
    low = (h & ~_PLACE) | (_PLACE - np.arange(len(h), dtype=np.uint64))
    span, width = length - ANCHOR + 1, 1
    while 2 * width <= span:
        low = np.minimum(low[:-width], low[width:])
        width *= 2
    if span > width:
        low = np.minimum(low[: len(low) - (span - width)], low[span - width :])
    ends = np.append(begins[1:], len(data)) - length + 1
    edge = np.zeros(len(low) + 1, np.int8)
    edge[begins] += 1
    edge[ends] -= 1
    valid = np.cumsum(edge[:-1]).astype(bool)
    change = np.ones(len(low), bool)
    change[1:] = low[1:] != low[:-1]
    change[begins] = True
    first = np.flatnonzero(change & valid)
    stops = np.append(np.flatnonzero(change | ~valid), len(low))
    count = stops[np.searchsorted(stops, first, "right")] - first
    place = (_PLACE - (low[first] & _PLACE)).astype(np.int64)
    # The smallest of many hashes is small; mixed once more, anchors spread evenly over the ranges.
    return first, count, place, mix(h[place])


def _spans_hash(data: np.ndarray, starts: np.ndarray, ends: np.ndarray, code: np.ndarray, base: int) -> np.ndarray:
    """Hashes of byte spans by prefix sums."""
    power = np.cumprod(np.full(len(data) + 1, base, np.uint64))
    inverse = np.cumprod(np.full(len(data) + 1, pow(base, -1, 1 << 64), np.uint64))
    total = np.zeros(len(data) + 1, np.uint64)
    np.cumsum(code[data] * power[:-1], out=total[1:])
    return mix((total[ends] - total[starts]) * inverse[starts])


def _count_anchors(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = _code()
        for batch in batches:
            for data, _, begins, _ in pieces(byte_views(batch.column("text")), length):
                hashes, counts = np.unique(anchors(data, begins, length, code)[3], return_counts=True)
                yield pa.RecordBatch.from_arrays([pa.array(hashes.view(np.int64)), pa.array((counts > 1).astype(np.int32) + 1)], names=["anchor", "n"])

    return run


#: What is known of a run of windows: hashes of anchor and context, first window, number of windows, and how far before the anchor it begins.
RECORD = np.dtype([("anchor", "<i8"), ("context", "<i8"), ("start", "<i4"), ("windows", "u1"), ("reach", "u1")])


def _contexts(length: int, table):
    """Packed records of all anchors that may occur twice, a row for each (part of a) text that has any."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code, bits = _code(), table.value
        for batch in batches:
            for data, text, begins, offset in pieces(byte_views(batch.column("text")), length):
                first, count, place, hashes = anchors(data, begins, length, code)
                spot = hashes & np.uint64(TABLE_BITS - 1)
                hit = (bits[(spot >> np.uint64(3)).astype(np.int64)] >> (spot & np.uint64(7)).astype(np.uint8)) & 1 > 0
                whole = _spans_hash(data, first, first + count - 1 + length, code, _WIDE)[hit]
                first, count, place, hashes = first[hit], count[hit], place[hit], hashes[hit]
                shape = mix((place - first).astype(np.uint64) * np.uint64(1000) + count.astype(np.uint64))
                owner = np.searchsorted(begins, first, "right") - 1
                records = np.empty(len(first), RECORD)
                records["anchor"], records["context"] = hashes.view(np.int64), mix(whole + shape).view(np.int64)
                records["start"], records["windows"], records["reach"] = first + (offset - begins)[owner], count, place - first
                cuts = np.flatnonzero(np.diff(owner, prepend=-1))
                packed = [x.tobytes() for x in np.split(records, cuts[1:])] if len(cuts) else []
                which = pa.array(text[owner[cuts]])
                yield pa.RecordBatch.from_arrays([batch.column("id").take(which), batch.column("row").take(which), pa.array(packed, pa.binary())], names=["id", "row", "records"])

    return run


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for whole in batches:
        for at in range(0, len(whole), 1000):
            batch = whole.slice(at, 1000)
            raw = batch.column("records").to_pylist()
            records = np.frombuffer(b"".join(raw), RECORD)
            owner = pa.array(np.repeat(np.arange(len(raw)), [len(x) // RECORD.itemsize for x in raw]))
            yield pa.RecordBatch.from_arrays(
                [pa.array(np.ascontiguousarray(records[n])) for n in ("anchor", "context")]
                + [batch.column("id").take(owner), batch.column("row").take(owner)]
                + [pa.array(records[n].astype(np.int32)) for n in ("start", "windows", "reach")],
                names=["anchor", "context", "id", "row", "start", "windows", "reach"],
            )


def _pack_firsts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Of each row's earliest contexts: where their windows begin, and the records of those whose anchor has several contexts."""
    for whole in batches:
        for at in range(0, len(whole), 500):
            batch = whole.slice(at, 500)
            lists = batch.column("firsts")
            flat = lists.flatten()
            ends = np.cumsum([0, *(len(x) for x in lists)])
            records = np.zeros(len(flat), RECORD)
            for n in ("anchor", "start", "windows", "reach"):
                records[n] = flat.field(n).to_numpy(zero_copy_only=False)
            several = flat.field("several").to_numpy(zero_copy_only=False)
            starts, marks = [], []
            for i, j in zip(ends, ends[1:]):
                starts.append(np.sort(records["start"][i:j]).tobytes())
                own = records[i:j][several[i:j]]
                marks.append(own.tobytes() if len(own) else None)
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(starts, pa.binary()), pa.array(marks, pa.binary())], names=["row", "starts", "marks"])


def _join_spans(start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """Spans sorted, and joined where they touch: (n, 2)."""
    order = np.argsort(start, kind="stable")
    start, end = start[order], np.maximum.accumulate(end[order])
    fresh = np.ones(len(start), bool)
    fresh[1:] = start[1:] > end[:-1]
    at = np.flatnonzero(fresh)
    return np.stack([start[at], end[np.append(at[1:], len(start)) - 1]], 1).astype(np.int64) if len(start) else np.zeros((0, 2), np.int64)


def _copy_spans(length: int):
    """What the windows of all records cover that are not the earliest of their context."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            spans = []
            for raw, starts in zip(batch.column("records"), batch.column("starts")):
                records = np.frombuffer(raw.as_buffer(), RECORD)
                if starts.is_valid:
                    records = records[~np.isin(records["start"], np.frombuffer(starts.as_buffer(), np.int32))]
                start = records["start"].astype(np.int64)
                spans.append(_join_spans(start, start + records["windows"] - 1 + length).tobytes())
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(spans, pa.binary())], names=["row", "spans"])

    return run


def common_prefix(a: bytes, b: bytes, known: int) -> int:
    """Length of the common prefix of two strings that agree in their first ``known`` bytes."""
    n = min(len(a), len(b))
    x, y = a[known:n], b[known:n]
    if x == y:
        return n
    return known + (8 * len(x) - (int.from_bytes(x, "big") ^ int.from_bytes(y, "big")).bit_length()) // 8


def front_code(strings: list[bytes]) -> tuple[list[int], list[bytes]]:
    """Of sorted strings: how many bytes each shares with the one before, and its other bytes."""
    shared = [0] + [common_prefix(a, b, 0) for a, b in zip(strings, strings[1:])]
    return shared, [s[n:] for s, n in zip(strings, shared)]


def merge_runs(runs: list[tuple[Sequence[int], list[bytes]]]) -> Iterator[tuple[int, int, int]]:
    """(run, place in it, bytes shared with the string before) of all strings of front-coded runs, in sorted order.

    A loser tree. ``agree[r]`` says how many bytes run r's string shares with the string that beat it last; all runs on
    the way from the last winner's leaf were beaten by that winner. Of two of them the one that agrees more is smaller, without a look at the
    strings; only if both agree alike are they compared, from there on.
    """
    size = 1
    while size < len(runs):
        size *= 2
    place = [0] * size
    string: list[bytes | None] = [r[1][0] if r[1] else None for r in runs] + [None] * (size - len(runs))
    agree = [0] * size
    losers = [0] * size

    def play(a: int, b: int) -> tuple[int, int]:
        """Winner and loser."""
        x, y = string[a], string[b]
        if x is None or y is None:
            return (b, a) if x is None else (a, b)
        if agree[a] != agree[b]:
            return (a, b) if agree[a] > agree[b] else (b, a)
        n = common_prefix(x, y, agree[a])
        if n == len(x) or n < len(y) and x[n] < y[n]:
            agree[b] = n
            return a, b
        agree[a] = n
        return b, a

    winners = [0] * size + list(range(size))
    for node in range(size - 1, 0, -1):
        winners[node], losers[node] = play(winners[2 * node], winners[2 * node + 1])
    top = winners[1]
    while string[top] is not None:
        yield top, place[top], agree[top]
        shared, rest = runs[top]
        place[top] += 1
        i = place[top]
        if i < len(rest):
            agree[top] = shared[i]
            string[top] = string[top][: shared[i]] + rest[i]
        else:
            string[top] = None
        node = (size + top) >> 1
        while node:
            top, losers[node] = play(top, losers[node])
            node >>= 1


def _lengths(items: list[bytes]) -> bytes:
    return np.array([len(x) for x in items], np.uint8).tobytes()


def _split(data: bytes, lengths: bytes) -> list[bytes]:
    ends = np.cumsum(np.frombuffer(lengths, np.uint8)).tolist()
    return [data[a:b] for a, b in zip([0, *ends], ends)]


RUN_TYPE = "part int, shared binary, rests binary, rest_sizes binary, lefts binary, left_sizes binary, numbers binary"


def _sorted_runs(length: int, parts: int):
    """Front-coded runs of the suffixes at marked anchors, by range of the anchor's hash (which is a suffix's first eight bytes).

    To the right of the anchor a suffix reaches as far as its windows do; the bytes to the left of it, backwards, go along.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[tuple[bytes, bytes, tuple]] = []

        def out() -> Iterator[pa.RecordBatch]:
            held.sort(key=lambda x: x[0])
            at = 0
            bounds = [int.from_bytes(s[:2], "big") * parts >> 16 for s, _, _ in held]
            while at < len(held):
                end = at
                while end < len(held) and bounds[end] == bounds[at]:
                    end += 1
                shared, rests = front_code([s for s, _, _ in held[at:end]])
                lefts = [x for _, x, _ in held[at:end]]
                yield pa.RecordBatch.from_pylist(
                    [
                        {
                            "part": bounds[at],
                            "shared": bytes(shared),
                            "rests": b"".join(rests),
                            "rest_sizes": _lengths(rests),
                            "lefts": b"".join(lefts),
                            "left_sizes": _lengths(lefts),
                            "numbers": np.array([x for _, _, x in held[at:end]], np.int64).tobytes(),
                        }
                    ],
                    schema=pa.schema([("part", pa.int32()), *[(n, pa.binary()) for n in ("shared", "rests", "rest_sizes", "lefts", "left_sizes", "numbers")]]),
                )
                at = end
            held.clear()

        for batch in batches:
            for number, row, text, raw in zip(batch.column("id").to_pylist(), batch.column("row").to_pylist(), byte_views(batch.column("text")), batch.column("marks")):
                for anchor, _, start, windows, reach in np.frombuffer(raw.as_buffer(), RECORD).tolist():
                    place, least = start + reach, reach - windows + 1
                    right = bytes(text[place + ANCHOR : place + length - least])
                    held.append(((anchor & (1 << 64) - 1).to_bytes(8, "big") + right, bytes(text[start:place])[::-1], (number, row, place, least, reach)))
                if len(held) >= RUN:
                    yield from out()
        yield from out()

    return run


def repeated_windows(shared: np.ndarray, padded: np.ndarray, numbers: np.ndarray, length: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Row, start and end of all stretches of repeats among sorted suffixes.

    For a window that begins ``o`` bytes before its anchor, suffixes that share what it has on the right stand
    together (``shared`` counts the hash's eight bytes, too). ``padded`` holds the bytes to the left, backwards. Those that have the same ``o`` bytes on the left as well hold the same
    window; the earliest keeps it.
    """
    n, span = len(padded), length - ANCHOR
    number, row, place, least, most = numbers.T
    rank = np.empty(n, np.int64)
    rank[np.lexsort((place, row, number))] = np.arange(n)
    code = _code()
    left = np.zeros(n, np.uint64)
    marked = np.zeros((n, span + 2), bool)
    for o in range(span + 1):
        if o:
            left = mix(left + code[padded[:, o - 1]]) * np.uint64(_WIDE)
        group = np.cumsum(shared < 8 + span - o)
        own = np.flatnonzero((least <= o) & (o <= most))
        order = own[np.lexsort((rank[own], left[own], group[own]))]
        again = (group[order][1:] == group[order][:-1]) & (left[order][1:] == left[order][:-1])
        marked[order[1:][again], span - o + 1] = True  # from left to right: the largest offset begins first
    change = np.diff(marked.astype(np.int8), axis=1, append=0)
    which, begin = np.nonzero(change == 1)
    _, end = np.nonzero(change == -1)
    # Column c + 1 is offset span - c, so the window begins at place - span + c.
    return row[which], place[which] - span + begin, place[which] - span + end - 1 + length


def _merge_ranges(length: int):
    def one(rows: list[dict]) -> pa.RecordBatch:
        runs = [(r["shared"], _split(r["rests"], r["rest_sizes"])) for r in rows]
        first = np.cumsum([0] + [len(r["shared"]) for r in rows])
        order, shared = array("q"), array("q")
        for r, i, n in merge_runs(runs):
            order.append(first[r] + i)
            shared.append(n)
        del runs
        order, shared = np.frombuffer(order, np.int64), np.array(shared, np.int64)
        shared[:1] = 0
        sizes = np.frombuffer(b"".join(r["left_sizes"] for r in rows), np.uint8).astype(np.int64)
        lefts = np.zeros((len(sizes), length - ANCHOR), np.uint8)
        at = np.repeat(np.cumsum(sizes) - sizes, sizes)
        lefts[np.repeat(np.arange(len(sizes)), sizes), np.arange(len(at)) - at] = np.frombuffer(b"".join(r["lefts"] for r in rows), np.uint8)
        numbers = np.frombuffer(b"".join(r["numbers"] for r in rows), np.int64).reshape(-1, 5)
        row, start, end = repeated_windows(shared, lefts[order], numbers[order], length)
        order = np.argsort(row, kind="stable")
        row, start, end = row[order], start[order], end[order]
        cuts = np.flatnonzero(np.diff(row, prepend=-1))
        spans = [_join_spans(start[i:j], end[i:j]).tobytes() for i, j in zip(cuts, np.append(cuts[1:], len(row)))]
        return pa.RecordBatch.from_arrays([pa.array(row[cuts]), pa.array(spans, pa.binary())], names=["row", "spans"])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part, rows = None, []
        for batch in batches:
            for r in batch.to_pylist():
                if r["part"] != part and rows:
                    yield one(rows)
                    rows = []
                part = r["part"]
                rows.append(r)
        if rows:
            yield one(rows)

    return run


def _window_hashes(length: int):
    """Two hashes of every window of marked anchors, for anchors with very many contexts."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        code = _code()
        for batch in batches:
            for number, row, text, raw in zip(batch.column("id").to_pylist(), batch.column("row").to_pylist(), byte_views(batch.column("text")), batch.column("marks")):
                for _, _, start, n, _ in np.frombuffer(raw.as_buffer(), RECORD).tolist():
                    data = np.frombuffer(text[start : start + n - 1 + length], np.uint8)
                    at = np.arange(n)
                    a, b = (_spans_hash(data, at, at + length, code, base) for base in (_WIDE, _BASE))
                    yield pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64)), pa.array(np.full(n, number)), pa.array(np.full(n, row)), pa.array((at + start).astype(np.int32))], names=["a", "b", "id", "row", "start"])

    return run


def _single_spans(length: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            start = batch.column("start").to_numpy()
            yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array([x.tobytes() for x in np.stack([start, start + length], 1).astype(np.int64)], pa.binary())], names=["row", "spans"])

    return run


def _cut(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Maximal removed runs of a document from its spans, and what is left."""
    for batch in batches:
        removed, runs, digests, kept = [], [], [], []
        for text, spans, is_copy in zip(byte_views(batch.column("text")), batch.column("spans"), batch.column("is_copy").to_pylist()):
            at, left, n, total = 0, [], 0, 0
            digest = hashlib.sha256()
            marks = [(0, len(text))] if is_copy else np.frombuffer(spans.as_buffer(), np.int64).reshape(-1, 2).tolist() if spans.is_valid else []
            for a, b in marks:
                left.append(text[at:a])
                at, n, total = b, n + 1, total + b - a
            left.append(text[at:])
            for x in left:
                digest.update(x)
            removed.append(total)
            runs.append(n)
            digests.append(digest.hexdigest())
            kept.append(b"".join(left))
        yield pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array([len(t) for t in byte_views(batch.column("text"))], pa.int64()), pa.array(removed, pa.int64()), pa.array(runs, pa.int64()), pa.array(digests, pa.string()), pa.array(kept, pa.binary())], names=["doc_id", "n_bytes", "n_removed", "n_spans", "kept_sha256", "kept"])


def _union_spans(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        out = []
        for lists in batch.column("spans"):
            spans = np.frombuffer(b"".join(x.as_py() for x in lists.values), np.int64).reshape(-1, 2)
            out.append(_join_spans(spans[:, 0], spans[:, 1]).tobytes())
        yield pa.RecordBatch.from_arrays([batch.column("row"), pa.array(out, pa.binary())], names=["row", "spans"])


def remove_repeats(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", length: int = LENGTH, many: int = MANY) -> DataFrame:
    """One row per document: doc_id, n_bytes, n_removed, n_spans, kept_sha256, kept (the remaining bytes).

    ``doc_id`` must be an integer column. Null texts are empty; texts shorter than ``length`` keep everything. Repeated rows
    are documents of their own, of which the first as stored is the earlier. An empty table gives an empty result.
    """
    spark = docs.sparkSession
    scratch = Scratch(spark, "suffix")
    last = (1 << 63) - 1
    plain = F.coalesce(col(text).cast("string"), F.lit(""))
    source = scratch.stage(docs.select(F.monotonically_increasing_id().alias("row"), col(doc_id).alias("doc_id"), F.coalesce(col(doc_id).cast("long"), F.lit(last)).alias("id"), plain.alias("text"), F.unhex(F.md5(plain)).alias("digest")), "zstd")

    # Whole copies of an earlier document are repeats from end to end. While they are few enough to be broadcast, they are not looked at again.
    whole = source.filter(F.octet_length("text") >= length)
    same = whole.groupBy("digest").agg(F.min(F.struct("id", "row")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("digest", F.col("first.row").alias("first_row"))
    same = scratch.stage(same)
    copies = scratch.stage(whole.select("row", "digest").join(broadcast_if_small(same, same.count(), 96), "digest").filter("row != first_row").select("row"))
    n_copies = copies.count()
    if 0 < n_copies * 48 <= MAX_BROADCAST_BYTES:
        whole = whole.join(F.broadcast(copies), "row", "left_anti")

    counted = whole.select("text").mapInArrow(_count_anchors(length), "anchor long, n int").groupBy("anchor").agg(F.sum("n").alias("n")).filter("n > 1")
    spot = F.col("anchor").bitwiseAND(F.lit(TABLE_BITS - 1))
    blocks = counted.select(spot.alias("spot")).groupBy(F.shiftright("spot", 15).alias("block")).agg(F.bitmap_construct_agg(F.col("spot").bitwiseAND(F.lit(32767))).alias("bits"))
    bits = np.zeros(TABLE_BITS // 8, np.uint8)
    for r in blocks.toLocalIterator():
        bits[r["block"] * 4096 : r["block"] * 4096 + 4096] = np.frombuffer(r["bits"], np.uint8)
    table = spark.sparkContext.broadcast(bits)

    found = scratch.stage(whole.select("id", "row", "text").mapInArrow(_contexts(length, table), "id long, row long, records binary"))
    table.destroy()
    each = found.mapInArrow(_unpack, "anchor long, context long, id long, row long, start int, windows int, reach int")
    folded = scratch.stage(each.groupBy("anchor", "context").agg(F.min(F.struct("id", "row", "start", "windows", "reach")).alias("first")).select("anchor", "first.row", "first.start", "first.windows", "first.reach"))
    several = scratch.stage(folded.groupBy("anchor").agg(F.count(F.lit(1)).alias("contexts")).filter("contexts > 1"))
    marked = folded.join(several, "anchor", "left").withColumn("contexts", F.coalesce("contexts", F.lit(1)))
    firsts = marked.groupBy("row").agg(F.collect_list(F.struct("anchor", "start", "windows", "reach", (F.col("contexts").between(2, many)).alias("several"))).alias("firsts"))
    by_row = scratch.stage(firsts.mapInArrow(_pack_firsts, "row long, starts binary, marks binary"))
    scratch.drop(folded)

    def sized(df: DataFrame, *columns: str) -> DataFrame:
        """``df`` for broadcasting if its measured bytes allow it."""
        sizes = [F.coalesce(F.octet_length(c), F.lit(0)).cast("long") for c in columns]
        rows, total = df.agg(F.count(F.lit(1)), F.coalesce(F.sum(sum(sizes, F.lit(0))), F.lit(0))).first()
        return broadcast_if_small(df, total + 64 * rows, 1)

    spans = [found.join(sized(by_row.select("row", "starts"), "starts"), "row", "left").select("row", "records", "starts").mapInArrow(_copy_spans(length), "row long, spans binary")]
    marks = by_row.filter("marks is not null").select("row", "marks")
    total = several.filter(F.col("contexts") <= many).agg(F.coalesce(F.sum("contexts"), F.lit(0))).first()[0]
    parts = max(1, min(-(-total // RANGE), 65536))
    texts = source.select("id", "row", "text")
    runs = texts.join(sized(marks, "marks"), "row").mapInArrow(_sorted_runs(length, parts), RUN_TYPE)
    spans.append(runs.repartition(parts, "part").sortWithinPartitions("part").mapInArrow(_merge_ranges(length), "row long, spans binary"))
    hot = several.filter(F.col("contexts") > many)
    if not hot.isEmpty():
        # The same records once more, of the anchors with very many contexts only.
        crowd = each.groupBy("anchor", "context").agg(F.min(F.struct("id", "row", "start", "windows", "reach")).alias("first")).select("anchor", "first.*").join(hot, "anchor")
        packed = scratch.stage(crowd.groupBy("row").agg(F.collect_list(F.struct("anchor", "start", "windows", "reach", F.lit(True).alias("several"))).alias("firsts")).mapInArrow(_pack_firsts, "row long, starts binary, marks binary"))
        windows = scratch.stage(texts.join(sized(packed.select("row", "marks"), "marks"), "row").mapInArrow(_window_hashes(length), "a long, b long, id long, row long, start int"))
        first = scratch.stage(windows.groupBy("a", "b").agg(F.min(F.struct("id", "row", "start")).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1").select("a", "b", F.col("first.row").alias("first_row"), F.col("first.start").alias("first_start")))
        again = windows.join(first, ["a", "b"]).filter("row != first_row or start != first_start").select("row", F.col("start").cast("long").alias("start"))
        spans.append(again.mapInArrow(_single_spans(length), "row long, spans binary"))

    every = spans[0]
    for s in spans[1:]:
        every = every.unionByName(s)
    joined = scratch.stage(every.groupBy("row").agg(F.collect_list("spans").alias("spans")).mapInArrow(_union_spans, "row long, spans binary"))
    kind = source.schema["doc_id"].dataType.simpleString()
    flagged = source.select("row", "doc_id", "text").join(sized(joined, "spans"), "row", "left").join(broadcast_if_small(copies.withColumn("is_copy", F.lit(True)), n_copies, 48), "row", "left")
    return flagged.select("doc_id", "text", "spans", F.coalesce("is_copy", F.lit(False)).alias("is_copy")).mapInArrow(_cut, f"doc_id {kind}, n_bytes long, n_removed long, n_spans long, kept_sha256 string, kept binary")
