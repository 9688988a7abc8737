"""Periodic runs of words: stretches that repeat a period several times, found in every text, and texts without the repeats.

A run is a stretch of words with smallest period q that no neighbouring word extends. Every run holds its root, the
period's Lyndon rotation, as a longest Lyndon word at some position, under the order of the words or under the reversed
one. So the roots are read off the two *Lyndon arrays*, which are what phase one of Baier's suffix sorter leaves behind: it
groups suffixes by a growing common prefix, takes the groups from the highest to the lowest, and appends each group's
prefix to that of the suffix before it that is still in a lower group; at the end each suffix's prefix is the longest Lyndon word there.
Each root is *extended* to both sides by the longest common extension of its two ends (binary search over prefix
hashes of all roots at once). Every run is then checked word by word, so a clash of hashes changes no result.

Before that, stretches that cannot hold a run are left out, exactly: in a run of E periods and more each triple of
words occurs E - 1 times, so a stretch is cut at every triple that it holds less often, until nothing is left to
cut. Ordinary prose leaves next to nothing.

A task works on texts one slice after the other; nothing is shuffled. Words are what stands between ASCII blanks. Null and
empty texts have no words, no runs and the empty text as their remainder. Repeated rows are searched each; a repeated id is allowed; other columns are not
passed on. No rows give no rows.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwise.llm.common import PLACE, WordHasher, bound_batches, byte_views, mix, numbered, slices
from panelwise.runtime import col

RUNS = T.ArrayType(T.StructType([T.StructField(n, T.LongType()) for n in ("start", "length", "period")]))
#: Words joined at a time.
CHUNK = 1 << 16


def lyndon_lengths(ranks: Sequence[int]) -> list[int]:
    """The length of the longest Lyndon word that starts at each place; ``ranks`` are numbers from 0 without gaps.

    ``group`` holds each suffix's group; groups are a list from low to high, linked both ways. A suffix whose group has been
    taken is closed, and ``open_at`` leads from it to the nearest open suffix before it (places count from 1 there, 0 is none).
    """
    n = len(ranks)
    group, size = list(ranks), [1] * n
    count = max(group, default=-1) + 1
    members: list[list[int]] = [[] for _ in range(count)]
    for i, g in enumerate(group):
        members[g].append(i)
    prefix = [1] * count
    lower, higher = list(range(-1, count - 1)), [*range(1, count), -1]
    open_at = list(range(n + 1))
    g = count - 1
    while g >= 0:
        own = [i for i in members[g] if group[i] == g]
        for i in own:
            open_at[i + 1] = i
        followed: dict[int, int] = {}
        for i in own:
            x = i
            while open_at[x] != x:
                open_at[x] = x = open_at[open_at[x]]
            if x:
                followed[x - 1] = followed.get(x - 1, 0) + 1
        if followed:
            length = prefix[g]
            parts: dict[tuple[int, int], list[int]] = {}
            for i, times in followed.items():
                size[i] += times * length
                parts.setdefault((group[i], times), []).append(i)
            # What is followed more often is higher; each new group stands right above the one it leaves.
            under, left = -1, -1
            for old, times in sorted(parts):
                under = under if left == old else old
                left, new = old, len(members)
                moved = parts[old, times]
                members.append(moved)
                for i in moved:
                    group[i] = new
                prefix.append(prefix[old] + times * length)
                lower.append(under)
                higher.append(higher[under])
                if higher[under] >= 0:
                    lower[higher[under]] = new
                higher[under] = new
                under = new
        g = lower[g]
    return size


class Extender:
    """Longest common extensions in a string of 64-bit codes, for many pairs of places at once."""

    def __init__(self, codes: np.ndarray):
        n = len(codes)
        self.power = np.cumprod(np.full(n + 1, WordHasher.BASE, np.uint64))
        self.inverse = np.cumprod(np.full(n + 1, pow(WordHasher.BASE, -1, 1 << 64), np.uint64))
        self.total = np.zeros(n + 1, np.uint64)
        np.cumsum(codes * self.power[:n], out=self.total[1:])

    def _hash(self, at: np.ndarray, size: np.ndarray) -> np.ndarray:
        return (self.total[at + size] - self.total[at]) * self.inverse[at]

    def _search(self, most: np.ndarray, same) -> np.ndarray:
        found = np.zeros(len(most), np.int64)
        for bit in reversed(range(int(most.max(initial=0)).bit_length())):
            tried = found + (1 << bit)
            open_ = np.flatnonzero(tried <= most)
            good = open_[same(open_, tried[open_])]
            found[good] = tried[good]
        return found

    def right(self, a: np.ndarray, b: np.ndarray, end: np.ndarray) -> np.ndarray:
        """How many codes from ``a`` and from ``b`` > ``a`` on are equal, before ``end``."""
        return self._search(end - b, lambda k, d: self._hash(a[k], d) == self._hash(b[k], d))

    def left(self, a: np.ndarray, b: np.ndarray, begin: np.ndarray) -> np.ndarray:
        """How many codes before ``a`` and before ``b`` are equal, from ``begin`` on."""
        return self._search(a - begin, lambda k, d: self._hash(a[k] - d, d) == self._hash(b[k] - d, d))


def stretches(words: np.ndarray, bounds: np.ndarray, least: int, times: int) -> list[tuple[int, int, int]]:
    """(text, begin, end) of the stretches of words that may hold runs of ``least`` words and ``times`` periods."""
    texts = np.repeat(np.arange(len(bounds) - 1), np.diff(bounds))
    # A triple occurs in a run once a period, except in the last two words; with period 1 at all places but two.
    often = min(times - 1, max(least, times) - 2)
    if often < 2:
        return [(t, int(a), int(b)) for t, (a, b) in enumerate(zip(bounds, bounds[1:])) if b - a >= least]
    n = max(len(words) - 2, 0)
    triple = mix(words[:n] * PLACE[0] + words[1 : n + 1] * PLACE[1] + words[2:] * PLACE[2])
    at = np.flatnonzero(texts[:n] == texts[2:]) if n else np.zeros(0, np.int64)
    part = texts[at]
    while len(at):
        # A clash of hashes lets a stretch stay; it is searched, then.
        _, which, counts = np.unique(triple[at] ^ mix(part.astype(np.uint64) * PLACE[3]), return_inverse=True, return_counts=True)
        good = counts[which] >= often
        if good.all():
            break
        at, part = at[good], part[good]
        new = np.flatnonzero(np.concatenate(([True], (np.diff(at) > 1) | (np.diff(part) > 0)))) if len(at) else at
        sizes = np.diff(np.append(new, len(at)))
        part = np.repeat(np.arange(len(new)), sizes)
        long = np.repeat(sizes >= max(least, times) - 2, sizes)
        at, part = at[long], part[long]
    if not len(at):
        return []
    new = np.flatnonzero(np.concatenate(([True], np.diff(part) > 0)))
    last = np.append(new[1:], len(at)) - 1
    return [(int(texts[a]), int(a), int(b) + 3) for a, b in zip(at[new], at[last])]


def runs_in(parts: list[np.ndarray], least: int, times: int) -> list[list[tuple[int, int, int]]]:
    """The runs (start, length, period) of each of some strings of numbers, by start and period."""
    begins = np.cumsum([0] + [len(p) for p in parts])
    codes = [np.unique(p, return_inverse=True)[1] for p in parts]
    whole = np.concatenate([np.zeros(0, np.int64), *codes])
    found = []
    for k, own in enumerate(codes):
        if not len(own):
            continue
        ranks, top = own.tolist(), int(own.max())
        for order in (ranks, [top - r for r in ranks]):
            root = np.array(lyndon_lengths(order), np.int64)
            i = np.flatnonzero(root * times <= len(own))
            found.append(np.stack([np.full(len(i), k), i + begins[k], root[i]], 1))
    if not found:
        return [[] for _ in parts]
    k, i, q = np.unique(np.concatenate(found), axis=0).T
    extend = Extender(numbered(int(whole.max()) + 1, 31)[whole])
    begin, end = begins[k], begins[k + 1]
    first = i - extend.left(i, i + q, begin)
    last = i + q + extend.right(i, i + q, end)
    long = last - first >= np.maximum(least, times * q)
    out: list[list[tuple[int, int, int]]] = [[] for _ in parts]
    claims, which = np.unique(np.stack([k, first, last, q], 1)[long], axis=0, return_inverse=True)
    for c, (k, a, b, q) in enumerate(claims.tolist()):
        wrong = np.flatnonzero(whole[a : b - q] != whole[a + q : b]) + a
        spans = {(a, b)}
        if len(wrong):
            # Hashes clashed: each root reaches from the last difference before it to the first one behind.
            at = i[long][which.ravel() == c]
            place = np.searchsorted(wrong, at)
            spans = set(zip((np.append(a - 1, wrong)[place] + 1).tolist(), (np.append(wrong, b - q)[place] + q).tolist()))
        out[k] += [(x - int(begins[k]), y - x, q) for x, y in spans if y - x >= max(least, times * q)]
    return [sorted(set(o), key=lambda r: (r[0], r[2])) for o in out]


class _Words:
    """The words of one text as numbers, and back."""

    def __init__(self, hasher: WordHasher, text: memoryview):
        known: dict[bytes, int] = {}
        number = lambda w: known.setdefault(w, len(known))
        parts = [np.fromiter(map(number, bytes(p).split()), np.int32) for p in hasher._cut(np.frombuffer(text, np.uint8))]
        self.ids = np.concatenate([np.zeros(0, np.int32), *parts])
        self.words = list(known)

    def joined(self, kept: np.ndarray) -> bytes:
        ids, word = self.ids[kept], self.words.__getitem__
        return b" ".join(b" ".join(map(word, ids[x : x + CHUNK].tolist())) for x in range(0, len(ids), CHUNK))


def _plain(hasher: WordHasher, text: memoryview) -> bytes:
    return b" ".join(x for x in (b" ".join(bytes(p).split()) for p in hasher._cut(np.frombuffer(text, np.uint8))) if x)


def _search(least: int, times: int):
    hasher = WordHasher()
    hasher.code = numbered(256, 11)  # capital letters count

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            views = byte_views(batch.column("text"))
            for first, last in slices([len(v) for v in views]):
                own = views[first:last]
                words, bounds = hasher.words(own)
                found = stretches(words, bounds, least, times)
                texts = {t: _Words(hasher, own[t]) for t in {t for t, _, _ in found}}
                runs: list[list[tuple[int, int, int]]] = [[] for _ in own]
                begins = [a - int(bounds[t]) for t, a, _ in found]
                spans = [texts[t].ids[a : a + e - b] for (t, b, e), a in zip(found, begins)]
                for (t, _, _), a, own_runs in zip(found, begins, runs_in(spans, least, times)):
                    runs[t] += [(a + s, n, q) for s, n, q in own_runs]
                left = []
                for t, text in enumerate(own):
                    if not runs[t]:
                        left.append(_plain(hasher, text))
                        continue
                    cover = np.zeros(len(texts[t].ids) + 1, np.int32)
                    for s, n, q in runs[t]:
                        cover[s + q] += 1
                        cover[s + n] -= 1
                    left.append(texts[t].joined(np.cumsum(cover[:-1]) == 0))
                rows = [[{"start": s, "length": n, "period": q} for s, n, q in r] for r in runs]
                yield pa.RecordBatch.from_arrays(
                    [batch.column("doc_id").slice(first, last - first), pa.array(rows, pa.list_(pa.struct([(n, pa.int64()) for n in ("start", "length", "period")]))), pa.array([x.decode("utf-8", "replace") for x in left], pa.string())],
                    names=["doc_id", "runs", "collapsed"],
                )

    return run


def find_runs(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", min_length: int = 6, min_periods: int = 4) -> DataFrame:
    """(doc_id, runs, collapsed): the runs of ``min_length`` words and ``min_periods`` periods or more, by start and period, and the text without the words that a run repeats.

    ``collapsed`` holds the words, joined by one space, that no run contains after its first period.
    """
    if min_periods < 2 or min_length < 2:
        raise ValueError("a run has two periods and two words at least")
    bound_batches(docs.sparkSession)
    rows = docs.select(col(doc_id).alias("doc_id"), col(text).cast("string").alias("text"))
    schema = T.StructType([rows.schema["doc_id"], T.StructField("runs", RUNS), T.StructField("collapsed", T.StringType())])
    return rows.mapInArrow(_search(min_length, min_periods), schema)
