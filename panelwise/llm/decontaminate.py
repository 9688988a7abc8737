"""Benchmark decontamination by greedy string tiling.

A document is contaminated when disjoint runs of at least ``least`` words, each found in the document, together cover
``coverage`` of a benchmark item's words. The runs may stand in any order, so reordered passages are caught.

1. Seeds: every run of ``least`` words of a document that may occur in the benchmark (a small bit table sorts out
   nearly all others in the tasks that read the texts) is joined with the benchmark's runs.
2. Tiles can only cover words that seeds cover. Pairs whose seeds cover too little are dropped, which is exact.
3. The remaining pairs are tiled: running Karp-Rabin hashes find the longest matches of words not yet taken,
   longest first, until no match of ``least`` words is left.

Words are runs of letters and digits, A-Z as a-z; punctuation, blanks and symbols of all scripts part them, so a passage is also found with
other quotes and dashes. Equal texts are judged once. The benchmark is joined, not collected;
it is broadcast only if its seeds are few enough.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwise.llm.common import NO_LETTERS, PLACE, Scratch, WordHasher, broadcast_if_small, byte_views, col, fresh, shingles, slices

MIN_TILE = 5
COVERAGE = 0.6
#: Bits of the table that sorts out runs of words that no benchmark item has.
SIEVE_BITS = 1 << 24


def parted(text: Column) -> Column:
    """The text with a blank for what parts words beyond ASCII, which the hasher knows itself."""
    return F.regexp_replace(text, "[\\p{P}\\p{Z}\\p{S}&&[^\\x00-\\x7F]]+", " ")


def _runs(words: np.ndarray, length: int) -> np.ndarray:
    """Karp-Rabin hashes of all runs of ``length`` words, each from its neighbour's by prefix sums."""
    n = len(words) - length + 1
    if n <= 0:
        return np.zeros(0, np.uint64)
    base = int(PLACE[0])
    power = np.cumprod(np.full(len(words), base, np.uint64))
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(words * power)))
    inverse = np.cumprod(np.full(n, pow(base, -1, 1 << 64), np.uint64))
    return (total[length : length + n] - total[:n]) * inverse


def _matches(item: np.ndarray, doc: np.ndarray, free_item: np.ndarray, free_doc: np.ndarray, length: int) -> list[tuple[int, int, int]]:
    """All maximal (size, item start, doc start) of at least ``length`` free words, that begin with a run found by hash."""

    def open_starts(words: np.ndarray, free: np.ndarray) -> np.ndarray:
        taken = np.concatenate(([0], np.cumsum(~free)))
        n = len(words) - length + 1
        return np.flatnonzero(taken[length : length + n] == taken[:n]) if n > 0 else np.zeros(0, np.int64)

    a, b = open_starts(item, free_item), open_starts(doc, free_doc)
    if not len(a) or not len(b):
        return []
    ha, hb = _runs(item, length)[a], _runs(doc, length)[b]
    b, hb = b[np.isin(hb, ha)], hb[np.isin(hb, ha)]
    table: dict[int, list[int]] = {}
    for h, i in zip(ha.tolist(), a.tolist()):
        table.setdefault(h, []).append(i)
    found = []
    for h, j in zip(hb.tolist(), b.tolist()):
        for i in table[h]:
            if i and j and free_item[i - 1] and free_doc[j - 1] and item[i - 1] == doc[j - 1]:
                continue  # not maximal: found from the place before
            size = 0
            while i + size < len(item) and j + size < len(doc) and free_item[i + size] and free_doc[j + size] and item[i + size] == doc[j + size]:
                size += 1
            if size >= length:
                found.append((size, i, j))
    return found


def tile(item: np.ndarray, doc: np.ndarray, least: int) -> int:
    """How many of the item's words disjoint common runs of at least ``least`` words cover, the longest taken first."""
    free_item, free_doc = np.ones(len(item), bool), np.ones(len(doc), bool)
    length = max(least, len(item) // 2)
    while True:
        again = False
        for size, i, j in sorted(_matches(item, doc, free_item, free_doc, length), key=lambda m: (-m[0], m[1], m[2])):
            if free_item[i : i + size].all() and free_doc[j : j + size].all():
                free_item[i : i + size] = False
                free_doc[j : j + size] = False
            else:
                again = True  # what a longer tile left of it counts in the next search of this length
        if again and _matches(item, doc, free_item, free_doc, length):
            continue
        if length == least:
            return int((~free_item).sum())
        length = max(least, length // 2)


def _seeds(least: int, sieve: np.ndarray):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher, bits = WordHasher(NO_LETTERS), np.unpackbits(sieve, bitorder="little").view(bool)
        for batch in batches:
            texts = byte_views(batch.column("text"))
            for first, last in slices([len(t) for t in texts]):
                words, bounds = hasher.words(texts[first:last])
                found, at = shingles(words, bounds, least)
                hit = np.flatnonzero(bits[found & np.uint64(SIEVE_BITS - 1)] & bits[(found >> np.uint64(32)) & np.uint64(SIEVE_BITS - 1)])
                owner = np.searchsorted(at, hit, "right") - 1
                hashes = found[hit]
                order = np.lexsort((hashes, owner))
                hashes, owner = hashes[order], owner[order]
                new = np.ones(len(order), bool)
                new[1:] = (hashes[1:] != hashes[:-1]) | (owner[1:] != owner[:-1])
                yield pa.RecordBatch.from_arrays([batch.column("text_key").take(pa.array(owner[new] + first)), pa.array(hashes[new].view(np.int64))], names=["text_key", "seed"])

    return run


def _item_seeds(least: int):
    """(item, words, place, seed) for every run of ``least`` words of every item; shorter items have too little to go by."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(NO_LETTERS)
        for batch in batches:
            texts = byte_views(batch.column("text"))
            for first, last in slices([len(t) for t in texts]):
                words, bounds = hasher.words(texts[first:last])
                for n in range(last - first):
                    own = words[bounds[n] : bounds[n + 1]]
                    if len(own) < least:
                        continue
                    found, _ = shingles(own, np.array([0, len(own)]), least)
                    yield pa.RecordBatch.from_arrays(
                        [batch.column("item").take(pa.array(np.full(len(found), first + n))), pa.array(np.full(len(found), len(own), np.int32)), pa.array(np.arange(len(found), dtype=np.int32)), pa.array(found.view(np.int64))],
                        names=["item", "words", "place", "seed"],
                    )

    return run


def _tiles(least: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher(NO_LETTERS)
        for batch in batches:
            items, docs = byte_views(batch.column("item_text")), byte_views(batch.column("text"))
            covered = [tile(hasher.words([i])[0], hasher.words([d])[0], least) for i, d in zip(items, docs)]
            yield pa.RecordBatch.from_arrays([batch.column("text_key"), batch.column("item"), batch.column("words"), pa.array(covered, pa.int32())], names=["text_key", "item", "words", "covered"])

    return run


def contaminated_texts(docs: DataFrame, benchmark: DataFrame, text: str = "text", item_id: str = "item_id", item_text: str = "text", least: int = MIN_TILE, coverage: float = COVERAGE, scratch: Scratch | None = None) -> DataFrame:
    """(text_key, item, covered share) for every distinct text and benchmark item that it contains; see the module.

    ``text_key`` is the MD5 of the text (null counts as empty, which contains nothing). Items with fewer than
    ``least`` words, or null, are not searched for. Items with the same id are searched for separately.
    """
    scratch = scratch or Scratch(docs.sparkSession, "decontaminate")
    items = scratch.stage(benchmark.select(F.monotonically_increasing_id().alias("item"), col(item_id).alias("item_id"), parted(F.coalesce(col(item_text).cast("string"), F.lit(""))).alias("text")))
    seeds = scratch.stage(items.select("item", "text").mapInArrow(_item_seeds(least), "item long, words int, place int, seed long"))
    # Two bits per seed, gathered by position: the table's size is fixed, whatever the benchmark's.
    spots = seeds.select(F.explode(F.array(F.col("seed").bitwiseAND(F.lit(SIEVE_BITS - 1)), F.shiftrightunsigned("seed", 32).bitwiseAND(F.lit(SIEVE_BITS - 1)))).alias("spot"))
    blocks = spots.groupBy((F.shiftright("spot", 15)).alias("block")).agg(F.bitmap_construct_agg(F.col("spot").bitwiseAND(F.lit(32767)).cast("long")).alias("bits"))
    sieve = np.zeros(SIEVE_BITS // 8, np.uint8)
    for row in blocks.toLocalIterator():
        sieve[row["block"] * 4096 : (row["block"] + 1) * 4096] = np.frombuffer(row["bits"], np.uint8)

    plain = F.coalesce(col(text).cast("string"), F.lit(""))
    source = docs.select(F.unhex(F.md5(plain)).alias("text_key"), parted(plain).alias("text"))
    count = seeds.count()
    hits = source.mapInArrow(_seeds(least, sieve), "text_key binary, seed long").join(broadcast_if_small(seeds, count, 48), "seed")
    covered = F.size(F.array_distinct(F.flatten(F.transform("places", lambda p: F.sequence(p, p + (least - 1))))))
    likely = scratch.stage(hits.groupBy("text_key", "item", "words").agg(F.collect_set("place").alias("places")).filter(covered >= coverage * F.col("words")).select("text_key", "item", "words"))
    wanted = scratch.stage(likely.select("text_key").distinct())
    texts = source.join(broadcast_if_small(wanted, wanted.count(), 64), "text_key").groupBy("text_key").agg(F.first("text").alias("text"))
    pairs = likely.join(texts, "text_key").join(broadcast_if_small(items.select("item", F.col("text").alias("item_text")), count, 64), "item")
    tiled = pairs.select("text_key", "text", "item", "item_text", "words").mapInArrow(_tiles(least), "text_key binary, item long, words int, covered int")
    found = tiled.filter(F.col("covered") >= coverage * F.col("words")).select("text_key", "item", (F.col("covered") / F.col("words")).alias("share"))
    return scratch.stage(found.join(items.select("item", "item_id"), "item").select("text_key", "item_id", "share"))


def contamination(docs: DataFrame, benchmark: DataFrame, doc_id: str = "doc_id", **options) -> DataFrame:
    """One row per document: doc_id, contaminated, n_items (benchmark items found in it), item_id (the one covered most), coverage.

    Of items covered alike the smallest id is named. Clean documents have n_items 0, and null for the others.
    """
    text = options.get("text", "text")
    scratch = Scratch(docs.sparkSession, "decontaminate")
    found = contaminated_texts(docs, benchmark, scratch=scratch, **options)
    best = F.min(F.struct((-F.col("share")).alias("share"), F.col("item_id").isNull().alias("no_id"), F.col("item_id").alias("item_id")))
    by_text = scratch.stage(found.groupBy("text_key").agg(F.count(F.lit(1)).alias("n_items"), best.alias("best")).select("text_key", "n_items", "best.item_id", (-F.col("best.share")).alias("coverage")))
    keyed = docs.select(col(doc_id).alias("doc_id"), F.unhex(F.md5(F.coalesce(col(text).cast("string"), F.lit("")))).alias("text_key"))
    joined = keyed.join(broadcast_if_small(by_text, by_text.count(), 96), "text_key", "left")
    return joined.select("doc_id", F.col("n_items").isNotNull().alias("contaminated"), F.coalesce("n_items", F.lit(0)).alias("n_items"), "item_id", "coverage")


def decontaminate(docs: DataFrame, benchmark: DataFrame, **options) -> DataFrame:
    """The documents that contain no benchmark item, with all their columns."""
    text = options.get("text", "text")
    (key,) = fresh(docs, "_text_key")
    scratch = Scratch(docs.sparkSession, "decontaminate")
    found = contaminated_texts(docs, benchmark, scratch=scratch, **options)
    bad = scratch.stage(found.select(F.col("text_key").alias(key)).distinct())
    keyed = docs.withColumn(key, F.unhex(F.md5(F.coalesce(col(text).cast("string"), F.lit("")))))
    return keyed.join(broadcast_if_small(bad, bad.count(), 64), key, "left_anti").select(*[col(c) for c in docs.columns])
