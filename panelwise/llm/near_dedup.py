"""Near duplicates: MinHash signatures, banding, verified links, connected components.

A document's set holds its distinct shingles of ``k`` words (a shorter text is one shingle). Two documents are
linked when ``100 * |intersection| >= percent * |union|``. Documents with the same set are folded into one node
first, so copies never meet each other pairwise.

1. Each task hashes the shingles with numpy and takes the minima of 200 universal hash functions, in 40 bands of 5.
   A pair at similarity s shares no band with probability (1 - s^5)^40: 1e-7 at 0.80, 7e-11 at 0.85.
2. Every member of a band's bucket is paired with the bucket's smallest node only, so pairs grow with members.
   Pairs whose signatures agree too little are dropped (six standard deviations below the threshold); the
   others are confirmed on their full sets. The links' components are found by large-star and small-star.
3. Buckets that still hold several components are searched in full: their members go to tasks in blocks, each pair of
   blocks to one task, and a task skips what is already connected. So no link is lost to step 2's shortcut.
   Blocks of the bucket's largest component do not meet each other, so the work is the members times those left
   outside of it. Buckets with the same members are searched once.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwise.llm.common import PLACE, Scratch, WordHasher, broadcast_if_small, byte_views, col, keep_rows, mix, numbered, row_key, shingles, slices
from panelwise.llm.components import components

BANDS, ROWS = 40, 5
#: Members of a block in step 3; a task holds two blocks.
BLOCK = 512


def minima(hashes: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """The smallest value of each hash function over each (non-empty) run of ``hashes``, as 32-bit numbers."""
    n = BANDS * ROWS
    a, b = numbered(n, 1000) | np.uint64(1), numbered(n, 5000)
    low = hashes & np.uint64(0xFFFFFFFF)
    out = np.empty((n, len(bounds) - 1), np.uint32)
    starts = bounds[:-1]
    value = np.empty_like(low)
    for j in range(n):
        np.multiply(low, a[j], out=value)
        np.add(value, b[j], out=value)
        out[j] = np.minimum.reduceat(value, starts) >> np.uint64(32)
    return out.T


def band_keys(signature: np.ndarray) -> np.ndarray:
    """One 64-bit key per band, which holds the band's number as well."""
    parts = signature.reshape(-1, BANDS, ROWS).astype(np.uint64)
    total = np.zeros(parts.shape[:2], np.uint64)
    for r in range(ROWS):
        total = mix(total * np.uint64(0x9E3779B97F4A7C15) + parts[:, :, r] + PLACE[r])
    return mix(total + PLACE[np.arange(BANDS) % len(PLACE)] * np.arange(1, BANDS + 1, dtype=np.uint64))


def _sets(texts: list[memoryview], hasher: WordHasher, k: int) -> Iterator[tuple[int, list[np.ndarray]]]:
    """The sorted distinct shingle hashes of each text, slice by slice."""
    for first, last in slices([len(t) for t in texts]):
        words, bounds = hasher.words(texts[first:last])
        found, at = shingles(words, bounds, k)
        yield first, [np.unique(found[a:b]) for a, b in zip(at.tolist(), at.tolist()[1:])]


def _signatures(sets: list[np.ndarray]) -> np.ndarray:
    """Signatures of non-empty sets, worked on in stretches that fit a processor's cache."""
    out = np.empty((len(sets), BANDS * ROWS), np.uint32)
    for first, last in slices([len(s) for s in sets], 32768):
        bounds = np.concatenate(([0], np.cumsum([len(s) for s in sets[first:last]])))
        out[first:last] = minima(np.concatenate(sets[first:last]), bounds)
    return out


def _binaries(rows: np.ndarray) -> pa.Array:
    return pa.array([r.tobytes() for r in rows], pa.binary())


def _sketch(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            texts = byte_views(batch.column("text"))
            sizes, digests, keys = [], [], []
            for _, sets in _sets(texts, hasher, k):
                full = [s for s in sets if len(s)]
                bands = iter(band_keys(_signatures(full)).view(np.int64).tolist() if full else [])
                for s in sets:
                    sizes.append(len(s))
                    digests.append(hashlib.blake2b(s.tobytes(), digest_size=16).digest() if len(s) else None)
                    keys.append(next(bands) if len(s) else None)
            yield pa.RecordBatch.from_arrays(
                [batch.column("doc_id"), batch.column("row"), batch.column("key"), batch.column("text_key"), pa.array(sizes, pa.int64()), pa.array(digests, pa.binary()), pa.array(keys, pa.list_(pa.int64()))],
                names=["doc_id", "row", "key", "text_key", "n_shingles", "digest", "bands"],
            )

    return run


def _full(k: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        hasher = WordHasher()
        for batch in batches:
            for first, sets in _sets(byte_views(batch.column("text")), hasher, k):
                yield pa.RecordBatch.from_arrays(
                    [batch.column("node").slice(first, len(sets)), _binaries(_signatures(sets)), pa.array([s.tobytes() for s in sets], pa.binary())],
                    names=["node", "signature", "members"],
                )

    return run


def agree_at_least(percent: int) -> int:
    """Signature places in which a pair at the threshold agrees but for a chance of about 1e-9."""
    n, p = BANDS * ROWS, percent / 100
    return int(n * p - 6 * (n * p * (1 - p)) ** 0.5)


def linked(a: np.ndarray, b: np.ndarray, percent: int) -> bool:
    """Are two sorted sets similar enough?"""
    small, large = (a, b) if len(a) <= len(b) else (b, a)
    if 100 * len(small) < percent * len(large):
        return False
    at = np.searchsorted(large, small)
    at[at == len(large)] = 0
    both = int((large[at] == small).sum())
    return 100 * both >= percent * (len(a) + len(b) - both)


def _confirm(percent: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            left, right = batch.column("a_members"), batch.column("b_members")
            keep = [linked(np.frombuffer(left[i].as_buffer(), np.uint64), np.frombuffer(right[i].as_buffer(), np.uint64), percent) for i in range(len(batch))]
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], names=["u", "v"]).filter(pa.array(keep, pa.bool_()))

    return run


def _agreeing(percent: int):
    least = agree_at_least(percent)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            a, b = (np.frombuffer(b"".join(batch.column(c).to_pylist()), np.uint32).reshape(-1, BANDS * ROWS) for c in ("a_signature", "b_signature"))
            yield pa.RecordBatch.from_arrays([batch.column("u"), batch.column("v")], names=["u", "v"]).filter(pa.array((a == b).sum(1) >= least))

    return run


def _groups(batches: Iterator[pa.RecordBatch], keys: list[str]) -> Iterator[pa.Table]:
    """The rows of each key, of batches sorted by it."""
    held: list[pa.RecordBatch] = []
    current = None
    for batch in batches:
        if not len(batch):
            continue
        marks = np.stack([batch.column(k).to_numpy() for k in keys])
        cuts = np.flatnonzero((marks[:, 1:] != marks[:, :-1]).any(0)) + 1
        for a, b in zip([0, *cuts.tolist()], [*cuts.tolist(), len(batch)]):
            key = tuple(marks[:, a])
            if key != current and held:
                yield pa.Table.from_batches(held)
                held = []
            current = key
            held.append(batch.slice(a, b - a))
    if held:
        yield pa.Table.from_batches(held)


def _search(percent: int):
    """All links inside one block, or between two, that join components; connected pairs are skipped."""
    least = agree_at_least(percent)

    def find(parent: list[int], i: int) -> int:
        while parent[i] != i:
            parent[i] = parent[parent[i]]
            i = parent[i]
        return i

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for group in _groups(batches, ["bucket", "i", "j"]):
            nodes, labels, side = (group.column(c).to_numpy() for c in ("node", "label", "side"))
            members = [np.frombuffer(x.as_buffer(), np.uint64) for x in group.column("members")]
            signature = np.frombuffer(b"".join(x.as_py() for x in group.column("signature")), np.uint32).reshape(-1, BANDS * ROWS)
            sizes = np.array([len(m) for m in members])
            _, start = np.unique(labels, return_inverse=True)
            parent = list(range(len(nodes)))
            u, v = [], []
            for x in range(len(nodes)):
                others = np.flatnonzero((side == 1) & (start != start[x])) if side[x] == 0 and (side == 1).any() else np.arange(x + 1, len(nodes)) if not side.any() else []
                if not len(others):
                    continue
                others = others[(start[others] != start[x]) & (100 * np.minimum(sizes[others], sizes[x]) >= percent * np.maximum(sizes[others], sizes[x]))]
                others = others[(signature[others] == signature[x]).sum(1) >= least]
                for y in others.tolist():
                    p, q = find(parent, int(start[x])), find(parent, int(start[y]))
                    if p != q and linked(members[x], members[y], percent):
                        parent[p] = q
                        u.append(int(nodes[x]))
                        v.append(int(nodes[y]))
            yield pa.RecordBatch.from_arrays([pa.array(u, pa.int64()), pa.array(v, pa.int64())], names=["u", "v"])

    return run


def _labels(links: DataFrame, scratch: Scratch) -> DataFrame:
    return scratch.stage(components(links, scratch))


def near_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """One row per document: key (of id and text), doc_id, n_shingles, component_id, kept.

    ``component_id`` is the smallest doc_id that links lead to; ``kept`` marks one row of each component, the one
    with that id. Texts that are null, empty or blank have no shingles, are linked with nothing and are kept. Null ids
    come last; a component of null ids only has a null component_id. Of repeated rows with the same id, the first
    as stored is kept. An empty table gives an empty result; other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "near")
    plain = F.coalesce(col(text).cast("string"), F.lit(""))
    source = docs.select(col(doc_id).alias("doc_id"), plain.alias("text"))
    sketches = scratch.stage(
        source.select("doc_id", F.monotonically_increasing_id().alias("row"), row_key(F.col("doc_id"), F.col("text")).alias("key"), F.unhex(F.md5("text")).alias("text_key"), "text").mapInArrow(
            _sketch(k), "doc_id " + source.schema["doc_id"].dataType.simpleString() + ", row long, key binary, text_key binary, n_shingles long, digest binary, bands array<long>"
        )
    )
    # One node per set; the smallest row number and text stand for all that share it.
    nodes = scratch.stage(
        sketches.filter("digest is not null")
        .groupBy("digest")
        .agg(F.min("row").alias("node"), F.min("text_key").alias("text_key"), F.first("bands").alias("bands"))
        .select("node", "digest", "text_key", "bands")
    )
    keyed = nodes.select("node", F.explode("bands").alias("bucket"))
    buckets = scratch.stage(keyed.groupBy("bucket").agg(F.min("node").alias("low"), F.max("node").alias("high"), F.count(F.lit(1)).alias("size")).filter("size > 1"))
    crowds = scratch.stage(keyed.join(buckets.filter("size > 2").select("bucket", "low", "size"), "bucket"))
    pairs = scratch.stage(
        buckets.filter("size = 2").select(F.col("low").alias("u"), F.col("high").alias("v")).unionByName(crowds.filter("node != low").select(F.col("low").alias("u"), F.col("node").alias("v"))).distinct()
    )
    # Signatures and sets of the nodes that met anyone; their texts are found by digest.
    met = pairs.select(F.col("u").alias("node")).unionByName(pairs.select(F.col("v").alias("node"))).distinct()
    met = scratch.stage(met.join(nodes.select("node", "text_key"), "node"))
    wanted = broadcast_if_small(met, met.count(), 64)
    texts = source.withColumn("text_key", F.unhex(F.md5("text"))).join(wanted, "text_key").groupBy("node").agg(F.first("text").alias("text"))
    sets = scratch.stage(texts.mapInArrow(_full(k), "node long, signature binary, members binary"))

    def side(name: str, *columns: str) -> DataFrame:
        return sets.select(F.col("node").alias({"a": "u", "b": "v"}[name]), *[F.col(c).alias(f"{name}_{c}") for c in columns])

    likely = scratch.stage(pairs.join(side("a", "signature"), "u").join(side("b", "signature"), "v").mapInArrow(_agreeing(percent), "u long, v long"))
    links = scratch.stage(likely.join(side("a", "members"), "u").join(side("b", "members"), "v").mapInArrow(_confirm(percent), "u long, v long"))
    labels = _labels(links, scratch)

    # What the stars left open: buckets of three or more members that still hold several components.
    named = crowds.select("bucket", "node").join(labels, "node", "left").select("bucket", "node", F.coalesce("root", "node").alias("label"))
    parts = named.groupBy("bucket", "label").agg(F.count(F.lit(1)).alias("n"), F.bit_xor(F.xxhash64("node")).alias("x"), F.sum(F.xxhash64(F.lit(7), "node").cast("decimal(38,0)")).alias("y"))
    is_open = (
        parts.groupBy("bucket")
        .agg(F.count(F.lit(1)).alias("parts"), F.sum("n").alias("size"), F.bit_xor("x").alias("x"), F.sum("y").alias("y"), F.max(F.struct("n", "label")).alias("main"))
        .filter("parts > 1")
        .groupBy("size", "x", "y")
        .agg(F.min(F.struct("bucket", "main")).alias("one"))
        .select("one.bucket", F.col("one.main.label").alias("main"), F.ceil((F.col("size") - F.col("one.main.n")) / BLOCK).cast("int").alias("few"), F.ceil(F.col("one.main.n") / BLOCK).cast("int").alias("many"))
    )
    # Members of a bucket's largest component need not meet each other: its blocks only meet those of the rest.
    place = F.pmod(F.xxhash64("node"), F.when(F.col("label") == F.col("main"), F.col("many")).otherwise(F.col("few"))).cast("int")
    dealt = (
        named.join(scratch.stage(is_open), "bucket")
        .withColumn("block", F.when(F.col("label") == F.col("main"), F.col("few") + place).otherwise(place))
        .withColumn("other", F.explode(F.sequence(F.lit(0), F.when(F.col("label") == F.col("main"), F.col("few")).otherwise(F.col("few") + F.col("many")) - 1)))
        .select("bucket", F.least("block", "other").alias("i"), F.greatest("block", "other").alias("j"), (F.col("block") > F.col("other")).cast("int").alias("side"), "node", "label")
        .join(sets, "node")
        .repartition("bucket", "i", "j")
        .sortWithinPartitions("bucket", "i", "j")
    )
    more = scratch.stage(dealt.mapInArrow(_search(percent), "u long, v long"))
    if not more.isEmpty():
        labels = _labels(links.unionByName(more), scratch)

    rooted = nodes.join(labels, "node", "left").select("digest", F.coalesce("root", "node").alias("root"))
    home = scratch.stage(sketches.select("row", "key", "doc_id", "n_shingles", "digest").join(rooted, "digest", "left"))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("doc_id"), F.col("row").alias("row")))
    best = scratch.stage(home.filter("root is not null").groupBy("root").agg(first.alias("first"), F.count(F.lit(1)).alias("size")).filter("size > 1"))
    best = best.select("root", F.col("first.doc_id").alias("best_id"), F.col("first.row").alias("best_row"))
    return home.join(broadcast_if_small(best, best.count(), 64), "root", "left").select(
        "key",
        "doc_id",
        "n_shingles",
        F.when(F.col("best_row").isNull(), F.col("doc_id")).otherwise(F.col("best_id")).alias("component_id"),
        F.coalesce(F.col("row") == F.col("best_row"), F.lit(True)).alias("kept"),
    )


def near_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", k: int = 5, percent: int = 80) -> DataFrame:
    """The documents that stay, with all their columns: one of each group of near duplicates, see :func:`near_groups`."""
    groups = near_groups(docs, doc_id, text, k, percent)
    return keep_rows(docs, doc_id, text, groups.select("key", "kept"), Scratch(docs.sparkSession, "near"))
