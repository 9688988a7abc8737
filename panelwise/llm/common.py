"""What several text operators share: staged tables, word hashing in bulk, column names."""

from __future__ import annotations

import ctypes
import sys
import types
import uuid
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwise.runtime import MAX_BROADCAST_BYTES, col, shared_folder

# Bytes of text worked on at a time inside a task: its arrays of eight bytes a byte then fit a processor's cache.
SLICE_BYTES = 512 * 1024


#: Bytes of one batch handed to Python at most: texts are long, and a task holds a batch more than once.
BATCH_BYTES = 4 * 1024 * 1024


def bound_batches(spark: SparkSession) -> None:
    """Lowers the session's limit on the bytes of a batch to ``BATCH_BYTES``, unless it is lower or was set in words (``16m``)."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    now = (spark.conf.get(name) or "").removesuffix("b")
    if now.isdigit() and int(now) > BATCH_BYTES:
        spark.conf.set(name, str(BATCH_BYTES))


class Scratch:
    """Tables written to the shared folder of the session, and dropped as soon as nothing reads them any more."""

    def __init__(self, spark: SparkSession, name: str):
        self.spark = spark
        self.root = f"{shared_folder(spark)}/{name}-{uuid.uuid4().hex}"
        self.count = 0
        bound_batches(spark)

    def stage(self, df: DataFrame, compression: str = "snappy") -> DataFrame:
        """``df``, computed once and read back: cuts the lineage and fixes every value in it."""
        path = f"{self.root}/{self.count}"
        self.count += 1
        df.write.parquet(path, compression=compression)
        back = self.spark.read.schema(df.schema).parquet(path)
        back._scratch = (self, path)
        return back

    def drop(self, *tables: DataFrame) -> None:
        for t in tables:
            path = t._scratch[1]
            jvm = self.spark._jvm
            where = jvm.org.apache.hadoop.fs.Path(path)
            where.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(where, True)


def broadcast_if_small(df: DataFrame, rows: int, bytes_per_row: int) -> DataFrame:
    """``df`` marked for broadcasting if its counted rows stay below the bound; otherwise Spark shuffles the join."""
    return F.broadcast(df) if rows * bytes_per_row <= MAX_BROADCAST_BYTES else df


def fresh(df: DataFrame, *names: str) -> list[str]:
    """Names like the given ones that no column of ``df`` has (Spark compares names without case)."""
    taken = {c.lower() for c in df.columns}
    out = []
    for n in names:
        while n.lower() in taken:
            n = "_" + n
        taken.add(n.lower())
        out.append(n)
    return out


def byte_views(column: pa.Array) -> list[memoryview]:
    """The UTF-8 bytes of each text of an Arrow string column; null counts as empty.

    Called once a batch, so the worker gives back here what earlier batches and tasks left in Arrow's pool and in the
    allocator's free lists.
    """
    pa.default_memory_pool().release_unused()
    trim = getattr(ctypes.CDLL(None), "malloc_trim", None)  # of glibc
    if trim is not None:
        trim(0)
    if isinstance(column, pa.ChunkedArray):
        column = column.combine_chunks()
    if len(column) == 0:
        return []
    if not pa.types.is_large_string(column.type):
        column = column.cast(pa.large_string())
    column = column.fill_null("") if column.null_count else column
    _, offsets, data = column.buffers()
    offsets = np.frombuffer(offsets, np.int64)[column.offset : column.offset + len(column) + 1].tolist()
    view = memoryview(data) if data is not None else memoryview(b"")
    return [view[a:b] for a, b in zip(offsets, offsets[1:])]


def slices(sizes: list[int], limit: int = SLICE_BYTES) -> Iterator[tuple[int, int]]:
    """Ranges of neighbouring rows whose sizes add up to ``limit`` at most; a larger row stands alone."""
    first, total = 0, 0
    for i, n in enumerate(sizes):
        if i > first and total + n > limit:
            yield first, i
            first, total = i, 0
        total += n
    if first < len(sizes):
        yield first, len(sizes)


def mix(x: np.ndarray) -> np.ndarray:
    """A bijection of 64-bit numbers that spreads every bit (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def numbered(n: int, seed: int) -> np.ndarray:
    """``n`` fixed pseudo-random 64-bit numbers."""
    return mix((np.arange(1, n + 1, dtype=np.uint64) + np.uint64(seed)) * np.uint64(0x9E3779B97F4A7C15))


#: Bytes that part words: the ASCII blanks, or everything in ASCII but letters and digits.
BLANKS = bytes([0x20, *range(0x09, 0x0E)])
NO_LETTERS = bytes(b for b in range(128) if not chr(b).isalnum())


def kept_in_process(key: tuple, make):
    """What ``make`` returns, kept for the life of this Python process: a worker serves many tasks one after the other."""
    store = vars(sys.modules.setdefault("panelwise_kept_in_process", types.ModuleType("panelwise_kept_in_process")))
    name = repr(key)
    if name not in store:
        store[name] = make()
    return store[name]


class WordHasher:
    """64-bit hashes of all words of many texts by numpy; A-Z count as a-z. ``parting`` holds the bytes between words."""

    BASE = 0x5851F42D4C957F2D | 1

    def __init__(self, parting: bytes = BLANKS):
        self.space = np.zeros(256, bool)
        self.space[list(parting)] = True
        self.code = numbered(256, 11)
        self.code[65:91] = self.code[97:123]
        self.power = self.inverse = np.ones(0, np.uint64)
        self.gap = parting[:1]

    def _powers(self, n: int) -> None:
        if len(self.power) < n:
            self.power = np.cumprod(np.full(n, self.BASE, np.uint64))
            self.inverse = np.cumprod(np.full(n, pow(self.BASE, -1, 1 << 64), np.uint64))

    def _blob(self, data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Start and hash of each word."""
        space = self.space[data]
        edge = np.diff(space.astype(np.int8), prepend=np.int8(1), append=np.int8(1))
        starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        if not len(starts):
            return starts, np.zeros(0, np.uint64)
        self._powers(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.code[data] * self.power[: len(data)], out=total[1:])
        return starts, mix((total[ends] - total[starts]) * self.inverse[starts])

    def stems(self, texts: list[memoryview], lengths: list[int]) -> tuple[np.ndarray, np.ndarray]:
        """Hashes of every word and of its first so many bytes, and for each text where its rows begin: (words x (1 + lengths)).

        A word that is not longer than a stem has no stem of that length: the whole word's hash stands in its place.
        """
        data = np.frombuffer(self.gap.join(texts), np.uint8)
        begins = np.cumsum([0] + [len(t) + 1 for t in texts])
        space = self.space[data]
        edge = np.diff(space.astype(np.int8), prepend=np.int8(1), append=np.int8(1))
        starts, ends = np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)
        self._powers(len(data) + 1)
        total = np.zeros(len(data) + 1, np.uint64)
        np.cumsum(self.code[data] * self.power[: len(data)], out=total[1:])
        whole = (total[ends] - total[starts]) * self.inverse[starts]
        out = [mix(whole)]
        for n in lengths:
            stem = (total[np.minimum(starts + n, ends)] - total[starts]) * self.inverse[starts]
            out.append(np.where(ends - starts > n, mix(stem + np.uint64(n)), out[0]))
        return np.stack(out, 1), np.searchsorted(starts, begins)

    def words(self, texts: list[memoryview]) -> tuple[np.ndarray, np.ndarray]:
        """The hashes of all words in order, and for each text where its words begin (one entry more than texts)."""
        if len(texts) == 1 and len(texts[0]) > 2 * SLICE_BYTES:
            parts = [self._blob(x)[1] for x in self._cut(np.frombuffer(texts[0], np.uint8))]
            found = np.concatenate(parts)
            return found, np.array([0, len(found)])
        data = np.frombuffer(self.gap.join(texts), np.uint8)
        begins = np.cumsum([0] + [len(t) + 1 for t in texts])
        starts, found = self._blob(data)
        return found, np.searchsorted(starts, begins)

    def _cut(self, data: np.ndarray) -> Iterator[np.ndarray]:
        """A long text in parts that end between words."""
        at = 0
        while at < len(data):
            end = min(at + SLICE_BYTES, len(data))
            while end < len(data):
                blanks = np.flatnonzero(self.space[data[end : end + SLICE_BYTES]])
                if len(blanks):
                    end += int(blanks[0])
                    break
                end = min(end + SLICE_BYTES, len(data))
            yield data[at:end]
            at = end


#: Odd multipliers of the words of a shingle by place.
PLACE = numbered(64, 23) | np.uint64(1)


def shingles(words: np.ndarray, bounds: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Hashes of all runs of ``k`` words inside each text, and where each text's begin.

    A text with fewer than ``k`` words, but at least one, has one shingle: all its words.
    """
    n = len(words)
    counts = np.diff(bounds)
    sizes = np.where(counts >= k, counts - k + 1, (counts > 0).astype(counts.dtype))
    out_bounds = np.concatenate(([0], np.cumsum(sizes)))
    if not n:
        return words, out_bounds
    if n >= k:
        total = np.zeros(n - k + 1, np.uint64)
        for j in range(k):
            total += words[j : n - k + 1 + j] * PLACE[j]
    else:
        total = np.zeros(0, np.uint64)
    # Rows of whole shingles keep their place in the text; short texts are few and done one by one.
    first = np.repeat(bounds[:-1] - out_bounds[:-1], sizes) + np.arange(out_bounds[-1])
    short = np.flatnonzero((counts > 0) & (counts < k))
    whole = np.ones(len(first), bool)
    whole[out_bounds[short]] = False
    out = np.empty(len(first), np.uint64)
    out[whole] = mix(total[first[whole]] + np.uint64(k))
    for i in short:
        own = words[bounds[i] : bounds[i + 1]]
        out[out_bounds[i]] = mix(np.array([(own * PLACE[: len(own)]).sum(dtype=np.uint64) + np.uint64(len(own))], np.uint64))[0]
    return out, out_bounds


def row_key(doc_id, text):
    """Identifies a row by id and text, null or not."""
    return F.unhex(F.md5(F.concat(F.coalesce(doc_id.cast("string"), F.lit("~")), F.lit("|"), F.coalesce(text.cast("string"), F.lit("")))))


def keep_rows(docs: DataFrame, doc_id: str, text: str, decisions: DataFrame, scratch: Scratch) -> DataFrame:
    """The rows of ``docs`` that ``decisions(key, kept)`` keeps; ``key`` is :func:`row_key`, one decision per row.

    Rows that share a key (repeated rows) are told apart only if some stay: then as many as should stay, the
    first by a hash over all columns. Other rows are not shuffled while the keys to act on fit a broadcast.
    """
    key, fate, best = fresh(docs, "_key", "_stay", "_best")
    acts = scratch.stage(decisions.groupBy("key").agg(F.count(F.lit(1)).alias("n"), F.sum(F.col("kept").cast("long")).alias("stay")).filter("stay < n").select(F.col("key").alias(key), F.col("stay").alias(fate)))
    joined = docs.withColumn(key, row_key(col(doc_id), col(text))).join(broadcast_if_small(acts, acts.count(), 96), key, "left")
    names = [col(c) for c in docs.columns]
    hashable = [col(c) for c, t in docs.dtypes if "map<" not in t and "variant" not in t]
    untouched = joined.filter(col(fate).isNull()).select(*names)
    one = joined.filter(col(fate) > 0).groupBy(key).agg(F.min_by(F.struct(*names), F.xxhash64(*hashable)).alias(best)).select(f"{best}.*")
    return untouched.unionByName(one)
