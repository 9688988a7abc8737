"""Exact duplicates by two passes over a Bloom filter, in DataFrame functions only.

Texts are equal when they are identical after deleting the ASCII blanks. The first pass hashes every text and
counts how often each slot of a blocked Bloom filter is hit; the slots hit more than once make the second filter.
The second pass holds every row against it: a row with a slot that nobody else hit cannot have a copy and passes
straight through. Only the others shuffle. A wrong alarm of the filter costs a shuffled row, never a result.
"""

from __future__ import annotations

from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwise.llm.common import Scratch, broadcast_if_small, col, fresh
from panelwise.runtime import MAX_BROADCAST_BYTES

#: Bits of one block of the filter (what the bitmap functions of Spark build), filter bits per row, slots per row.
BLOCK_BITS = 32768
BITS_PER_ROW = 16
SLOTS = 2


def text_digest(text: Column) -> Column:
    """SHA-256 of the text without ASCII blanks; null counts as empty."""
    return F.unhex(F.sha2(F.regexp_replace(F.coalesce(text.cast("string"), F.lit("")), "[\\x20\\x09-\\x0D]+", ""), 256))


def _block(digest: Column, blocks: int) -> Column:
    return F.pmod(F.xxhash64(digest), F.lit(blocks)).cast("int")


def _slots(digest: Column) -> list[Column]:
    h = F.xxhash64(digest, F.lit(1))
    return [F.shiftrightunsigned(h, 15 * i).bitwiseAND(F.lit(BLOCK_BITS - 1)).cast("int") for i in range(SLOTS)]


def repeat_filter(digests: DataFrame, digest: str, max_bytes: int = MAX_BROADCAST_BYTES) -> tuple[DataFrame, int]:
    """The filter of slots hit more than once, as (block, bits) rows, and its number of blocks.

    It has 16 bits per row, but never more than ``max_bytes``: beyond that more rows are called possibly
    repeated, and shuffle.
    """
    rows = digests.count()
    blocks = max(1, min(-(-rows * BITS_PER_ROW // BLOCK_BITS), max_bytes * 8 // BLOCK_BITS))
    hits = (
        digests.select(_block(col(digest), blocks).alias("block"), F.explode(F.array_distinct(F.array(*_slots(col(digest))))).alias("slot"))
        .groupBy("block", "slot")
        .agg(F.count(F.lit(1)).alias("hits"))
        .filter("hits > 1")
    )
    return hits.groupBy("block").agg(F.bitmap_construct_agg(F.col("slot").cast("long")).alias("bits")), blocks


def flag_repeated(rows: DataFrame, digest: str, bits: DataFrame, blocks: int, flag: str) -> DataFrame:
    """``rows`` with a boolean column: may this digest occur elsewhere, too? The filter's size is bounded, so it is broadcast."""
    block, mask = fresh(rows, "_block", "_bits")
    own = rows.withColumn(block, _block(col(digest), blocks))
    joined = own.join(F.broadcast(bits.select(F.col("block").alias(block), F.col("bits").alias(mask))), block, "left")

    def is_set(slot: Column) -> Column:
        byte = F.conv(F.hex(F.substring(F.col(mask), F.shiftright(slot, 3) + 1, F.lit(1))), 16, 10).cast("int")
        return F.call_function("shiftright", byte, slot.bitwiseAND(F.lit(7))).bitwiseAND(F.lit(1)) == 1

    hit = reduce(lambda a, b: a & b, [is_set(s) for s in _slots(col(digest))])
    return joined.withColumn(flag, F.coalesce(hit, F.lit(False))).drop(block, mask)


def exact_groups(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_filter_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """One row per document: doc_id, keep_id, group_size, kept, text_sha256.

    Of equal texts the one with the most code points stays, then the smallest doc_id (null last). Repeated rows
    with the same id and text are documents of their own: exactly one of them is kept. Null texts are empty
    texts. An empty table gives an empty result; other columns are not read.
    """
    scratch = Scratch(docs.sparkSession, "exact")
    rows = scratch.stage(
        docs.select(
            F.monotonically_increasing_id().alias("row"),
            col(doc_id).alias("doc_id"),
            F.coalesce(F.char_length(col(text).cast("string")), F.lit(0)).alias("chars"),
            text_digest(col(text)).alias("digest"),
        )
    )
    bits, blocks = repeat_filter(rows, "digest", max_filter_bytes)
    flagged = scratch.stage(flag_repeated(rows, "digest", scratch.stage(bits), blocks, "again"))
    again = flagged.filter("again")
    order = F.struct((-F.col("chars")).alias("chars"), F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("doc_id"), F.col("row").alias("row"))
    groups = scratch.stage(
        again.groupBy("digest").agg(F.min(order).alias("first"), F.count(F.lit(1)).alias("group_size")).select("digest", F.col("first.doc_id").alias("keep_id"), F.col("first.row").alias("keep_row"), "group_size")
    )
    small = broadcast_if_small(groups, groups.count(), 128)
    copies = again.join(small, "digest").select("doc_id", "keep_id", "group_size", (F.col("row") == F.col("keep_row")).alias("kept"), "digest")
    rest = flagged.filter("not again").select("doc_id", F.col("doc_id").alias("keep_id"), F.lit(1).cast("long").alias("group_size"), F.lit(True).alias("kept"), "digest")
    return rest.unionByName(copies).withColumn("digest", F.lower(F.hex("digest"))).withColumnRenamed("digest", "text_sha256")


def exact_dedup(docs: DataFrame, doc_id: str = "doc_id", text: str = "text", max_filter_bytes: int = MAX_BROADCAST_BYTES) -> DataFrame:
    """The documents that stay, with all their columns; which, is as in :func:`exact_groups`.

    Rows without a possible copy are not shuffled. Of the others, each task first keeps its best row of each
    text, so that a text that makes up a third of the corpus shuffles one row per task. Among rows alike in
    length and id, the smallest hash over all columns decides.
    """
    digest, flag, best, row = fresh(docs, "_digest", "_again", "_best", "_row")
    scratch = Scratch(docs.sparkSession, "exact")
    keyed = docs.withColumn(digest, text_digest(col(text)))
    bits, blocks = repeat_filter(scratch.stage(keyed.select(digest)), digest, max_filter_bytes)
    flagged = flag_repeated(keyed, digest, scratch.stage(bits), blocks, flag)
    hashable = [col(c) for c, t in docs.dtypes if "map<" not in t and "variant" not in t]
    order = F.struct(-F.char_length(F.coalesce(col(text).cast("string"), F.lit(""))), col(doc_id).isNull(), col(doc_id), F.xxhash64(*hashable))
    stay = flagged.filter(col(flag)).groupBy(digest).agg(F.min_by(F.struct(*[col(c) for c in docs.columns]), order).alias(best))
    return flagged.filter(~col(flag)).select(*[col(c) for c in docs.columns]).unionByName(stay.select(f"{best}.*"))
