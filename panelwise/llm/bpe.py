"""Byte-level BPE by the tiktoken library: texts to ids and ids back to bytes.

The ranks are a local file of lines ``base64 rank``, read by the driver and broadcast, so executors need no such file. Rows are encoded
where they are read; nothing is shuffled. Ids are kept as little-endian unsigned 32-bit numbers in one
binary value per text, the form in which token files are stored.

*Long texts* are cut before they are encoded, at places where the pattern parts them whatever stands around:
behind a character that is no blank and before a blank, between a letter or digit and a punctuation mark,
between a letter and a digit. No match reaches over such a place, and none looks back, so the ids are those of
the whole text. The library's own scan keeps a state for each blank of a run and fails in runs of millions; a
long run of blanks is therefore cut by hand as the pattern does it: all of it at the end of a text, otherwise
all but the last blank, as one match, whose merges the library does. A long match without blanks (a text of one
endless word) is one piece for the library, whose time grows almost linearly.

*Decoding* joins the bytes of the ids; a character may be spread over several ids, so no id is decoded to text alone.

Null and empty texts have no ids; null ids decode to no bytes. Special tokens do not exist: their strings are ordinary text. Ids
outside the ranks raise. Every other column is passed on; repeated rows are encoded each; no rows give no rows.
"""

from __future__ import annotations

import base64
import hashlib
import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwise.llm.common import bound_batches, byte_views, kept_in_process
from panelwise.runtime import col

#: Characters of a text encoded at a time, and blanks in a row from which a run is cut by hand.
PIECE = 1 << 16
BLANKS = 1 << 12

# What is surely a letter and surely a punctuation mark, in every version of Unicode.
_LETTER = "A-Za-zà-öа-яぁ-ゖァ-ヺ一-龥가-힣"
_MARK = "!-/:-@\\[-`{-~、。！，？"
#: A place between two characters that no match of the pattern covers. Blanks are the ASCII ones here, no blank is surely none.
SAFE = re.compile(rf"(?<=\S)(?=[ \t-\r])|(?<=[{_LETTER}0-9])(?=[{_MARK}])|(?<=[{_LETTER}])(?=[0-9])|(?<=[0-9])(?=[{_LETTER}])")
#: What the pattern calls a blank.
BLANK = "\t-\r \x85\xa0\u1680\u2000-\u200a\u2028\u2029\u202f\u205f\u3000"


def pieces(text: str, size: int = 0, blanks: int = 0) -> Iterator[tuple[str, bool]]:
    """``text`` in parts of about ``size`` characters that are encoded each on its own; True marks a part that is a single match."""
    size, blanks = size or PIECE, blanks or BLANKS
    if len(text) <= size:
        yield text, False
        return
    at = 0
    for run in re.finditer(f"[{BLANK}]{{{max(blanks, 2)},}}", text):
        end = run.end() if run.end() == len(text) else run.end() - 1
        yield from _parts(text, at, run.start(), size)
        yield text[run.start() : end], True
        at = end
    yield from _parts(text, at, len(text), size)


def _parts(text: str, at: int, end: int, size: int) -> Iterator[tuple[str, bool]]:
    while end - at > size:
        m = SAFE.search(text, at + size, end)
        if m is None or m.start() >= end:
            break
        yield text[at : m.start()], False
        at = m.start()
    if at < end:
        yield text[at:end], False


class Codec:
    """The library's encoding over some ranks, and the bytes of every id."""

    def __init__(self, ranks: bytes, pattern: str):
        import tiktoken

        merges = {base64.b64decode(a): int(b) for a, b in map(bytes.split, ranks.splitlines()) if a}
        self.encoding = tiktoken.Encoding("local", pat_str=pattern, mergeable_ranks=merges, special_tokens={})

    def encode(self, text: str) -> Iterator[bytes]:
        for piece, single in pieces(text):
            # A single match is not scanned again.
            ids = self.encoding._encode_single_piece(piece) if single else self.encoding.encode_ordinary(piece)
            yield np.array(ids, "<u4").tobytes()

    def decode(self, ids: np.ndarray) -> bytes:
        return b"".join(self.encoding.decode_bytes(ids[a : a + PIECE].tolist()) for a in range(0, len(ids), PIECE))


def _shared(spark: SparkSession, ranks_path: str, pattern: str):
    with open(ranks_path, "rb") as f:
        ranks = f.read()
    name = hashlib.sha256(ranks + pattern.encode()).hexdigest()
    sent = spark.sparkContext.broadcast(ranks)
    return lambda: kept_in_process(("bpe", name), lambda: Codec(sent.value, pattern))


def _mapped(df: DataFrame, source: Column, keep: list[str], out: str, work) -> DataFrame:
    """The columns ``keep`` of ``df`` and a binary column ``out`` that ``work`` makes from ``source``, batch by batch."""
    bound_batches(df.sparkSession)
    given = df.select(source.alias("v"), *[col(c).alias(f"c{i}") for i, c in enumerate(keep)])

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            yield pa.RecordBatch.from_arrays([pa.array(work(batch.column(0)), pa.binary()), *batch.columns[1:]], names=batch.schema.names)

    schema = T.StructType([T.StructField("v", T.BinaryType()), *given.schema.fields[1:]])
    return given.mapInArrow(run, schema).select(*[F.col(f"c{i}").alias(c) for i, c in enumerate(keep)], F.col("v").alias(out))


def encode(df: DataFrame, ranks_path: str, pattern: str, text: str = "text", ids: str = "ids") -> DataFrame:
    """``df`` with the ids of its texts in a new last column, in place of the texts. A column of that name is replaced."""
    codec = _shared(df.sparkSession, ranks_path, pattern)

    def work(column: pa.Array) -> list[bytes]:
        own = codec()
        return [b"".join(own.encode(str(v, "utf-8", "replace"))) for v in byte_views(column)]

    return _mapped(df, col(text).cast("string"), [c for c in df.columns if c not in (text, ids)], ids, work)


def decode(df: DataFrame, ranks_path: str, pattern: str, ids: str = "ids", decoded: str = "decoded") -> DataFrame:
    """``df`` with the bytes that its ids stand for in a new last column. A column of that name is replaced."""
    codec = _shared(df.sparkSession, ranks_path, pattern)

    def work(column: pa.Array) -> list[bytes]:
        own = codec()
        return [own.decode(np.frombuffer(x.as_buffer(), "<u4")) if x.is_valid else b"" for x in column]

    return _mapped(df, col(ids), [c for c in df.columns if c != decoded], decoded, work)
