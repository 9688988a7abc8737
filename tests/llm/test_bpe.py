import base64
import hashlib
import random

import numpy as np
import public_tokenizers
import pytest
import tiktoken
from pyspark.sql import functions as F

from panelwise.llm import bpe as B
from panelwise.llm import queries as Q

PATH, PATTERN = public_tokenizers.path("byte_bpe_multi_50k.tiktoken"), public_tokenizers.PATTERN
ALPHABET = ["a", "Zb", "é", "中", "文字", "。", "，", "ß", "7", "٣", "²", "'", "'s", "'ll", "!", "...", "-", " ", "  ", "\n", "\t\r", "\xa0", "\u3000", "\u2009", "\x1c", "\x85", "\u200b", "\U0001f600", "\u093e", "_", "<|endoftext|>", "가"]


@pytest.fixture(scope="module")
def plain():
    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}
    return tiktoken.Encoding("plain", pat_str=PATTERN, mergeable_ranks=ranks, special_tokens={})


@pytest.fixture(scope="module")
def codec():
    with open(PATH, "rb") as f:
        return B.Codec(f.read(), PATTERN)


def ids_of(codec, text):
    return np.frombuffer(b"".join(codec.encode(text)), "<u4").tolist()


def test_cut_texts_have_the_ids_of_whole_texts(plain, codec, monkeypatch):
    monkeypatch.setattr(B, "PIECE", 5)
    monkeypatch.setattr(B, "BLANKS", 3)
    r = random.Random(1)
    cuts = 0
    for _ in range(4000):
        text = "".join(r.choice(ALPHABET) for _ in range(r.randint(0, 60)))
        assert "".join(p for p, _ in B.pieces(text)) == text
        cuts += len(list(B.pieces(text))) > 1
        assert ids_of(codec, text) == plain.encode_ordinary(text), repr(text)
        assert codec.decode(np.array(plain.encode_ordinary(text))) == text.encode()
    assert cuts > 3000


def test_merges_by_rank(codec):
    """The library against merging the lowest rank first, word by word."""
    import regex

    with open(PATH, "rb") as f:
        ranks = {base64.b64decode(a): int(b) for a, b in map(bytes.split, f)}

    def merged(piece):
        parts = [bytes([b]) for b in piece]
        while len(parts) > 1:
            best = min(range(len(parts) - 1), key=lambda i: ranks.get(parts[i] + parts[i + 1], 1 << 40))
            if parts[best] + parts[best + 1] not in ranks:
                break
            parts[best : best + 2] = [parts[best] + parts[best + 1]]
        return [ranks[p] for p in parts]

    text = "Hello there, don't you'll  see 12345 été größer 漢字かな交じり文 \n\n end   "
    assert ids_of(codec, text) == [i for m in regex.findall(PATTERN, text) for i in merged(m.encode())]


def test_very_long_texts(plain, codec):
    run = plain.encode_ordinary(" " * 2)
    blanks = 3_000_000
    assert ids_of(codec, "x" + " " * blanks + "y") == [*plain.encode_ordinary("x"), *run[:1] * (blanks - 1), *plain.encode_ordinary(" y")]
    assert len(ids_of(codec, "\n" * blanks)) == len(ids_of(codec, "\n" * blanks + "y")) - len(plain.encode_ordinary("y"))
    word = "ab" * 300_000
    assert ids_of(codec, word) == plain.encode_ordinary(word)
    assert ids_of(codec, (word[:999] + ",") * 300) == plain.encode_ordinary((word[:999] + ",") * 300)


def test_frames(spark, documents, odd_rows, plain):
    docs = documents(odd_rows, clashing=True).withColumn("_text", F.lit("own")).withColumn("v", F.lit(3)).withColumn("c0", F.lit(4))
    got = B.decode(B.encode(docs, PATH, PATTERN), PATH, PATTERN)
    assert set(got.columns) == {*docs.columns, "ids", "decoded"} - {"text"}
    rows = sorted(((r.doc_id, np.frombuffer(r.ids, "<u4").tolist(), bytes(r.decoded), r._text, r.v) for r in got.collect()), key=str)
    assert rows == sorted(((i, plain.encode_ordinary(t or ""), (t or "").encode(), "own", 3) for i, t in odd_rows), key=str)
    assert B.encode(docs.limit(0), PATH, PATTERN).count() == 0
    assert B.decode(spark.createDataFrame([(None,)], "ids binary"), PATH, PATTERN).first().decoded == b""


def test_query_against_the_library(spark, plain):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: tuple(r) for r in Q.QUERIES["op12_bpe"](spark, sf).collect()}
    docs = Q.table(spark, sf, "documents").collect()
    assert len(got) == len(docs)
    for d in docs:
        ids = plain.encode_ordinary(d.text or "")
        raw = np.array(ids, "<u4").tobytes()
        assert got[d.doc_id] == (d.doc_id, len(ids), hashlib.sha256(raw).hexdigest(), hashlib.sha256((d.text or "").encode()).hexdigest())
