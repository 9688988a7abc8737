import random
import zlib

import numpy as np
import pyarrow as pa
import pytest

from panelwise.llm import packing as P
from panelwise.llm.queries import tokenizer_path


@pytest.fixture(scope="module")
def tokenizer():
    from tokenizers import Tokenizer

    return Tokenizer.from_file(tokenizer_path())


def test_ids_are_those_of_whole_texts(tokenizer, words):
    r = random.Random(1)
    odd = ["", " \n", "<|endoftext|> x", "<|ENDOFTEXT|> A<B c's", "x<|endoftext|>y, z.", "İstanbul ΣΑΣ é ́x  b\x85c", "don't,we'll 'tis (a).b) 3rd, 12.5%", "é,…, ÉTÉ. 中文, ١٢", "\x00a \x1cb"]
    odd += ["".join(r.choice(["the", "Word", ",", ".", " ", "'s", "'", "é", "É", "9", "<", "#", "’", "\n", "́"]) for _ in range(40)) for _ in range(300)]
    texts = odd + [" ".join(r.choice(words) for _ in range(50)).title() for _ in range(50)]
    with open(tokenizer_path(), encoding="utf-8") as f:
        encoder = P.Encoder(f.read(), 1)
    assert encoder.by_word
    for n in (1, 7, 400):  # whatever it knows already
        encoder.known.clear()
        got = [x for i in range(0, len(texts), n) for x in encoder.encode([memoryview(t.encode()) for t in texts[i : i + n]])]
        assert [np.frombuffer(x, np.uint16).tolist() for x in got] == [[*tokenizer.encode(t, add_special_tokens=False).ids, 1] for t in texts]


@pytest.mark.parametrize("window,shard", [(2048, 2_000_000), (64, 900)])
def test_every_id_lies_in_one_piece(documents, odd_rows, tokenizer, window, shard):
    rows = [(i, t) for i, t in odd_rows if t != "a null id"]
    got = P.pack_documents(documents(rows, clashing=True), tokenizer_path(), window=window, shard_tokens=shard).toPandas()
    assert len(got[got.doc_id.isna()]) == 1
    sequences = got.sort_values(["sequence_id", "offset"]).groupby("sequence_id")
    sizes = sequences.length.sum()
    assert ((sizes == window) | (sizes & (sizes - 1) == 0)).all() and (sizes <= window).all()
    assert all((g.offset.to_numpy() == np.concatenate(([0], np.cumsum(g.length)[:-1]))).all() for _, g in sequences)
    ids = {}
    for i, t in rows:
        ids.setdefault(i, []).append(np.array([*tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4"))
    for i, own in ids.items():
        mine = got[got.doc_id.isna()] if i is None else got[got.doc_id == i]
        assert mine.length.sum() == sum(map(len, own))
        for start, length, crc, total in zip(mine.start, mine.length, mine.ids_crc32, mine.doc_tokens):
            assert any(len(x) == total and zlib.crc32(x[start : start + length].tobytes()) == crc for x in own)
        if len(own) == 1:
            spans = sorted(zip(mine.start, mine.length))
            assert [s for s, _ in spans] == [sum(n for _, n in spans[:k]) for k in range(len(spans))]


def test_neighbours_by_bm25():
    r = np.random.default_rng(2)
    docs = [np.append(r.integers(0, 50, r.integers(1, 40)), 1).astype(np.uint16) for _ in range(40)]
    idf = r.random(60).astype(np.float32)
    index = P.Index(docs, idf, 17.0)
    free = r.random(40) < 0.7
    for seed in range(40):
        scores = []
        for d, doc in enumerate(docs):
            size, total = len(doc) - 1, 0.0
            for t in index.query[seed].tolist():
                tf = (doc[:-1] == t).sum()
                total += idf[t] * tf * 2.2 / (tf + 1.2 * (1 - 0.75 + 0.75 * size / 17.0)) if tf else 0
            scores.append(total if free[d] else 0)
        got = index.neighbours(seed, free)
        assert set(got) == {d for d in range(40) if scores[d] > 0}
        assert all(scores[a] >= scores[b] - 1e-4 for a, b in zip(got, got[1:]))


def test_a_seed_is_followed_by_its_neighbour():
    docs = [np.array(x + [1], np.uint16) for x in ([5, 6, 7], [8, 9, 10], [20, 21, 22], [8, 9, 30], [5, 6, 31])]
    pieces = P.pack(docs, np.ones(40, np.float32), 3.0, 8)
    windows = {}
    for doc, _, _, sequence, _ in pieces:
        windows.setdefault(sequence, []).append(doc)
    assert windows[0] == [0, 4] and windows[1] == [1, 3]


def test_all_terms_of_a_seed_count():
    """Only its least telling one of 60 terms leads to the neighbour."""
    seed = [*range(2, 62)]
    docs = [np.array(x + [1], np.uint16) for x in (seed, [100], [101], [61, 102])]
    idf = np.ones(200, np.float32)
    idf[61] = 0.1
    assert P.Index(docs, idf, 17.0).neighbours(0, np.array([False, True, True, True])) == [3]


def test_a_seed_is_asked_for_until_it_has_no_neighbour():
    """100 short documents share a term with the first one; each also has one in common with another document in between."""
    docs = [np.array([5, 1], np.uint16)]
    for i in range(100):
        docs += [np.array([5, 100 + i, 1], np.uint16), np.array([100 + i, 1], np.uint16)]
    pieces = P.pack(docs, np.ones(300, np.float32), 2.0, 302)
    assert [d for d, _, _, sequence, _ in pieces if sequence == 0] == [0, *range(1, 200, 2)]


def test_equal_pieces_are_tokenised_once(words):
    """The library sees each distinct piece, not each piece."""
    r = random.Random(4)
    texts = [memoryview(" ".join(r.choice(words) for _ in range(2000)).encode()) for _ in range(20)]
    with open(tokenizer_path(), encoding="utf-8") as f:
        encoder = P.Encoder(f.read(), 1)
    holder = getattr(encoder, "pieces", encoder)
    library, seen = holder.merges, []
    holder.merges = type("Seen", (), {"encode_to_numpy": lambda self, text: seen.append(len(text)) or library.encode_to_numpy(text)})()
    first = encoder.encode(texts)
    assert sum(seen) < 0.5 * sum(map(len, texts))
    seen.clear()
    assert encoder.encode(texts) == first and sum(seen) < 0.05 * sum(map(len, texts))


@pytest.mark.parametrize("slots", [1, 8, 256])
def test_pieces_that_want_one_place(tokenizer, words, monkeypatch, slots):
    monkeypatch.setattr(P, "SLOTS", slots)
    r = random.Random(5)
    edge = [c * n for c in "ab,é" for n in range(1, 20)] + ["a", "aa", "x" * 16, "x" * 17, "y" * 15 + "z", "é" * 8, "é" * 7 + "ab", "!" * 16, "!" * 17]
    texts = [" ".join(r.choice(edge + words) + r.choice(["", ",", "12", "'s"]) for _ in range(r.choice([0, 1, 30, 300]))) for _ in range(60)]
    with open(tokenizer_path(), encoding="utf-8") as f:
        encoder = P.Encoder(f.read(), 1)
    want = [[*tokenizer.encode(t, add_special_tokens=False).ids, 1] for t in texts]
    for n in (1, 7, 60):
        got = [x for i in range(0, len(texts), n) for x in encoder.encode([memoryview(t.encode()) for t in texts[i : i + n]])]
        assert [np.frombuffer(x, np.uint16).tolist() for x in got] == want


def test_rows_of_weights_stay_contiguous():
    """Rows that are spread over memory take twice the time to add up."""
    docs = [np.array([5, 6, 7 + i, 1], np.uint16) for i in range(20)]
    index = P.Index(docs, np.ones(40, np.float32), 3.0)
    index.forget(np.arange(20) % 3 > 0)
    assert len(index.rows) == 2 and index.rows.flags.c_contiguous


def test_empty_table(documents):
    assert P.pack_documents(documents([]), tokenizer_path()).count() == 0


def test_long_words_and_texts(tokenizer, words):
    r = random.Random(3)
    long = " ".join(r.choice(words) + r.choice(["", ",", "'s", " é́", "12"]) for _ in range(250_000))
    texts = ["x" * 5000 + " y", "a.1" * 3000, "don't" * 2000, long, "", "ß" * 4097 + " z", "中" * 2000 + " <|EndOfText|>", "<|endoftext|>" * 3 + "a"]
    assert len(long) > 2 * P.SLICE_BYTES
    with open(tokenizer_path(), encoding="utf-8") as f:
        encoder = P.Encoder(f.read(), 1)
    got = encoder.encode([memoryview(t.encode()) for t in texts])
    for g, t in zip(got, texts):
        assert np.array_equal(np.frombuffer(g, np.uint16), [*tokenizer.encode(t, add_special_tokens=False).ids, 1])


def test_all_two_byte_characters(tokenizer):
    texts = [f"{a}{chr(c)}{b} {chr(c)}." for c in range(0x80, 0x800) for a, b in (("", ""), ("e", "e"), ("é", "3"))]
    with open(tokenizer_path(), encoding="utf-8") as f:
        encoder = P.Encoder(f.read(), 1)
    for t, got in zip(texts, encoder.encode([memoryview(t.encode()) for t in texts])):
        assert np.frombuffer(got, np.uint16).tolist() == [*tokenizer.encode(t, add_special_tokens=False).ids, 1], t


def test_forgetting_used_documents_changes_nothing():
    r = np.random.default_rng(5)
    docs = [np.append(r.integers(0, 50, r.integers(1, 40)), 1).astype(np.uint16) for _ in range(60)]
    idf = r.random(60).astype(np.float32)
    free = np.ones(60, bool)
    short = P.Index(docs, idf, 17.0)
    for used in r.permutation(60)[:50].tolist():
        free[used] = False
        short.forget(free)
        seed = int(r.integers(60))
        assert short.neighbours(seed, free) == P.Index(docs, idf, 17.0).neighbours(seed, free)


def test_the_order_is_learned_from_all_documents():
    """Sums over all documents, however they are dealt to tasks, and the directions that plain numpy finds in all sketches."""
    r = np.random.default_rng(6)
    topics = [r.integers(2 + 300 * t, 302 + 300 * t, 300) for t in range(4)]
    docs = [np.append(r.choice(topics[i % 4], r.integers(1, 60)), 1).astype(np.uint16) for i in range(3000)]
    order = P.Order(r.random(1300))
    sums = []
    for parts in (1, 7):
        tasks = [docs[i::parts] for i in range(parts)]
        run = P._products(type("Held", (), {"value": order}), np.uint16)
        made = [next(run(iter([pa.RecordBatch.from_pydict({"ids": pa.array([d.tobytes() for d in t], pa.binary())})]))) for t in tasks]
        sums.append(sum(np.array(m.column("v").to_pylist()) for m in made))
    assert (sums[0] == sums[1]).all() and sums[0][-1, 0] == len(docs)
    x = np.concatenate([order.sketches(d, np.array([len(d)])) for d in docs])
    order.learn(len(docs), sums[0][P.SKETCH], sums[0][: P.SKETCH])
    want = np.linalg.svd(x - x.mean(0), full_matrices=False)[2][: P.DIRECTIONS].T
    assert np.allclose(np.abs((want * order.directions).sum(0)), 1)
    keys = order.keys(np.concatenate(docs), np.array([len(d) for d in docs]))
    assert keys.tolist() == [int(order.keys(d, np.array([len(d)]))[0]) for d in docs]
    for d, key in zip(docs[:200], keys.tolist()):
        assert [key >> 36 & 0x3FFFF, key >> 18 & 0x3FFFF, key & 0x3FFFF] == [min(set(d.tolist()), key=lambda t: rank[t]) for rank in order.ranks]


def test_related_documents_far_apart_share_a_window(documents):
    """Copies with a few changes at both ends of a table of some ten shards; in order of rows they would never meet."""
    r = random.Random(9)
    vocabulary = ["".join(r.choice("abcdefghijklmnop") for _ in range(7)) for _ in range(3000)]
    rows = [" ".join(r.choice(vocabulary) for _ in range(60)) for _ in range(300)]
    near = [" ".join(r.choice(vocabulary) if r.random() < 0.05 else w for w in t.split()) for t in rows[:20]]
    texts = [*enumerate(rows), *enumerate(near, 1000)]
    got = P.pack_documents(documents(texts), tokenizer_path(), window=2048, shard_tokens=7_000).toPandas()
    where = got.groupby("doc_id").sequence_id.agg(set)
    together = sum(bool(where[i] & where[1000 + i]) for i in range(20))
    shards = got.length.sum() / 7_000
    assert shards > 8 and together >= 14
