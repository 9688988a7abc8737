import random
import zlib

import numpy as np
import pytest

from panelwise.llm import toxicity as T
from panelwise.llm.common import NO_LETTERS, WordHasher


def corpus(words, n=1500):
    r = random.Random(9)
    rows, labels = [], []
    insults = ["xq" + w + "um" for w in words[:6]]
    for i in range(n):
        w = [r.choice(words[50:]) for _ in range(r.randint(20, 120))]
        kind = r.random()
        if kind < 0.15:
            w[3] = r.choice(insults) + r.choice(["", "!", ","])
        rows.append((i, " ".join(w)))
        labels.append((i, int(kind < 0.15)))
    return rows, labels, insults


@pytest.fixture(scope="module")
def trained(spark, words):
    rows, labels, insults = corpus(words)
    docs = spark.createDataFrame(rows, "doc_id long, text string")
    own = spark.createDataFrame([*labels, (None, 1), (5000, None)], "doc_id long, toxic int")
    return docs, dict(labels), T.train(docs, own), insults


def test_held_out_accuracy(trained):
    docs, labels, model, _ = trained
    scored = T.score(docs, model).select("doc_id", T.held_out(docs.doc_id).alias("held"), "score").collect()
    assert {r.doc_id for r in scored if r.held} == {i for i in labels if zlib.crc32(str(i).encode()) % 4 == 2}
    held = [r for r in scored if r.held]
    wrong = sum((r.score >= T.THRESHOLD) != labels[r.doc_id] for r in held)
    assert len(held) > 300 and wrong <= len(held) * 0.02


def test_odd_texts_and_columns(documents, odd_rows, trained):
    docs, _, model, insults = trained
    wide = documents([*odd_rows, (900, f"so {insults[0]} it is")], clashing=True)
    got = T.score(wide, model)
    assert sorted(got.columns) == sorted(wide.columns)
    rows = got.collect()
    assert len(rows) == len(odd_rows) + 1 and all(0 <= r.score <= 1 for r in rows)
    assert {r.score for r in rows if not r.text} and len({r.score for r in rows if not r.text}) == 1
    assert [r.score >= T.THRESHOLD for r in rows if r.doc_id == 900] == [True]


def test_clean_documents_stay(spark, documents, trained):
    docs, labels, _, _ = trained
    own = spark.createDataFrame(list(labels.items()), "doc_id long, toxic int")
    left = {r.doc_id for r in T.drop_toxic(docs, own).collect()}
    assert len([i for i, y in labels.items() if not y and i not in left]) <= 5
    assert len([i for i, y in labels.items() if y and i in left]) <= 5


def test_pairs_are_learned():
    """Two terms that mean something only together: no additive weights can part these."""
    r = np.random.default_rng(4)
    sets, labels = [], []
    for _ in range(2000):
        a, b = r.integers(0, 2, 2)
        own = {10 + a, 20 + b, *r.integers(100, 130, 3).tolist()}
        sets.append(np.array(sorted(own), np.int32))
        labels.append(float(a == b))
    labels = np.array(labels)
    old, T.np.abs = T.np.abs, lambda x: np.full_like(x, 9.0) if isinstance(x, np.ndarray) and len(x) == 1 << T.TERM_BITS else old(x)
    try:
        model = T.fit(sets, labels, np.ones(len(sets)))
    finally:
        T.np.abs = old
    place = {t: i for i, t in enumerate(model["known"].tolist())}
    flat = [np.array([place[t] for t in s if t in place]) for s in sets]
    bounds = np.concatenate(([0], np.cumsum([len(f) for f in flat])))
    margin, _ = T._margins(bounds, np.concatenate(flat), model["bias"], model["w"], model["v"])
    assert ((margin > 0) == labels).mean() > 0.95


def margins_of(model, sets):
    place = {t: i for i, t in enumerate(model["known"].tolist())}
    flat = [np.array([place[t] for t in s if t in place], int) for s in sets]
    return T._margins(np.concatenate(([0], np.cumsum([len(f) for f in flat]))), np.concatenate(flat), model["bias"], model["w"], model["v"])[0]


def test_pairs_are_learned_by_fit_as_it_is():
    """As above, and nothing is replaced: each of the terms alone says nothing of the label."""
    r = np.random.default_rng(4)
    bits = r.integers(0, 2, (2000, 2))
    sets = [np.unique([10 + a, 20 + b, *r.integers(100, 130, 3).tolist()]).astype(np.int32) for a, b in bits.tolist()]
    labels = (bits[:, 0] == bits[:, 1]).astype(float)
    model = T.fit(sets, labels, np.ones(len(sets)))
    assert ((margins_of(model, sets) > 0) == labels).mean() > 0.95
    assert ((margins_of(model | {"v": np.zeros_like(model["v"])}, sets) > 0) == labels).mean() < 0.6  # no additive weights can


def test_an_insult_and_a_mention_are_toxic_only_together():
    """Either of both goes with toxic texts exactly as often as any word does."""
    r = np.random.default_rng(6)
    sets, labels, kinds = [], [], []
    for kind in r.choice(4, 4000, p=[0.09, 0.21, 0.21, 0.49]).tolist():
        own = set(r.integers(100, 2000, 30).tolist())
        own |= {10} if kind == 0 or kind == 1 else set()
        own |= {11} if kind == 0 or kind == 2 else set()
        other = kind == 3 and r.random() < 0.43
        own |= {12} if other else set()
        sets.append(np.array(sorted(own), np.int32))
        labels.append(float(kind == 0 or other))
        kinds.append(kind)
    labels, kinds = np.array(labels), np.array(kinds)
    model = T.fit(sets[:3000], labels[:3000], np.ones(3000))
    found = margins_of(model, sets[3000:]) >= np.log(T.THRESHOLD / (1 - T.THRESHOLD))
    assert found[kinds[3000:] == 0].mean() > 0.8 and (found == labels[3000:]).mean() > 0.9


def test_margins_are_the_sum_over_all_pairs():
    r = np.random.default_rng(2)
    w, v = r.normal(size=50), r.normal(size=(50, T.FACTORS))
    sets = [np.sort(r.choice(50, n, replace=False)) for n in (0, 1, 2, 17, 50)]
    got, _ = T._margins(np.concatenate(([0], np.cumsum([len(s) for s in sets]))), np.concatenate(sets), 0.7, w, v)
    for m, s in zip(got, sets):
        assert m == pytest.approx(0.7 + w[s].sum() + sum(v[i] @ v[j] for n, i in enumerate(s) for j in s[:n]))


def test_long_texts_in_parts(words):
    r = random.Random(1)
    text = " ".join(r.choice(words) for _ in range(400_000)).encode()
    hasher = WordHasher(NO_LETTERS)
    (got,) = T.terms([memoryview(text)], hasher)
    whole, _ = hasher.stems([memoryview(text)], T.STEMS)
    assert np.array_equal(got, np.unique((whole & np.uint64((1 << T.TERM_BITS) - 1)).astype(np.int32)))


def test_no_labels_and_empty_tables(spark, documents):
    none = spark.createDataFrame([], "doc_id long, toxic int")
    docs = documents([(1, "some words"), (2, None)])
    assert [r.score for r in T.score(docs, T.train(docs, none)).collect()] == [0.5, 0.5]
    some = spark.createDataFrame([(1, 1), (2, 0)], "doc_id long, toxic int")
    assert T.score(documents([]), T.train(documents([]), some)).count() == 0


def test_stems_of_terms():
    a, b = T.terms([memoryview(b"Zonderling, here"), memoryview(b"zonderlijk HERE")], WordHasher(NO_LETTERS))
    assert len(np.intersect1d(a, b)) == 5  # "here", and the first 4, 5, 6 and 8 bytes of the other word
