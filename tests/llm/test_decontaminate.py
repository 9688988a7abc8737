import random
import re

import numpy as np
import pytest

from panelwise.llm import decontaminate as D
from panelwise.llm.common import NO_LETTERS, WordHasher


@pytest.fixture(scope="module")
def items(words):
    r = random.Random(5)
    return [(i, " ".join(r.choice(words) for _ in range(r.randint(15, 60)))) for i in range(30)] + [(90, None), (91, "too short"), (92, "")]


def brute_tiles(item, doc, least):
    """Greedy string tiling by trying all pairs of places."""
    used_item, used_doc = [False] * len(item), [False] * len(doc)
    while True:
        best = (0, 0, 0)
        for i in range(len(item)):
            for j in range(len(doc)):
                n = 0
                while i + n < len(item) and j + n < len(doc) and item[i + n] == doc[j + n] and not used_item[i + n] and not used_doc[j + n]:
                    n += 1
                if n > best[0]:
                    best = (n, i, j)
        n, i, j = best
        if n < least:
            return sum(used_item)
        for k in range(n):
            used_item[i + k] = used_doc[j + k] = True


def test_tiles_against_brute_force():
    r = random.Random(6)
    for _ in range(200):
        letters = r.choice([3, 8, 30])
        item = [r.randrange(letters) for _ in range(r.randint(0, 25))]
        doc = [r.randrange(letters) for _ in range(r.randint(0, 40))]
        for _ in range(r.randint(0, 3)):
            at, n = r.randrange(len(item) + 1), r.randint(2, 12)
            doc += item[at : at + n]
        a, b = np.array(item, np.uint64), np.array(doc, np.uint64)
        assert D.tile(a, b, 3) == brute_tiles(item, doc, 3)


def test_finds_whole_reordered_and_edited_passages_and_leaves_others(spark, documents, items, odd_rows, words):
    r = random.Random(7)
    noise = lambda n: " ".join(r.choice(words) for _ in range(n))
    rows, bad = list(odd_rows), set()
    for n, (i, t) in enumerate(items[:30]):
        w = t.split()
        half = len(w) // 2
        kinds = [f"{noise(50)}\n{t.upper()}, {noise(9)}", f"{' '.join(w[half:])} {noise(7)} {' '.join(w[:half])}", " ".join(x if k != half else "changed" for k, x in enumerate(w))]
        rows.append((1000 + n, kinds[n % 3]))
        bad.add(1000 + n)
        rows.append((2000 + n, noise(30) + " " + " ".join(w[: len(w) // 3])))  # a third of an item is no leak
    docs, bench = documents(rows, clashing=True), spark.createDataFrame(items, "item_id long, text string")
    got = D.contamination(docs, bench).collect()
    assert len(got) == len(rows)
    assert {x.doc_id for x in got if x.contaminated} == bad
    assert {x.doc_id: x.item_id for x in got if x.contaminated} == {1000 + n: n for n in range(30)}
    left = D.decontaminate(docs, bench)
    assert left.columns == docs.columns and left.count() == len(rows) - 30


def test_empty_tables(spark, documents, items):
    none = spark.createDataFrame([], "item_id long, text string")
    assert D.decontaminate(documents([(1, "some text"), (None, None)]), none).count() == 2
    assert D.contamination(documents([]), spark.createDataFrame(items, "item_id long, text string")).count() == 0


def test_long_words_and_texts_hash_alike():
    h = WordHasher(NO_LETTERS)
    text = ("word, " * 900_000 + "x" * 3_000_000 + " Word").encode()
    found, _ = h.words([memoryview(text)])
    assert len(found) == 900_002 and len(set(found.tolist())) == 2 and found[0] == found[-1]


def test_typographic_marks_part_words(spark, documents, words):
    r = random.Random(17)
    own = [r.choice(words) for _ in range(20)]
    quoted = " ".join(("“" if n % 4 == 0 else "") + w + ("” —" if n % 4 == 3 else "") for n, w in enumerate(own))
    rows = [(1, quoted), (2, "…".join(own)), (3, "　".join(own)), (4, "\xa0«".join(own)), (5, "é".join(own))]
    bench = spark.createDataFrame([(7, " ".join(own)), (8, "„".join(reversed(own)))], "item_id long, text string")
    rows.append((6, " ".join(reversed(own))))
    got = {x.doc_id: (x.contaminated, x.item_id) for x in D.contamination(documents(rows), bench).collect()}
    assert got == {1: (True, 7), 2: (True, 7), 3: (True, 7), 4: (True, 7), 5: (False, None), 6: (True, 8)}


def test_query_against_every_pair(spark, documents, items, odd_rows, words):
    """The whole result against tiling every document with every item, without seeds."""
    r = random.Random(23)
    rows = list(odd_rows)
    for n in range(250):
        w = [r.choice(words) for _ in range(r.randint(0, 80))]
        for _ in range(r.randint(0, 4)):
            own = r.choice(items[:30])[1].split()
            at = r.randrange(len(own))
            w[r.randrange(len(w) + 1) : 0] = own[at : at + r.randint(3, 40)]
        rows.append((5000 + n, r.choice([" ", ", ", "—"]).join(w)))
    split = lambda t: [x for x in re.sub(r"[^a-z0-9]+", " ", re.sub("—", " ", (t or "").lower())).split()]
    number = {w: i for i, w in enumerate(words)}
    coded = lambda t: np.array([number.get(x, len(number) + hash(x) % 10**6) for x in split(t)], np.uint64)
    bench = [(i, coded(t)) for i, t in items if len(split(t)) >= 5]
    want = []
    for i, t in rows:
        doc = coded(t)
        shares = [(D.tile(item, doc, 5) / len(item), n) for n, item in bench]
        found = [(s, n) for s, n in shares if s >= 0.6]
        best = min(((-s, n) for s, n in found), default=None)
        want.append((i, bool(found), len(found), best and best[1], best and round(-best[0], 9)))
    got = D.contamination(documents(rows), spark.createDataFrame(items, "item_id long, text string")).collect()
    assert sorted(((x.doc_id, x.contaminated, x.n_items, x.item_id, x.coverage and round(x.coverage, 9)) for x in got), key=str) == sorted(want, key=str)
    assert sum(x.contaminated for x in got) > 30
