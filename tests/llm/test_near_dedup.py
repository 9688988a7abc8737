import random
import re

import numpy as np
import pytest

from panelwise.llm import near_dedup as N
from panelwise.llm.common import Scratch
from panelwise.llm.components import components


def shingle_set(text, k):
    w = [x for x in re.split(r"[\x20\x09-\x0D]+", re.sub("[A-Z]", lambda m: m.group().lower(), text or "")) if x]
    return {tuple(w[i : i + k]) for i in range(len(w) - k + 1)} if len(w) >= k else ({tuple(w)} if w else set())


def brute(rows, k, percent):
    sets = [shingle_set(t, k) for _, t in rows]
    parent = list(range(len(rows)))

    def find(i):
        while parent[i] != i:
            i = parent[i]
        return i

    for i in range(len(rows)):
        for j in range(i):
            n = len(sets[i] & sets[j])
            if n and 100 * n >= percent * (len(sets[i]) + len(sets[j]) - n):
                parent[find(i)] = find(j)
    low = {}
    for n, (i, _) in enumerate(rows):
        low.setdefault(find(n), []).append((i is None, i or 0, i))
    return [(i, len(s), min(low[find(n)])[2]) for n, ((i, _), s) in enumerate(zip(rows, sets))]


@pytest.fixture(scope="module")
def near_rows(odd_rows, words):
    r = random.Random(8)
    rows = list(odd_rows)
    for group in range(6):
        base = [r.choice(words) for _ in range(120)]
        for _ in range(40):
            own = list(base)
            for _ in range(r.randint(0, 5)):
                own[r.randrange(len(own))] = r.choice(words)
            rows.append((1000 + len(rows), " ".join(own).title() if group % 2 else "\n".join(own)))
    return rows


@pytest.mark.parametrize("k,percent,block", [(3, 85, 512), (5, 80, 512), (3, 85, 4)])
def test_components_against_all_pairs(documents, near_rows, k, percent, block, monkeypatch):
    monkeypatch.setattr(N, "BLOCK", block)
    got = N.near_groups(documents(near_rows), k=k, percent=percent).collect()
    key = lambda x: tuple((v is None, v or 0) for v in x)
    assert sorted(((r.doc_id, r.n_shingles, r.component_id) for r in got), key=key) == sorted(brute(near_rows, k, percent), key=key)


def test_one_of_each_group_stays(documents, near_rows):
    docs = documents(near_rows, clashing=True)
    got = N.near_dedup(docs)
    assert got.columns == docs.columns
    rows = got.collect()
    want = brute(near_rows, 5, 80)
    blank = sum(n == 0 for _, n, _ in want)
    groups = {c for _, n, c in want if n}
    assert len(rows) == len(groups) + blank  # one group of null ids is among them
    assert {r.doc_id for r in rows if (r.text or "").strip()} == groups


def test_empty_table(documents):
    assert N.near_groups(documents([])).count() == 0
    assert N.near_dedup(documents([(1, None), (2, " ")])).count() == 2


def test_signature_of_similar_sets():
    r = np.random.default_rng(1)
    a = np.unique(r.integers(0, 2**63, 1000).astype(np.uint64))
    b = np.unique(np.concatenate([a[:900], r.integers(0, 2**63, 100).astype(np.uint64)]))
    x, y = N._signatures([a, b])
    assert abs((x == y).mean() - 900 / (len(a) + len(b) - 900)) < 0.1


def test_components_of_a_long_path_and_a_large_star(spark):
    path = [(i, i + 1) for i in range(300)]
    star = [(1000, 1001 + i) for i in range(2000)] + [(5000, 4000), (4000, 4000)]
    got = components(spark.createDataFrame([(b, a) for a, b in path] + star, "u long, v long"), Scratch(spark, "test")).collect()
    roots = {r.node: r.root for r in got}
    assert all(roots[i] == 0 for i in range(1, 301)) and all(roots[1001 + i] == 1000 for i in range(2000)) and roots[5000] == 4000
    assert len(roots) == 300 + 2000 + 1
