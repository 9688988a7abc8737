import hashlib
import random
import zlib
from fractions import Fraction

import numpy as np
import pytest

from panelwise.llm import queries as Q
from panelwise.llm import runs as R


def brute_lyndon(s):
    """NSS array: the longest Lyndon word at i ends where the next smaller suffix begins."""
    return [next((j for j in range(i + 1, len(s)) if s[j:] < s[i:]), len(s)) - i for i in range(len(s))]


def brute_runs(w, least=6, times=4):
    found = {}
    for q in range(1, len(w) // times + 1):
        i = 0
        while i + q < len(w):
            if w[i] != w[i + q]:
                i += 1
                continue
            e = i
            while e + q < len(w) and w[e] == w[e + q]:
                e += 1
            if e + q - i >= max(least, times * q):
                found.setdefault((i, e + q), q)  # a multiple of the period finds the same stretch later
            i = e
    return sorted((a, b - a, q) for (a, b), q in found.items())


def collapsed(w, runs):
    return " ".join(x for i, x in enumerate(w) if not any(s + q <= i < s + n for s, n, q in runs))


def test_lyndon_arrays():
    r = random.Random(5)
    for n in range(0, 9):
        for _ in range(300):
            s = [r.randrange(3) for _ in range(n)]
            s = np.unique(s, return_inverse=True)[1].tolist() if s else s
            assert R.lyndon_lengths(s) == brute_lyndon(s), s
    for _ in range(60):
        unit = [r.randrange(4) for _ in range(r.randint(1, 12))]
        s = [r.randrange(4) for _ in range(r.randint(0, 20))] + unit * r.randint(1, 12) + [r.randrange(4) for _ in range(r.randint(0, 20))]
        s = np.unique(s, return_inverse=True)[1].tolist()
        assert R.lyndon_lengths(s) == brute_lyndon(s), s
    assert R.lyndon_lengths([0] * 5) == [1] * 5 and R.lyndon_lengths(list(range(5))) == [5, 4, 3, 2, 1]


def texts(seed, n):
    r = random.Random(seed)
    for _ in range(n):
        kinds = r.randint(1, 5)
        w = []
        for _ in range(r.randint(0, 5)):
            unit = [r.choice("aBbcé"[:kinds]) for _ in range(r.randint(1, 6))]
            w += (unit * 9)[: len(unit) * r.randint(1, 7) + r.randint(0, 3)] + [r.choice("abcdefgh") for _ in range(r.randint(0, 4))]
        yield w


@pytest.mark.parametrize("least, times", [(6, 4), (6, 2), (2, 3), (9, 5)])
def test_runs_of_strings(least, times):
    hasher = R.WordHasher()
    hasher.code = R.numbered(256, 11)
    for w in texts(least, 400):
        text = memoryview(" ".join(w).encode())
        words, bounds = hasher.words([text])
        found = R.stretches(words, bounds, least, times)
        ids = R._Words(hasher, text).ids
        got = [(b + s, n, q) for (_, b, e), runs in zip(found, R.runs_in([ids[b:e] for _, b, e in found], least, times)) for s, n, q in runs]
        assert sorted(got) == brute_runs(w, least, times), w


def test_hashes_that_clash(monkeypatch):
    """With one code for all words every extension runs to the ends; the check by words mends it."""
    monkeypatch.setattr(R, "numbered", lambda n, seed: np.ones(n, np.uint64))
    r = random.Random(2)
    for _ in range(60):
        w = [r.randrange(9) for _ in range(r.randint(0, 9))]
        for _ in range(r.randint(1, 4)):
            w += [r.randrange(4) for _ in range(r.randint(1, 5))] * r.randint(1, 9)
        assert R.runs_in([np.array(w), np.array(w[::-1])], 6, 4) == [brute_runs(w), brute_runs(w[::-1])]


def test_frames(spark, documents, odd_rows):
    r = random.Random(8)
    rows = odd_rows + [(1000 + i, r.choice([" ", "\n", "\t  "]).join(w)) for i, w in enumerate(texts(9, 300))]
    unit = " ".join(f"w{i}" for i in range(5000))
    rows += [(2000, "ha " * 200_000), (2001, " ".join([unit] * 6)), (2002, "a A a A a A a A"), (2002, "a\xa0b a\xa0b a\xa0b a\xa0b a\xa0b a\xa0b")]
    got = R.find_runs(documents(rows, clashing=True)).collect()
    split = lambda t: [x.decode() for x in (t or "").encode().split()]
    want = []
    for i, t in rows:
        w = split(t)
        found = brute_runs(w) if len(w) < 500 else {2000: [(0, 200_000, 1)], 2001: [(0, 30_000, 5000)]}.get(i, [])
        want.append((i, found, (collapsed(w, found) if len(w) < 500 else {2000: "ha", 2001: unit}.get(i, " ".join(w)))))
    assert sorted(((x.doc_id, [tuple(y) for y in x.runs], x.collapsed) for x in got), key=str) == sorted(want, key=str)
    assert R.find_runs(documents([])).count() == 0


def test_query_against_brute_force(spark):
    sf = "/root/testdata/sf0.001"
    got = {r.doc_id: tuple(r) for r in Q.QUERIES["op13_runs"](spark, sf).collect()}
    planted = 0
    for d in Q.table(spark, sf, "documents").collect():
        w = [x.decode() for x in (d.text or "").encode().split()]
        h, n = zlib.crc32(str(d.doc_id).encode()), len(w)
        if h % 10 == 0 and n:
            g = h // 10
            a = g % n
            p = 1 + (n - a) // (3 + g % 8)
            w = [w[i] if i < a else w[a + (i - a) % p] for i in range(n)]
        if n > 3000:
            found = fast_runs(w)
        else:
            found = brute_runs(w)
        planted += bool(found)
        best = max(found, key=lambda r: (Fraction(r[1], r[2]), -r[0], -r[2]), default=None)
        four = (*best, 1000 * best[1] // best[2]) if best else (None,) * 4
        lines = "".join(f"{s},{k},{q}\n" for s, k, q in found)
        assert got.pop(d.doc_id) == (d.doc_id, len(found), *four, hashlib.sha256(lines.encode()).hexdigest(), hashlib.sha256(collapsed(w, found).encode()).hexdigest())
    assert not got and planted > 5


def fast_runs(w):
    ids = np.unique(w, return_inverse=True)[1]
    found = {}
    for q in range(1, len(ids) // 4 + 1):
        same = np.concatenate(([0], ids[:-q] == ids[q:], [0])).astype(np.int8)
        edge = np.diff(same)
        for a, b in zip(np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)):
            if b + q - a >= max(6, 4 * q):
                found.setdefault((int(a), int(b) + q), q)
    return sorted((a, b - a, q) for (a, b), q in found.items())
