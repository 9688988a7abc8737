import hashlib
import random
import zlib

import pytest
from pyspark.sql import functions as F

from panelwise.llm import merkle as M

SCHEMA = "text string, Tree int, doc_id long, pos long, source string, lang string, n_chars long, `a.b` string, id string"


def h(*parts):
    return hashlib.sha256("".join(parts).encode()).hexdigest()


def leaf(row, more=0):
    i, source, lang, n, text = row
    n = None if n is None else n + more
    return h(*["-" if v is None else f"{len(str(v).encode())}:{v}" for v in (i, source, lang, n, text)])


def levels(nodes):
    out = [nodes]
    while len(out[-1]) > 1:
        out.append([h(*out[-1][i : i + 2]) for i in range(0, len(out[-1]), 2)])
    return out


def siblings(tree, i):
    found = []
    for row in tree[:-1]:
        found.append((i & 1, row[i ^ 1] if i ^ 1 < len(row) else None))
        i >>= 1
    return found


def brute(rows):
    """(doc_id, leaf, subroot, root, proof, folded root, verified) of every row, by plain lists."""
    langs = sorted({r[2] for r in rows}, key=lambda x: (x is not None, (x or "").encode()))
    groups = [sorted((r for r in rows if r[2] == x), key=lambda r: (r[0] is not None, r[0] or 0, leaf(r))) for x in langs]
    trees = [levels([leaf(r) for r in g]) for g in groups]
    top = levels([t[-1][0] for t in trees])
    out = []
    for k, (group, tree) in enumerate(zip(groups, trees)):
        for i, r in enumerate(group):
            path = siblings(tree, i) + siblings(top, k)
            tampered = r[0] is not None and zlib.crc32(str(r[0]).encode()) % 7 == 0
            folded = leaf(r, 1 if tampered else 0)
            for left, other in path:
                folded = h(folded) if other is None else h(other, folded) if left else h(folded, other)
            proof = "".join(o for _, o in path if o)
            out.append((r[0], leaf(r), tree[-1][0], top[-1][0], proof, folded, folded == top[-1][0]))
    return out


def table(spark, rows):
    return spark.createDataFrame([(t, 1, i, 2, s, g, n, "x", "y") for i, s, g, n, t in rows], SCHEMA)


def built(spark, rows, tamper=True):
    docs = table(spark, rows)
    return M.build(docs, changed={"n_chars": F.col("n_chars") + 1}, where=F.crc32(F.col("doc_id").cast("string")) % 7 == 0) if tamper else M.build(docs)


def found(manifest, **more):
    cols = ["doc_id", "leaf", "subroot", "root", F.lower(F.hex("proof")), "folded_root", "verified"]
    return sorted(map(tuple, M.verify(manifest, **more).select(*cols).collect()), key=str)


def rows_of(n, langs, seed=0):
    r = random.Random(seed)
    return [(r.randrange(-n, 4 * n), r.choice(["web", None, "é:1"]), r.choice(langs), r.choice([None, r.randrange(100)]), r.choice([None, "", "a", "ü" * 50, "-"])) for _ in range(n)]


@pytest.mark.parametrize("stride, n", [(3, 1), (10, 2), (1, 5), (3, 64), (3, 300), (10, 65)])
def test_against_plain_lists(spark, monkeypatch, stride, n):
    monkeypatch.setattr(M, "STRIDE", stride)
    rows = rows_of(n, ["en", "en", "de", None, "", "zz", "é"] if n > 5 else ["en"], n)
    assert found(built(spark, rows)) == sorted(brute(rows), key=str)


def test_joins_without_broadcast_give_the_same(spark, monkeypatch):
    monkeypatch.setattr(M, "STRIDE", 2)
    rows = rows_of(200, ["en"] * 8 + [f"l{i}" for i in range(20)], 7)
    manifest = built(spark, rows)
    assert found(manifest, max_bytes=0) == found(manifest) == sorted(brute(rows), key=str)


def test_odd_rows_and_empty_tables(spark):
    long = "x" * 3_000_000
    rows = [(None, None, None, None, None)] * 3 + [(None, "s", None, 1, "null id")] + [(5, "s", "en", 1, long), (5, "s", "en", 1, long), (5, "s", "en", 2, long), (6, "s", "en", None, "")]
    rows += [(9, "s", "en", 1, "copies")] * 40
    assert found(built(spark, rows)) == sorted(brute(rows), key=str)
    assert built(spark, rows[:1], tamper=False).root == leaf(rows[0])
    assert all(r.verified for r in M.verify(built(spark, rows, tamper=False)).collect())
    none = built(spark, [])
    assert none.root is None and found(none) == []


def test_every_change_is_found(spark):
    rows = rows_of(50, ["en", "de"], 3)
    docs = table(spark, rows)
    root = M.build(docs).root
    assert M.build(docs.orderBy("text")).root == root
    for name, value in (("text", "changed"), ("source", "changed"), ("n_chars", 1000), ("lang", "fr")):
        assert M.build(docs.withColumn(name, F.when(F.col("doc_id") == rows[0][0], F.lit(value)).otherwise(F.col(name)))).root != root
    assert M.build(docs.filter(F.col("doc_id") != rows[0][0])).root != root
