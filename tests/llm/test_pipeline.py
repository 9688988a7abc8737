import random
import re

import pyarrow.parquet as pq
import pytest

import corpus_pipeline as P
from panelwise.llm import queries as Q
from panelwise.llm import toxicity

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def folder(spark, odd_rows, words, tmp_path_factory):
    """Documents with toxic ones, copies, near copies, leaks and odd rows; and the other tables the stages read."""
    r = random.Random(20)
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    rows, labels = list(odd_rows), []
    for i in range(1000, 1800):
        toxic = i % 7 == 0
        rows.append((i, text(40) + (" xqinsultum " if toxic else " ") + text(20)))
        labels.append((i, 1, int(toxic)))
    items = [(i, text(30)) for i in range(20)]
    rows += [(3000 + i, f"{text(25)}\n{t}\n{text(10)}") for i, t in items]
    for i in range(30):
        base = text(120).split()
        rows.append((4000 + 2 * i, " ".join(base)))
        base[60] = "changed"
        rows.append((4001 + 2 * i, " ".join(base)))
    path = str(tmp_path_factory.mktemp("tables"))
    docs = [(i, t, "en", "src0", len(t or "")) for i, t in rows]
    spark.createDataFrame(docs, "doc_id long, text string, lang string, source string, n_chars long").write.parquet(f"{path}/documents.parquet")
    spark.createDataFrame(labels, "doc_id long, quality int, toxic int").write.parquet(f"{path}/labels.parquet")
    spark.createDataFrame(items, "item_id long, text string").write.parquet(f"{path}/benchmark.parquet")
    return path, rows, items


def test_stages_against_brute_force(spark, folder):
    path, rows, items = folder
    docs = Q.table(spark, path, "documents")
    columns = docs.columns
    scores = {(r.doc_id, r.text): r.score for r in toxicity.score(docs, toxicity.train(docs, Q.table(spark, path, "labels"))).collect()}
    want = [x for x in rows if scores[x] < toxicity.THRESHOLD]
    assert {i for i, _ in rows if i and 1000 <= i < 1800 and i % 7 == 0}.isdisjoint({i for i, _ in want})
    steps = iter(P.STAGES)

    def after():
        nonlocal docs
        docs = spark.createDataFrame(next(steps)[1](spark, docs, path).collect(), docs.schema)
        assert docs.columns == columns
        return sorted(((r.doc_id, r.text) for r in docs.collect()), key=str)

    assert after() == sorted(want, key=str)

    best = {}
    for i, t in want:
        key, rank = re.sub(r"[\x20\x09-\x0D]", "", t or ""), (-len(t or ""), i is None, i or 0)
        best[key] = min(best.get(key, (rank, (i, t))), (rank, (i, t)), key=lambda x: x[0])
    want = [x for _, x in best.values()]
    got = after()
    assert [i for i, _ in got] == [i for i, _ in sorted(want, key=str)]
    want = got

    kept = []
    for i, t in sorted(want, key=lambda x: (x[0] is None, x[0] or 0)):
        w = (t or "").lower().split()
        own = {tuple(w[k : k + 5]) for k in range(len(w) - 4)} if len(w) >= 5 else ({tuple(w)} if w else set())
        if not own or not any(100 * len(own & o) >= 80 * len(own | o) for _, o in kept):
            kept.append(((i, t), own))
    want = [x for x, _ in kept]
    assert after() == sorted(want, key=str)

    want = [(i, t) for i, t in want if not any(x in (t or "") for _, x in items)]
    assert after() == sorted(want, key=str)
    pieces = next(steps)[1](spark, docs, path).collect()
    assert {r.doc_id for r in pieces} == {i for i, _ in want}


def test_run_is_the_stages_in_order(spark, folder):
    path, _, _ = folder
    rows = P.run(spark, path).collect()
    assert [n for n, _ in P.STAGES] == ["toxicity", "exact dedup", "near dedup", "benchmark decontamination", "packing"]
    ids = {r.doc_id for r in rows}
    assert {4000 + 2 * i for i in range(30)} <= ids and not {4001 + 2 * i for i in range(30)} & ids and not {3000 + i for i in range(20)} & ids


@pytest.mark.parametrize("name", sorted(Q.QUERIES))
def test_queries_cover_their_tables(spark, name):
    n = {t: pq.read_metadata(f"{SF}/{t}.parquet").num_rows for t in ("documents", "pages", "conversations")}
    rows = Q.QUERIES[name](spark, SF).collect()
    if name == "op9_chat":
        turns = pq.read_table(f"{SF}/conversations.parquet", columns=["conv_id"])["conv_id"].to_pylist()
        assert len(rows) == len({*turns, -1}) and sum(r.n_turns for r in rows) == len(turns) + 2
    elif name == "op7_packing":
        assert len({r.doc_id for r in rows}) == n["documents"]
    else:
        assert len(rows) == n["pages" if name in ("op1_url_filter", "op10_html") else "documents"]
