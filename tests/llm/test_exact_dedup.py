import hashlib
import re

from panelwise.llm import exact_dedup as X


def expected(rows):
    groups = {}
    for n, (i, t) in enumerate(rows):
        key = hashlib.sha256(re.sub(r"[\x20\x09-\x0D]", "", t or "").encode()).hexdigest()
        groups.setdefault(key, []).append((-len(t or ""), i is None, i or 0, i))
    return {k: (min(v)[3], len(v)) for k, v in groups.items()}


def test_groups_against_brute_force(documents, odd_rows):
    for limit in (X.MAX_BROADCAST_BYTES, 4096):  # the smallest filter there is: one block
        got = X.exact_groups(documents(odd_rows), max_filter_bytes=limit).collect()
        want = expected(odd_rows)
        assert len(got) == len(odd_rows)
        for r in got:
            assert (r.keep_id, r.group_size) == want[r.text_sha256]
        kept = [r.text_sha256 for r in got if r.kept]
        assert sorted(kept) == sorted(want)


def test_documents_that_stay(documents, odd_rows):
    docs = documents(odd_rows, clashing=True)
    got = X.exact_dedup(docs)
    assert got.columns == docs.columns
    rows = got.collect()
    want = expected(odd_rows)
    assert len(rows) == len(want)
    assert {expected([(r.doc_id, r.text)]).popitem()[0]: r.doc_id for r in rows} == {k: v[0] for k, v in want.items()}


def test_rows_without_a_copy_do_not_shuffle(documents, odd_rows):
    docs = documents([(i, f"text number {i}") for i in range(5000)])
    digests = docs.select(X.text_digest(docs.text).alias("d"))
    bits, blocks = X.repeat_filter(digests, "d")
    flagged = X.flag_repeated(digests, "d", bits, blocks, "again")
    assert flagged.filter("again").count() < 250  # 16 bits and two slots a row: some 1.4 %


def test_empty_table(documents):
    assert X.exact_groups(documents([])).count() == 0
    assert X.exact_dedup(documents([], True)).count() == 0
