import hashlib
import random

import numpy as np
import pytest

from panelwise.llm import suffix_dedup as S


def brute(rows, length=100):
    """Rows in the order given; windows seen before are removed."""
    order = sorted(range(len(rows)), key=lambda n: (rows[n][0] is None, rows[n][0] or 0, n))
    seen, out = set(), [None] * len(rows)
    for n in order:
        i, t = rows[n]
        b = (t or "").encode()
        gone = np.zeros(len(b), bool)
        for p in range(len(b) - length + 1):
            w = b[p : p + length]
            if w in seen:
                gone[p : p + length] = True
            else:
                seen.add(w)
        left = np.frombuffer(b, np.uint8)[~gone].tobytes()
        out[n] = (i, len(b), int(gone.sum()), int((np.diff(gone.astype(np.int8), prepend=0) == 1).sum()), hashlib.sha256(left).hexdigest())
    return out


@pytest.fixture(scope="module")
def repeat_rows(words):
    r = random.Random(12)
    text = lambda n: " ".join(r.choice(words) for _ in range(n))
    line, passage, page = text(13)[:70], text(40), text(150)
    rows = [(i, text(r.randint(0, 80))) for i in range(30)]
    rows += [(40 + i, f"{text(r.randint(0, 20))} {line} {text(r.randint(0, 20))}") for i in range(60)]  # shorter than a window, with many contexts
    rows += [(120 + i, f"{text(r.randint(0, 9))}\n{passage}{text(r.randint(0, 9))}") for i in range(40)]
    rows += [(200 + i, page) for i in range(30)]  # copies, and near copies
    for i in range(30):
        w = page.split()
        w[r.randrange(len(w))] = "édit"
        rows.append((250 + i, " ".join(w)))
    rows += [(300, "ab" * 400), (301, "a" * 500), (302, passage + passage), (303, None), (304, ""), (305, "x" * 99), (306, "x" * 100), (None, page), (None, page), (307, page), (307, page)]
    r.shuffle(rows)
    return rows


@pytest.mark.parametrize("many,run,part", [(S.MANY, S.RUN, S.RANGE), (3, 50, 40), (1, S.RUN, S.RANGE)])
def test_against_all_windows(documents, repeat_rows, many, run, part, monkeypatch):
    """Many runs and ranges, and windows grouped by hash, give the same."""
    monkeypatch.setattr(S, "RUN", run)
    monkeypatch.setattr(S, "RANGE", part)
    got = S.remove_repeats(documents(repeat_rows, clashing=True).coalesce(1), many=many).collect()
    key = lambda x: tuple((v is None, v or 0) if not isinstance(v, str) else (False, v) for v in x)
    assert sorted([tuple(r)[:5] for r in got], key=key) == sorted(brute(repeat_rows), key=key)
    assert all(len(r.kept) == r.n_bytes - r.n_removed and hashlib.sha256(r.kept).hexdigest() == r.kept_sha256 for r in got)


def test_long_texts_are_cut_between_windows(words):
    r = random.Random(2)
    text = " ".join(r.choice(words) for _ in range(20_000)).encode()
    whole = next(iter(S.pieces([memoryview(text)], 100)))
    first, count, place, hashes = S.anchors(whole[0], whole[2], 100, S._code())
    assert count.sum() == len(text) - 99 and count.max() <= 69 and ((place >= first + count - 1) & (place - first <= 68)).all()
    old, S.SLICE_BYTES = S.SLICE_BYTES, 5000
    try:
        windows, by_hash = 0, set()
        for data, _, begins, offset in S.pieces([memoryview(text)], 100):
            f, c, p, h = S.anchors(data, begins, 100, S._code())
            move = (offset - begins)[np.searchsorted(begins, f, "right") - 1]
            windows += c.sum()
            by_hash |= set(zip((p + move).tolist(), h.tolist()))
        assert windows == len(text) - 99 and by_hash == set(zip(place.tolist(), hashes.tolist()))
    finally:
        S.SLICE_BYTES = old


def test_merge_of_runs():
    r = random.Random(3)
    for _ in range(50):
        runs = [sorted(bytes(r.choice(b"ab") for _ in range(r.randint(1, 9))) for _ in range(r.randint(1, 20))) for _ in range(r.randint(1, 9))]
        coded = [S.front_code(x) for x in runs]
        merged = list(S.merge_runs(coded))
        strings = [runs[a][i] for a, i, _ in merged]
        assert strings == sorted(s for x in runs for s in x)
        shared = [n for _, _, n in merged]
        assert shared[1:] == [S.common_prefix(a, b, 0) for a, b in zip(strings, strings[1:])]


def test_empty_table(documents):
    assert S.remove_repeats(documents([])).count() == 0
    assert [r.n_removed for r in S.remove_repeats(documents([(1, None), (2, "")])).collect()] == [0, 0]


def test_copies_too_many_to_broadcast(documents, repeat_rows, monkeypatch):
    """Whole copies are then looked at like all others."""
    monkeypatch.setattr(S, "MAX_BROADCAST_BYTES", 0)
    got = S.remove_repeats(documents(repeat_rows).coalesce(1)).collect()
    assert sorted((r.n_bytes, r.n_removed, r.n_spans, r.kept_sha256) for r in got) == sorted(b[1:] for b in brute(repeat_rows))
