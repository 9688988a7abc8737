import math
import random
from decimal import Decimal

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwise import runtime
from panelwise.operators import order_stats
from panelwise.operators.order_stats import exact_quantiles, order_statistics
from panelwise.operators.portfolio import assign_bins, predictions_long


@pytest.fixture(scope="module")
def skewed(spark):
    """Three groups; one holds most rows, with heavy ties in the middle, some values are missing."""
    rng = random.Random(7)
    rows = []
    for i in range(6000):
        g = "hot" if i % 3 else ("b" if i % 2 else "c")
        v = None if rng.random() < 0.05 else (0.5 if rng.random() < 0.3 else rng.gauss(0, 1))
        rows.append((g, i, v))
    rows += [("one", -1, 3.0), ("none", -2, None)]
    return spark.createDataFrame(rows, "g string, id long, v double").repartition(6), rows


def values_of(rows, group):
    return sorted(v for g, _, v in rows if g == group and v is not None)


@pytest.mark.parametrize("direct_rows", [None, 0])
def test_ranks_match_sorting(skewed, direct_rows):
    df, rows = skewed
    got = order_statistics(df, ["g"], "v", lambda n, m: [F.lit(0), F.lit(1), F.floor(m / 3), m, m + 1], direct_rows)
    found = {r["g"]: r for r in got.collect()}
    assert set(found) == {"hot", "b", "c", "one", "none"}
    for g, r in found.items():
        want = values_of(rows, g)
        assert r["m"] == len(want)
        assert r["n"] == sum(1 for row in rows if row[0] == g)
        third = len(want) // 3
        expected = [None, want[0] if want else None, want[third - 1] if third else None, want[-1] if want else None, None]
        assert list(r["stats"]) == expected


@pytest.mark.parametrize("direct_rows", [None, 0])
def test_quantiles_match_numpy(skewed, direct_rows):
    df, rows = skewed
    probs = [0.9975, 0.0025, 0.5]
    for r in exact_quantiles(df, ["g"], "v", probs, direct_rows).collect():
        want = values_of(rows, r["g"])
        if want:
            assert np.allclose(r["quantiles"], np.quantile(want, probs), atol=1e-12)
        else:
            assert r["quantiles"] == [None, None, None]


def test_a_bad_sketch_is_answered_without_brackets(skewed, monkeypatch):
    df, rows = skewed
    monkeypatch.setattr(order_stats, "ACCURACY", 1)
    missed = []
    plain = order_stats._pick_in_parts
    monkeypatch.setattr(order_stats, "_pick_in_parts", lambda *a: missed.append(1) or plain(*a))
    got = exact_quantiles(df, ["g"], "v", [0.1, 0.7], direct_rows=0, grid=200)
    assert missed
    for r in got.collect():
        want = values_of(rows, r["g"])
        if want:
            assert np.allclose(r["quantiles"], np.quantile(want, [0.1, 0.7]), atol=1e-12)


@pytest.mark.parametrize("share", [0.5, 0.01])
def test_a_guide_never_changes_the_result(skewed, share):
    """Half the rows, or so few that brackets miss and a small group is not seen at all."""
    df, rows = skewed
    guide = df.filter("g <> 'one'").sample(share, seed=3)
    for r in exact_quantiles(df, ["g"], "v", [0.05, 0.5, 0.99], direct_rows=0, grid=100, guide=guide).collect():
        want = values_of(rows, r["g"])
        if want:
            assert np.allclose(r["quantiles"], np.quantile(want, [0.05, 0.5, 0.99]), atol=1e-12)


def expected_bins(pairs, nport):
    """ceil(rank_min * nport / (n + 1)) by counting smaller values."""
    n = len(pairs)
    known = [v for _, v in pairs if v is not None]
    return {i: None if v is None else math.ceil((1 + sum(u < v for u in known)) * nport / (n + 1)) for i, v in pairs}


@pytest.mark.parametrize("window_rows,direct_rows", [(None, None), (0, None), (0, 0)])
@pytest.mark.parametrize("nport", [1, 2, 5, 10])
def test_bins_by_definition(spark, window_rows, direct_rows, nport):
    rng = random.Random(nport)
    groups = {"mixed": [(i, rng.choice([None, 0.0, 0.0, rng.random(), 1.0])) for i in range(200)]}
    groups["constant"] = [(i, 7.0) for i in range(200, 230)]
    groups["few"] = [(i, float(i)) for i in range(300, 303)]
    groups["empty"] = [(i, None) for i in range(400, 404)]
    groups["extreme"] = [(500, float("inf")), (501, float("-inf")), (502, 0.0)]
    df = spark.createDataFrame([(g, i, v) for g, p in groups.items() for i, v in p], "date string, id long, pred double")
    got = {r["id"]: r["bin"] for r in assign_bins(df, nport, ["date"], "pred", window_rows, direct_rows).collect()}
    want = {i: b for p in groups.values() for i, b in expected_bins(p, nport).items()}
    assert got == want


def test_not_a_number_is_missing(spark):
    df = spark.createDataFrame([("d", 1, 1.0), ("d", 2, float("nan")), ("d", 3, 2.0)], "date string, id long, pred double")
    got = {r["id"]: r["bin"] for r in assign_bins(df, 2, ["date"]).collect()}
    assert got == {1: 1, 2: None, 3: 1}


@pytest.mark.parametrize("direct_rows", [None, 0])
def test_nothing_small_enough_to_broadcast(spark, monkeypatch, direct_rows):
    """Every lookup exceeds the bound: staged tables and salted joins give the same bins."""
    rows = [(f"d{i % 40}" if i % 3 else "hot", i, float((i * 37) % 101)) for i in range(3000)]
    df = spark.createDataFrame(rows, "date string, id long, pred double")
    want = {r["id"]: r["bin"] for r in assign_bins(df, 5, ["date"]).collect()}
    monkeypatch.setattr(runtime, "MAX_BROADCAST_BYTES", 500)
    got = {r["id"]: r["bin"] for r in assign_bins(df, 5, ["date"], window_rows=0, direct_rows=direct_rows).collect()}
    assert got == want


BRANCHES = [(None, None), (0, None), (0, 0)]


@pytest.mark.parametrize("window_rows,direct_rows", BRANCHES)
def test_missing_group_keys_are_a_group(spark, window_rows, direct_rows):
    df = spark.createDataFrame([(None if i % 2 else "d", "m" if i % 3 else None, i, float(i)) for i in range(60)], "date string, model string, id long, pred double")
    got = {r["id"]: r["bin"] for r in assign_bins(df, 5, ["model", "date"], "pred", window_rows, direct_rows).collect()}
    groups = {}
    for i in range(60):
        groups.setdefault((i % 2, i % 3 > 0), []).append((i, float(i)))
    assert got == {i: b for p in groups.values() for i, b in expected_bins(p, 5).items()}


@pytest.mark.parametrize("window_rows,direct_rows", BRANCHES)
@pytest.mark.parametrize("kind,value", [("long", lambda i: 2**60 + i), ("decimal(38,10)", lambda i: Decimal(10**25 + i).scaleb(-10))])
def test_values_keep_their_type(spark, window_rows, direct_rows, kind, value):
    df = spark.createDataFrame([("d", i, value(i * 7 % 50)) for i in range(50)], f"date string, id long, pred {kind}")
    got = {r["id"]: r["bin"] for r in assign_bins(df, 5, ["date"], "pred", window_rows, direct_rows).collect()}
    assert got == expected_bins([(i, value(i * 7 % 50)) for i in range(50)], 5)


@pytest.mark.parametrize("accuracy", [2500, 1])
def test_brackets_shrink_until_a_task_can_sort_them(spark, monkeypatch, accuracy):
    """No window sorts more than the given number of distinct values, with good sketches and with useless ones."""
    monkeypatch.setattr(order_stats, "ACCURACY", accuracy)
    seen = []
    plain = order_stats._first_reaching
    monkeypatch.setattr(order_stats, "_first_reaching", lambda counts, within, *a: seen.append(counts.filter("_w is not null").groupBy(*within).count().agg(F.max("count")).first()[0]) or plain(counts, within, *a))
    df = spark.range(0, 200_000, 1, 8).select(F.lit("all").alias("g"), F.pmod(F.xxhash64("id"), F.lit(10**15)).alias("v"), "id")
    rows = [r["v"] for r in df.select("v").collect()]
    got = order_statistics(df, ["g"], "v", lambda n, m: [F.lit(1), F.lit(77_777), F.lit(77_778), m], direct_rows=0, segment_rows=300).first()
    rows.sort()
    assert list(got["stats"]) == [rows[0], rows[77_776], rows[77_777], rows[-1]]
    assert seen and max(seen) <= 300


def test_model_names_of_any_length(spark):
    name = "x" * 1200
    wide = spark.createDataFrame([(1, "d", 0.1, 1.0, 2.0)], f"permno long, date string, ret double, pred_{name} double, pred_{name}y double")
    assert sorted(r["model"] for r in predictions_long(wide).collect()) == [name, name + "y"]
