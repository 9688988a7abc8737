from datetime import date

import pytest
from pyspark.sql import functions as F

from panelwise.functions import columns, dates
from panelwise.operators import panel, summary


def test_returns_panel(spark):
    raw = spark.createDataFrame(
        [(1, date(1974, 12, 31), 1.0), (1, date(1975, 2, 3), 2.0), (1, date(1975, 3, 31), float("nan")), (2, date(2000, 2, 29), None)],
        "permno long, date date, ret double",
    )
    assert [tuple(r) for r in panel.returns_panel(raw).collect()] == [(1, date(1975, 2, 28), 2.0)]


def test_january_signals_meet_february_returns(spark):
    signals = spark.createDataFrame([(1, 201001, 5.0, float("nan")), (1, 201012, None, 1.0)], "permno long, yyyymm int, a double, b double")
    got = panel.lag_signals(signals)
    assert got.columns == ["permno", "date", "yyyymm_signals", "a", "b"]
    assert [tuple(r) for r in got.orderBy("date").collect()] == [(1, date(2010, 2, 28), "201001", 5.0, None), (1, date(2011, 1, 28), "201012", None, 1.0)]
    with pytest.raises(ValueError, match="differ only by case"):
        panel.lag_signals(spark.createDataFrame([(1, 201001, 1.0, 2.0)], "permno long, yyyymm int, Beta double, beta double"))


def test_completeness_counts_key_columns(spark):
    df = spark.createDataFrame([(1, None, None, None), (2, 1.0, None, None)], "permno long, a double, b double, c double")
    assert panel.completeness_filter(df, 0.25).count() == 2
    assert [r["permno"] for r in panel.completeness_filter(df, 0.25, ["permno"], count_keys=False).collect()] == [2]
    kept = panel.kept_rows(df, 0.5).first()
    assert (kept["kept"], kept["total"], kept["dropped_share"]) == (1, 2, 0.5)


def test_sparse_columns_strictly_above(spark):
    df = spark.createDataFrame([(i, None if i else 1.0, None if i < 9 else 1.0, None) for i in range(10)], "id long, a double, b double, c double")
    assert panel.sparse_columns(df, 0.9) == ["c"]
    assert panel.drop_sparse(df, 0.5, fit_on=df.filter("id > 8")).columns == ["id", "b"]


def test_joins_validate_and_shift(spark):
    rets = spark.createDataFrame([(1, date(2010, 2, 28), 1.0), (2, date(2010, 2, 28), 2.0)], "permno long, date date, ret double")
    sigs = spark.createDataFrame([(1, date(2010, 2, 28), 9.0)], "permno long, date date, a double")
    assert [tuple(r) for r in panel.join_signals(rets, sigs).collect()] == [(1, date(2010, 2, 28), 1.0, 9.0)]
    with pytest.raises(Exception, match="duplicate key"):
        panel.join_signals(rets, sigs.unionByName(sigs)).collect()
    fac = spark.createDataFrame([(date(2010, m, 28), float(m)) for m in (1, 3)], "date date, RF double")
    assert {r["RF"] for r in panel.join_factors(rets, fac).collect()} == {1.0}
    assert {r["RF"] for r in panel.join_factors(rets, fac, -1).collect()} == {3.0}
    assert {r["RF"] for r in panel.join_factors(rets, fac, 0).collect()} == {None}
    with pytest.raises(ValueError, match="duplicate key"):
        panel.join_factors(rets, fac.unionByName(fac))


def test_merge_factors_tells_where_rows_come_from(spark):
    a = spark.createDataFrame([(date(2010, 1, 28), 1.0), (date(2010, 2, 28), 2.0)], "date date, SMB double")
    b = spark.createDataFrame([(date(2010, 2, 28), 3.0), (date(2010, 3, 28), 4.0)], "date date, Mom double")
    got = {r["date"].month: (r["SMB"], r["Mom"], r["_merge"]) for r in panel.merge_factors(a, b, provenance=True).collect()}
    assert got == {1: (1.0, None, "left_only"), 2: (2.0, 3.0, "both"), 3: (None, 4.0, "right_only")}
    assert "_merge" not in panel.merge_factors(a, b).columns


def test_sample_is_seeded_and_lasting(spark):
    rows = [(p, date(y, 6, 28)) for p in range(40) for y in (1985, 2021) if not (p % 4 == 0 and y == 2021)]
    df = spark.createDataFrame(rows, "permno long, date date")
    pick = lambda seed: [r[0] for r in panel.sample_entities(df, date(1990, 1, 1), date(2020, 1, 1), 10, seed).collect()]
    assert pick(1) == pick(1) and len(set(pick(1))) == 10 and pick(1) != pick(2)
    assert all(p % 4 for p in pick(3))
    assert panel.rows_of(df, panel.sample_entities(df, date(1990, 1, 1), date(2020, 1, 1), 10)).count() == 20


def test_periods(spark):
    df = spark.createDataFrame([("a", date(2010, 1, 28), 1.0), ("a", date(2010, 4, 28), 2.0), ("b", date(2010, 1, 28), 3.0)], "firm string, yyyymm date, s double")
    got = {(r["firm"], r["s"]): r["yyyymm"] for r in panel.relabel_next(df, "firm", "yyyymm").collect()}
    assert got == {("a", 1.0): date(2010, 4, 28), ("a", 2.0): None, ("b", 3.0): None}
    joined = panel.join_lagged(df.withColumnRenamed("s", "ret"), df, "firm", "yyyymm")
    assert {(r["ret"], r["s"]) for r in joined.collect()} == {(1.0, None), (2.0, 1.0), (3.0, None)}
    months = spark.createDataFrame([(date(2010, m, 28),) for m in range(1, 6)], "date date")
    labels = panel.timeline_labels(months, date(2010, 2, 28), date(2010, 4, 28)).orderBy("date")
    assert [r["set"] for r in labels.collect()] == ["Past", "Train", "Train", "Predict", "Future"]
    assert panel.training_window(months, date(2010, 4, 28)).count() == 3
    assert panel.training_window(months, date(2010, 4, 28), 2).count() == 2
    train, test = panel.temporal_split(months, date(2010, 3, 28))
    assert (train.count(), test.count()) == (3, 2)


def test_keep_first_prunes_before_the_shuffle(spark):
    df = spark.createDataFrame([(1, 3, "c"), (1, 1, "a"), (1, 2, "b"), (2, 5, "z")], "k int, o int, v string")
    kept = panel.keep_first(df, ["k"], ["o"])
    assert sorted(map(tuple, kept.collect())) == [(1, 1, "a"), (2, 5, "z")]
    assert "WindowGroupLimit" in kept._jdf.queryExecution().executedPlan().toString()


def test_member_flag(spark):
    df = spark.range(4).withColumnRenamed("id", "permno")
    members = spark.createDataFrame([(1,), (1,), (3,)], "permno long")
    assert [r["is_member"] for r in panel.member_flag(df, members, ["permno"]).orderBy("permno").collect()] == [False, True, False, True]


def test_columns(spark):
    df = spark.createDataFrame([(1, 2.0, float("nan"), None)], "a int, b double, c double, `d.e` double")
    assert columns.nan_to_null(df).first()["c"] is None
    assert columns.move_to_front(df, ["c", "a"]).columns == ["c", "a", "b", "d.e"]
    assert columns.columns_starting(df, "d") == ["d.e"] and columns.columns_after(df, 2) == ["c", "d.e"]
    assert columns.columns_containing(spark.createDataFrame([(1, 2)], "Lasso int, LassoCV int"), "Lasso") == ["Lasso", "LassoCV"]
    assert columns.scale_columns(df, keys=["a"], divide=100).first()["b"] == 0.02
    assert columns.narrow_floats(df).schema["b"].dataType.simpleString() == "float"
    clipped = spark.createDataFrame([(5.0,), (None,), (-5.0,)], "x double").select(columns.clip(F.col("x"), F.lit(-1.0), F.lit(1.0)))
    assert [r[0] for r in clipped.collect()] == [1.0, None, -1.0]
    assert spark.range(1).select(columns.ratio(F.lit(1), F.lit(0))).first()[0] is None
    labels = spark.range(1).select(dates.yyyymm_anchor(F.lit(201002)), dates.month_label(F.lit(date(2010, 2, 3)))).first()
    assert tuple(labels) == (date(2010, 2, 28), "2010-02")


def test_summary(spark):
    df = spark.createDataFrame([(1, 1.0, "u"), (2, 2.0, None), (3, 4.0, "v"), (4, None, "v")], "id long, x double, t string")
    got = {r["column"]: r for r in summary.describe_columns(df).collect()}
    assert (got["x"]["count"], got["x"]["q25"], got["x"]["q50"], got["x"]["q75"]) == (3, 1.5, 2.0, 3.0)
    assert got["id"]["mean"] == 2.5 and got["id"]["max"] == 4.0
    info = {r["column"]: (r["type"], r["present"]) for r in summary.column_info(df).collect()}
    assert info == {"id": ("bigint", 4), "x": ("double", 3), "t": ("string", 3)}
    names = spark.createDataFrame([("b",), ("Ridge",), ("a",), ("a",)], "model string")
    assert [r[0] for r in summary.model_names(names).collect()] == ["Ridge", "a", "b"]
    assert [r[0] for r in summary.default_models(names, 2).collect()] == ["Ridge", "a"]
