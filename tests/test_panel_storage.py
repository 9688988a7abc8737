"""Counts by the way, tables stored by entity, remembered results, sketches of distinct entities."""

import os
from datetime import date

import pytest
from pyspark.sql import functions as F

from panelwise import runtime
from panelwise.operators import panel, portfolio, summary
from panelwise.sources import bucketed


@pytest.fixture(scope="module")
def sides(spark):
    rows = spark.range(600).select((F.col("id") % 50).alias("permno"), F.expr("make_date(2000 + cast(id div 600 as int), 1 + cast(id div 50 as int), 28)").alias("date"), (F.col("id") * 1.0).alias("ret"))
    signals = rows.filter("permno < 40").select("permno", F.add_months("date", 1).alias("date"), (F.col("ret") * 2).alias("sig"))
    return rows, signals


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_counts_cost_no_exchange(sides, spark):
    rows, signals = sides
    plain = panel.join_signals(rows, signals)
    joined, counts = panel.counted_join(rows, signals, panel.join_signals)
    assert plan(joined).count("Exchange") == plan(plain).count("Exchange")
    assert joined.count() == plain.count()
    want = {r["side"]: r["rows"] for r in panel.join_row_counts(rows, signals, ["permno", "date"]).collect()}
    assert counts.get() == want and {r["side"]: r["rows"] for r in counts.table(spark).collect()} == want


def test_stored_by_entity_nothing_is_shuffled(sides, spark):
    rows, signals = sides
    bucketed.entity_joins(spark)
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a, b = bucketed.write_bucketed(rows, "by_entity_a", 4), bucketed.write_bucketed(signals, "by_entity_b", 4)
        joined = panel.join_signals(a, b)
        assert "Exchange" not in plan(joined) and "Exchange" in plan(panel.join_signals(rows, signals))
        assert sorted(map(tuple, joined.collect())) == sorted(map(tuple, panel.join_signals(rows, signals).collect()))
        lagged = portfolio.previous_in_entity(a, ["permno"], "date", "ret", "before", calendar=True)
        assert "Exchange" not in plan(lagged)
        assert sorted(map(tuple, lagged.collect()), key=str) == sorted(map(tuple, portfolio.previous_in_entity(rows, ["permno"], "date", "ret", "before", calendar=True).collect()), key=str)
        relabelled = panel.relabel_next(a, "permno", "date")
        assert "Exchange" not in plan(relabelled)
    finally:
        spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)
        where = spark.sql("describe formatted by_entity_a").filter("col_name = 'Location'").first()["data_type"].removeprefix("file:")
        assert len([f for f in os.listdir(where) if f.startswith("part-")]) == 4
        bucketed.drop_bucketed(spark, "by_entity_a")
        bucketed.drop_bucketed(spark, "by_entity_b")
    assert not os.path.exists(where)


def test_memo(spark, tmp_path):
    path = str(tmp_path / "t")
    spark.range(10).write.parquet(path)
    memo = runtime.Memo()
    ask = lambda: spark.read.schema("id long").parquet(path).filter("id > 3").agg(F.sum("id").alias("s"))
    first = memo.get(ask())

    def jobs(work):
        sc = spark.sparkContext
        sc.setJobGroup("memo", "memo")
        try:
            before = len(sc.statusTracker().getJobIdsForGroup("memo"))
            return work(), len(sc.statusTracker().getJobIdsForGroup("memo")) - before
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)

    second, n = jobs(lambda: memo.get(ask()))
    assert second is first and n == 0 and first.first()["s"] == 39
    other = memo.get(ask().select((F.col("s") + 1).alias("s")))
    assert other is not first and other.first()["s"] == 40
    spark.range(20).write.mode("overwrite").parquet(path)
    changed, n = jobs(lambda: memo.get(ask()))
    assert n > 0 and changed.first()["s"] == 184
    staged = first._staged_at.removeprefix("file:")
    memo.release(first)
    assert os.path.exists(staged)
    memo.release(second)
    assert not os.path.exists(staged)
    memo.release(changed)
    memo.release(other)
    assert memo.entries == []
    plain = spark.range(3)
    assert memo.get(plain) is plain and memo.entries == []


def test_sketches_answer_for_any_range(sides):
    rows, _ = sides
    sketches = runtime.stage_table(summary.entity_sketches(rows.filter("permno <> 7 or month(date) <> 3"), F.col("date"), "date"))
    for key, name in ((F.year("date"), "year"), (F.quarter("date"), "quarter"), (F.col("date"), "date")):
        about = {r[0]: r[1] for r in summary.entities_from_sketches(sketches, key, name).collect()}
        exact = {r[0]: r[1] for r in summary.entities_per(rows.filter("permno <> 7 or month(date) <> 3"), key, name).collect()}
        assert about.keys() == exact.keys() and all(abs(about[k] - exact[k]) <= summary.HLL_ERROR * exact[k] for k in exact)


def test_describe_both_ways(spark):
    rows = [(float(i % 7) if i % 5 else None, float(i) ** 2, None, "x") for i in range(100)]
    df = spark.createDataFrame(rows, "a double, b double, c double, s string")
    one = sorted(map(tuple, summary.describe_columns(df).collect()))
    two = sorted(map(tuple, summary.describe_columns(df, direct_rows=0).collect()))
    for x, y in zip(one, two):
        assert x[0] == y[0] and x[1] == y[1]
        assert x[2:] == pytest.approx(y[2:]) if x[1] else x[2:] == y[2:] == (None,) * 7
    assert [r[0] for r in one] == ["a", "b", "c"]
    single = summary.describe_columns(spark.createDataFrame([(date(2000, 1, 1), 5)], "d date, n int")).first()
    assert tuple(single) == ("n", 1, 5.0, None, 5.0, 5.0, 5.0, 5.0, 5.0)
