import pytest
from pyspark.sql import functions as F

from panelwise import runtime


@pytest.fixture(scope="module")
def sides(spark):
    big = spark.range(3000).withColumn("k", F.when(F.col("id") % 3 == 0, F.lit(0)).otherwise(F.col("id") % 7)).withColumn("x", F.col("id") * 2)
    small = spark.createDataFrame([(k, f"v{k}") for k in range(5)], "k long, v string")
    return big, small


@pytest.mark.parametrize("how", ["left", "inner", "left_semi", "left_anti"])
def test_the_shuffled_way_gives_what_the_broadcast_gives(sides, how):
    big, small = sides
    plain = big.join(small, ["k"], how)
    for bound in (None, 1):
        got = runtime.lookup_join(big, small, ["k"], how, bound)
        assert sorted(map(tuple, got.select(*plain.columns).collect()), key=str) == sorted(map(tuple, plain.collect()), key=str)
    shuffled = runtime.lookup_join(big, small, ["k"], how, 1)._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in shuffled or "Relation" in runtime.lookup_join(big, small, ["k"], how, 1)._jdf.queryExecution().analyzed().toString()


def test_only_left_keeping_joins(sides):
    with pytest.raises(ValueError, match="left side"):
        runtime.lookup_join(*sides, ["k"], "full_outer")


def test_pocket_checks_the_size(sides):
    big, small = sides
    table, fits = runtime.pocket(small)
    assert fits and table.count() == 5
    table, fits = runtime.pocket(big, max_bytes=1000)
    assert not fits and table.count() == 3000


def test_long_texts_are_measured(spark):
    """Few rows, but many bytes: the estimate lets them pass, their size does not."""
    texts = spark.range(20).select(F.repeat(F.lit("x"), 100_000).alias("t"))
    assert not runtime.pocket(texts, max_bytes=100_000)[1]
    assert runtime.pocket(texts, max_bytes=4_000_000)[1]


def test_guard_unique_fails_on_a_repeated_key(spark):
    rows = spark.createDataFrame([(1, 1), (1, 2), (1, 1)], "a int, b int")
    assert runtime.guard_unique(rows.distinct(), ["a", "b"], "rows").count() == 2
    with pytest.raises(Exception, match="duplicate key"):
        runtime.guard_unique(rows, ["a", "b"], "rows").collect()
    assert [tuple(r) for r in runtime.key_duplicates(rows, ["a", "b"]).collect()] == [(1, 1, 2)]


def test_staged_tables_keep_their_rows(sides):
    big, _ = sides
    staged = runtime.stage_table(big, "k")
    assert staged.count() == 3000 and staged.filter("k = 0").count() == big.filter("k = 0").count()
    assert runtime.stage_table(big).agg(F.sum("x")).first()[0] == big.agg(F.sum("x")).first()[0]
    assert runtime.stage_table(big.filter("id < 0")).columns == big.columns


def test_guards_add_no_shuffle(spark):
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        a = spark.range(100).select(F.col("id").alias("k"), F.lit(1).alias("x"))
        b = spark.range(100).select(F.col("id").alias("k"), F.lit(2).alias("y"))
        joined = runtime.guard_unique(a, ["k"], "a").join(runtime.guard_unique(b, ["k"], "b"), ["k"])
        plan = joined._jdf.queryExecution().executedPlan().toString()
        assert plan.count("Exchange") == 2
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")


def test_staged_tables_can_be_dropped(spark):
    staged = runtime.stage_table(spark.range(10))
    path = staged._staged_at
    assert staged.count() == 10 and runtime.shared_folder(spark) in path
    runtime.drop_staged(staged)
    with pytest.raises(Exception, match="PATH_NOT_FOUND|does not exist"):
        spark.read.parquet(path)
