"""Models with eliminated levels against the full one-hot design."""

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from panelwise.models import walk_forward as wf
from panelwise.models.levels import LevelFit, level_sums
from panelwise.runtime import MAX_BROADCAST_BYTES


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(6)
    n = 400
    x = rng.normal(size=(n, 2))
    level = rng.integers(0, 60, n) ** 2 // 60  # some hold many rows, some one
    missing = rng.random(n) < 0.05
    y = x @ [1.0, -2.0] + level / 10 + rng.normal(size=n) * 0.3
    rows = [(i, *map(float, x[i]), None if missing[i] else f"k{level[i]}", float(y[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "id long, a double, b double, k string, ret double").repartition(4)
    names = sorted({f"k{v}" for v in level[~missing]})
    hot = np.array([[float(not m and f"k{v}" == c) for c in names] for v, m in zip(level, missing)])
    return df, np.column_stack([np.ones(n), x, hot]), y


def scores(model, df):
    return np.array([r["prediction"] for r in model.transform(df).orderBy("id").select("prediction").collect()])


def full(z, y, alpha):
    penalty = alpha * np.diag([0.0, *[1.0] * (z.shape[1] - 1)])
    return np.linalg.pinv(z.T @ z + penalty, rcond=1e-12) @ z.T @ y


@pytest.mark.parametrize("alpha", [0.3, 5.0])
def test_ridge_equals_the_full_design(data, alpha):
    df, z, y = data
    model = LevelFit(inputCols=["a", "b"], levelCol="k", alpha=alpha).fit(df)
    theta = full(z, y, alpha)
    assert model.getOrDefault("intercept") == pytest.approx(theta[0], abs=1e-9)
    assert np.allclose(model.getOrDefault("coefficients"), theta[1:3], atol=1e-9)
    assert np.allclose(scores(model, df), z @ theta, atol=1e-9)


def test_ols_predictions(data):
    df, z, y = data
    model = LevelFit(inputCols=["a", "b"], levelCol="k", kind="ols").fit(df)
    assert np.allclose(scores(model, df), z @ full(z, y, 0.0), atol=1e-7)


def test_ridge_cv_equals_refitting_without_each_row(data):
    df, z, y = data
    alphas = [0.05, 0.5, 5.0, 50.0]
    errors = [np.mean([(y[i] - z[i] @ full(np.delete(z, i, 0), np.delete(y, i), a)) ** 2 for i in range(len(y))]) for a in alphas]
    model = LevelFit(inputCols=["a", "b"], levelCol="k", kind="ridge_cv", alphas=alphas).fit(df)
    assert model.getOrDefault("alpha") == alphas[int(np.argmin(errors))]


def test_unseen_levels_saving_and_shuffled_lookups(data, spark, tmp_path, monkeypatch):
    df, _, _ = data
    model = LevelFit(inputCols=["a", "b"], levelCol="k").fit(df)
    new = spark.createDataFrame([(0, 0.0, 0.0, "new"), (1, 0.0, 0.0, None), (2, 1.0, 0.0, "new")], "id long, a double, b double, k string")
    got = scores(model, new)
    assert got[0] == got[1] == pytest.approx(model.getOrDefault("intercept")) and got[2] - got[0] == pytest.approx(model.getOrDefault("coefficients")[0])
    path = str(tmp_path / "m")
    PipelineModel(stages=[model]).write().save(path)
    assert np.array_equal(scores(PipelineModel.load(path), df), scores(model, df))
    monkeypatch.setattr("panelwise.runtime.MAX_BROADCAST_BYTES", 1)
    assert np.allclose(scores(model, df), scores(LevelFit(inputCols=["a", "b"], levelCol="k").fit(df), df)) and MAX_BROADCAST_BYTES > 1


def test_many_levels_walk_forward(spark):
    """20 000 levels: more than a column each is allowed."""
    rows = spark.range(60_000).select((F.col("id") % 20_000).alias("permno"), F.expr("make_date(2000 + cast(id div 20000 as int), 1 + cast(id % 12 as int), 28)").alias("date"), (F.col("id") % 7).cast("double").alias("a"))
    panel = rows.withColumn("k", F.concat(F.lit("k"), "permno")).withColumn("ret", F.col("a") + F.col("permno") / 1000)
    got = wf.walk_forward(panel, ["a"], (), [2002], [("Ridge", "Ridge", {"alpha": 1e-6}), ("OLS", "OLS", {})], level="k")
    off = got.groupBy("model").agg(F.max(F.abs(F.col("pred") - F.col("ret"))).alias("off"), F.count(F.lit(1)).alias("n")).collect()
    assert {r["model"]: r["n"] for r in off} == {"Ridge": 20_000, "OLS": 20_000} and all(r["off"] < 1e-3 for r in off)
    with pytest.raises(ValueError, match="lasso"):
        wf.walk_forward(panel, ["a"], (), [2002], [("Lasso", "Lasso", {})], level="k")


def test_sums_of_levels_are_plain_numbers(spark):
    """No level has an aggregate object of its own: with as many levels as rows these made up most of a fit."""
    rows = [(float(i), 2.0 * i, f"l{i % 7}") for i in range(50)] + [(1.0, 1.0, None)]
    sums = level_sums(spark.createDataFrame(rows, "x double, ret double, level string"), ["x"], "ret", "level")
    assert "ObjectHashAggregate" not in sums._jdf.queryExecution().toString()
    want = {f"l{k}": [len(own), sum(own), 2 * sum(own)] for k in range(7) for own in [range(k, 50, 7)]}
    assert {r.level: r.u for r in sums.collect()} == want
