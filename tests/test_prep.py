from datetime import date

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from panelwise.prep import stages
from panelwise.prep.pipeline import build_preprocessor, column_routes, feature_names, fit_prepare, route_columns
from panelwise.prep.stages import CrossSectionalImputer, ModeImputer, OneHot, PopScaler, Winsorizer, one_hot_vector


def column(df, name, order="id"):
    return [r[name] for r in df.orderBy(order).collect()]


@pytest.fixture(scope="module")
def frame(spark):
    rows = [
        (0, date(2001, 1, 28), 1.0, None, None),
        (1, date(2001, 2, 28), None, None, None),
        (2, date(2001, 12, 28), 3.0, None, None),
        (3, date(2002, 1, 28), None, 8.0, None),
        (4, date(2002, 2, 28), None, None, None),
        (5, date(2003, 2, 28), 5.0, 2.0, None),
    ]
    return spark.createDataFrame(rows, "id long, date date, x double, y double, z double")


def test_imputer_fallbacks(frame):
    got = CrossSectionalImputer(inputCols=["x", "y", "z"]).transform(frame)
    assert got.columns == frame.columns
    assert column(got, "x") == [1.0, 2.0, 3.0, 3.0, 3.0, 5.0]  # 2002 has none: mean of all
    assert column(got, "y") == [5.0, 5.0, 5.0, 8.0, 8.0, 2.0]
    assert column(got, "z") == [0.0] * 6
    monthly = CrossSectionalImputer(inputCols=["x"], by="date").transform(frame)
    assert column(monthly, "x") == [1.0, 3.0, 3.0, 3.0, 3.0, 5.0]
    with pytest.raises(ValueError, match="no column"):
        CrossSectionalImputer(inputCols=["q"]).transform(frame)


@pytest.mark.parametrize("by", ["year", "date"])
def test_constants_and_join_fill_alike(frame, monkeypatch, by):
    ways = []
    for limit in (50_000, 0):
        monkeypatch.setattr(stages, "MAX_CONSTANTS", limit)
        ways.append(CrossSectionalImputer(inputCols=["x", "y", "z"], by=by).transform(frame).orderBy("id").collect())
    assert ways[0] == ways[1]
    daily = frame.withColumn("date", F.date_add("date", 1))
    assert CrossSectionalImputer(inputCols=["x"], by="date").transform(daily).filter("x is null").count() == 0


@pytest.mark.parametrize("exact", [True, False])
def test_winsorizer(spark, exact):
    values = [float(v) for v in range(1000)]
    df = spark.createDataFrame([(i, v) for i, v in enumerate(values)] + [(1000, None)], "id long, x double")
    model = Winsorizer(inputCols=["x"], lower=0.01, upper=0.9, exact=exact).fit(df)
    low, high = np.quantile(values, [0.01, 0.9])
    got = column(model.transform(df), "x")
    assert got[-1] is None and got[500] == 500.0
    assert got[0] == pytest.approx(low, abs=0 if exact else 1.5) and got[999] == pytest.approx(high, abs=1e-9 if exact else 1.5)


def test_scaler_uses_the_population_deviation(spark):
    df = spark.createDataFrame([(0, 1.0, 4.0), (1, 2.0, 4.0), (2, 6.0, 4.0), (3, None, 4.0)], "id long, x double, c double")
    got = PopScaler(inputCols=["x", "c"]).fit(df).transform(df)
    x = np.array([1.0, 2.0, 6.0])
    assert column(got, "x")[:3] == pytest.approx(((x - x.mean()) / x.std()).tolist())
    assert column(got, "x")[3] is None and column(got, "c") == [0.0] * 4


def test_modes_break_ties_by_value_not_by_text(spark):
    df = spark.createDataFrame([(0, 10.0, "b"), (1, 9.0, "a"), (2, 10.0, "b"), (3, 9.0, "a"), (4, None, None)], "id long, n double, s string")
    got = ModeImputer(inputCols=["n", "s"]).fit(df).transform(df)
    assert column(got, "n")[4] == 9.0 and column(got, "s")[4] == "a"


def test_one_hot_ignores_the_unseen(spark):
    df = spark.createDataFrame([(0, 10.0, "x"), (1, 9.0, "y"), (2, 9.5, "x")], "id long, n double, s string")
    model = OneHot(inputCols=["n", "s"]).fit(df)
    assert model.output_columns() == ["n_9", "n_9_5", "n_10", "s_x", "s_y"]
    new = spark.createDataFrame([(0, 7.0, "y"), (1, 10.0, "?"), (2, None, None)], "id long, n double, s string")
    got = model.transform(new)
    assert [[r[c] for c in model.output_columns()] for r in got.orderBy("id").collect()] == [[0, 0, 0, 0, 1], [0, 0, 1, 0, 0], [0, 0, 0, 0, 0]]


def test_routes_follow_the_documentation(spark):
    df = spark.createDataFrame([(1, 1.0, 2.0, 3.0, 4.0, 5.0)], "permno long, ret double, a double, sinAlgo double, SMB double, k double")
    doc = spark.createDataFrame([("a", "continuous"), ("k", "discrete"), ("sinAlgo", "discrete"), ("gone", "continuous"), ("permno", "other")], "Acronym string, `Cat.Form` string")
    assert route_columns(df, doc) == (["a", "SMB"], ["k"])


def test_pipeline_learns_from_training_only_and_survives_saving(spark, frame, tmp_path):
    train = frame.withColumn("k", F.when(F.col("id") < 3, "p").otherwise("q"))
    fitted, prepared = fit_prepare(build_preprocessor(["x", "y"], ["k"]), train)
    names = feature_names(fitted)
    assert names == ["x", "y", "k_p", "k_q"]
    assert {tuple(r) for r in column_routes(fitted).collect()} == {("numbers", "x"), ("numbers", "y"), ("categoricals", "k")}
    again = fitted.transform(train).orderBy("id").select(names).collect()
    assert again == prepared.orderBy("id").select(names).collect()
    path = str(tmp_path / "pre")
    fitted.write().save(path)
    loaded = PipelineModel.load(path)
    assert loaded.transform(train).orderBy("id").select(names).collect() == again
    later = train.withColumn("x", F.col("x") * 100).withColumn("k", F.lit("new"))
    out = fitted.transform(later).select(names).collect()
    assert all(r["k_p"] == r["k_q"] == 0 for r in out)


def test_one_hot_vector_of_many_levels(spark):
    """20 000 levels; unseen and missing ones give zeros."""
    train = spark.range(20_000).select(F.format_string("v%05d", "id").alias("a"), F.lit("x").alias("b"))
    model = one_hot_vector(["a", "b"], "hot").fit(train)
    rows = spark.createDataFrame([("v00007", "x"), ("v19999", None), ("new", "y")], "a string, b string")
    got = [(r["hot"].size, sorted(r["hot"].indices.tolist())) for r in model.transform(rows).collect()]
    assert got == [(20_001, [7, 20_000]), (20_001, [19_999]), (20_001, [])]
