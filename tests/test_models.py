from datetime import date

import numpy as np
import pytest
from pyspark.ml import PipelineModel
from pyspark.sql import functions as F

from panelwise.models.gram import Moments, entity_folds, moments_by_fold, row_order_folds
from panelwise.models.interpret import importances
from panelwise.models.linear import LinearFit, choose_lasso, lasso_alphas, solve_lasso, sum_moments
from panelwise.models.network import NetworkRegressor, batch_of, forward, gradient, layer_slices, start_weights
from panelwise.models.registry import build_model, default_variants, expand_grid

NAMES = ["a", "b", "c", "d"]


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(3)
    n = 403
    x = rng.normal(size=(n, 4))
    x[:, 3] = x[:, 0] + 0.1 * x[:, 3]
    y = 1.5 + x @ np.array([1.0, -2.0, 0.0, 0.5]) + rng.normal(size=n)
    months = [date(2000 + (i % 40) // 12, (i % 40) % 12 + 1, 28) for i in range(n)]
    rows = [(i // 40, months[i], *map(float, x[i]), float(y[i])) for i in range(n)]
    df = spark.createDataFrame(rows, "permno long, date date, a double, b double, c double, d double, ret double").repartition(3)
    return df, x, y


def weights(model):
    return np.array(model.getOrDefault("coefficients")), model.getOrDefault("intercept")


def test_moments_are_the_cross_products(data):
    df, x, y = data
    m = moments_by_fold(df, NAMES, "ret")[0]
    z = np.column_stack([np.ones(len(y)), x, y])
    assert np.allclose(m.z, z.T @ z, atol=1e-9)
    assert m.squared_error(np.zeros(4), 0.0) == pytest.approx(float(y @ y))


def test_ols_and_ridge_closed_forms(data):
    df, x, y = data
    xc, yc = x - x.mean(0), y - y.mean()
    coef, icpt = weights(LinearFit(inputCols=NAMES).fit(df))
    assert np.allclose(coef, np.linalg.lstsq(xc, yc, rcond=None)[0], atol=1e-9)
    assert icpt == pytest.approx(y.mean() - x.mean(0) @ coef)
    coef, _ = weights(LinearFit(inputCols=NAMES, kind="ridge", alpha=3.0).fit(df))
    assert np.allclose(coef, np.linalg.solve(xc.T @ xc + 3 * np.eye(4), xc.T @ yc), atol=1e-9)


def test_ols_predictions_with_a_redundant_column(data):
    df, x, y = data
    twice = df.withColumn("e", F.col("a") + F.col("b"))
    got = LinearFit(inputCols=[*NAMES, "e"]).fit(twice).transform(twice)
    plain = LinearFit(inputCols=NAMES).fit(df).transform(df)
    a = [r[0] for r in got.orderBy("permno", "date").select("prediction").collect()]
    b = [r[0] for r in plain.orderBy("permno", "date").select("prediction").collect()]
    assert np.allclose(a, b, atol=1e-8)


@pytest.mark.parametrize("alpha", [0.01, 0.3, 100.0])
def test_lasso_meets_the_optimality_conditions(data, alpha):
    df, x, y = data
    coef, icpt = weights(LinearFit(inputCols=NAMES, kind="lasso", alpha=alpha).fit(df))
    slope = x.T @ (y - x @ coef - icpt) / len(y)
    for s, c in zip(slope, coef):
        assert abs(s) <= alpha + 1e-8
        if c:
            assert s == pytest.approx(alpha * np.sign(c), abs=1e-8)
    if alpha == 100.0:
        assert not coef.any() and icpt == pytest.approx(y.mean())


def test_ridge_cv_equals_refitting_without_each_row(data):
    df, x, y = data
    errors = []
    for alpha in (0.1, 1.0, 10.0):
        total = 0.0
        for i in range(len(y)):
            keep = np.arange(len(y)) != i
            xc, yc = x[keep] - x[keep].mean(0), y[keep] - y[keep].mean()
            w = np.linalg.solve(xc.T @ xc + alpha * np.eye(4), xc.T @ yc)
            total += (y[i] - y[keep].mean() - (x[i] - x[keep].mean(0)) @ w) ** 2
        errors.append(total)
    model = LinearFit(inputCols=NAMES, kind="ridge_cv").fit(df)
    assert model.getOrDefault("alpha") == (0.1, 1.0, 10.0)[int(np.argmin(errors))]


def test_folds_are_contiguous_blocks(data):
    df, _, y = data
    fold = row_order_folds(df, 5)
    got = [r[0] for r in df.select("permno", "date", fold.alias("f")).orderBy("permno", "date").select("f").collect()]
    assert got == [f for f, size in enumerate([81, 81, 81, 80, 80]) for _ in range(size)]
    per = df.select("permno", entity_folds(5).alias("f")).distinct()
    assert per.count() == df.select("permno").distinct().count()


def test_lasso_cv_by_brute_force(data):
    df, x, y = data
    folds = moments_by_fold(df, NAMES, "ret", row_order_folds(df, 5))
    every = sum_moments(folds)
    grid = lasso_alphas(every, 50)
    xc, yc = x - x.mean(0), y - y.mean()
    assert grid[0] == pytest.approx(np.abs(xc.T @ yc).max() / len(y)) and grid[-1] == pytest.approx(grid[0] * 1e-3)
    order = np.arange(len(y))  # rows were made in (permno, date) order
    blocks = np.array_split(order, 5)
    errors = np.zeros(50)
    for block in blocks:
        train = np.setdiff1d(order, block)
        for i, alpha in enumerate(grid):
            xt, yt = x[train] - x[train].mean(0), y[train] - y[train].mean()
            w = np.zeros(4)
            for _ in range(2000):
                for j in range(4):
                    r = yt - xt @ w + xt[:, j] * w[j]
                    p = xt[:, j] @ r / len(train)
                    w[j] = np.sign(p) * max(abs(p) - alpha, 0) / (xt[:, j] @ xt[:, j] / len(train))
                if _ > 50 and _ % 50 == 0:
                    break
            errors[i] += np.mean((y[block] - y[train].mean() - (x[block] - x[train].mean(0)) @ w) ** 2)
    assert choose_lasso(folds, 50, df.sparkSession) == pytest.approx(grid[int(np.argmin(errors))])
    model = LinearFit(inputCols=NAMES, kind="lasso_cv").fit(df)
    assert np.allclose(weights(model)[0], solve_lasso(every, choose_lasso(folds, 50, df.sparkSession)))


def test_no_signal_gives_the_mean(spark):
    df = spark.createDataFrame([(1, date(2000, m, 28), 0.0, 2.0) for m in range(1, 11)], "permno long, date date, a double, ret double")
    for kind in ("ols", "lasso", "ridge", "lasso_cv"):
        got = LinearFit(inputCols=["a"], kind=kind).fit(df).transform(df).first()
        assert got["prediction"] == pytest.approx(2.0)


def test_network_gradient_by_differences():
    rng = np.random.default_rng(0)
    sizes = [3, 5, 2, 1]
    flat, x, y = start_weights(sizes, 1), rng.normal(size=(7, 3)), rng.normal(size=7)

    def loss(w):
        penalty = sum((w[s] ** 2).sum() for s, _, _, _ in layer_slices(sizes))
        return ((forward(w, sizes, x)[-1][:, 0] - y) ** 2).mean() / 2 + 0.01 * penalty / 2 / len(y)

    g = gradient(flat, sizes, x, y, 0.01)
    for i in range(0, len(flat), 3):
        step = np.zeros_like(flat)
        step[i] = 1e-6
        assert g[i] == pytest.approx((loss(flat + step) - loss(flat - step)) / 2e-6, abs=1e-6)


def test_network_and_trees_beat_the_mean(spark):
    rng = np.random.default_rng(1)
    x = rng.uniform(-2, 2, size=(3000, 2))
    y = np.abs(x[:, 0]) * 2 + x[:, 1] + rng.normal(size=3000) * 0.1
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, ret double")
    for name, params in (("mlp", {"hidden": [16, 8], "maxIter": 30, "batchSize": 64}), ("hgbr", {"maxIter": 10, "maxDepth": 3})):
        scored = build_model(name, ["a", "b"], **params).fit(df).transform(df)
        mse = scored.agg(F.avg((F.col("prediction") - F.col("ret")) ** 2)).first()[0]
        assert 1 - mse / y.var() > 0.7, name


def test_trees_stop_when_held_out_rows_gain_nothing(spark, tmp_path):
    rng = np.random.default_rng(4)
    df = spark.createDataFrame([tuple(map(float, r)) for r in rng.normal(size=(1500, 3))], "a double, b double, ret double")
    model = build_model("hgbr", ["a", "b"], validation=0.2, maxIter=12, maxDepth=4).fit(df)
    assert model.stages[-1].getNumTrees < 12
    assert {r["feature"] for r in importances(model).collect()} == {"a", "b"}
    model.write().save(str(tmp_path / "trees"))
    again = PipelineModel.load(str(tmp_path / "trees"))
    assert again.transform(df).agg(F.sum("prediction")).first() == model.transform(df).agg(F.sum("prediction")).first()


def test_network_repeats_itself(data):
    df, _, _ = data
    fits = [NetworkRegressor(inputCols=NAMES, hidden=[4], maxIter=2).fit(df).getOrDefault("weights") for _ in range(2)]
    assert fits[0] == fits[1]


def test_grids_and_names():
    assert [v for v, _ in expand_grid("mlp")] == ["mlp-64-32", "mlp-32-16-8", "mlp-128-64-32"]
    assert expand_grid("Ridge") == [("Ridge", {})]
    assert len(default_variants()) == 9
    with pytest.raises(ValueError, match="same name"):
        expand_grid("Ridge", {"alpha": [1.0, 2.0]})


def test_network_does_not_depend_on_the_cluster(data):
    """The same weights, however the rows are dealt out when they come."""
    df, *_ = data
    fits = [NetworkRegressor(inputCols=NAMES, hidden=[4], maxIter=2, shardRows=50).fit(df.repartition(n)).getOrDefault("weights") for n in (2, 8)]
    assert np.allclose(*fits, rtol=0, atol=1e-12)


def plain_adam(rows, sizes, seed, epochs, batches, rate, penalty):
    """Minibatch Adam in plain numpy; ``rows`` has (batch per epoch..., x..., y)."""
    w = start_weights(sizes, seed)
    first, second, step = np.zeros_like(w), np.zeros_like(w), 0
    for e in range(epochs):
        for b in range(batches):
            own = rows[rows[:, e] == b]
            if len(own):
                step += 1
                g = gradient(w, sizes, own[:, epochs:-1], own[:, -1], penalty)
                first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
                w = w - rate * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    return w


def test_synchronous_steps_are_plain_minibatch_adam(data):
    """The same weights for 1, 2 and 8 tasks and for plain numpy."""
    df, x, y = data
    epochs, batches = 2, 3  # 403 rows in batches of about 150
    fits = [NetworkRegressor(inputCols=NAMES, hidden=[6, 3], maxIter=epochs, batchSize=150, validation=0.0, mode="synchronous", tasks=n).fit(df.repartition(n)).getOrDefault("weights") for n in (1, 2, 8)]
    named = df.select(*[F.col(c).alias(f"_x{i}") for i, c in enumerate(NAMES)], F.col("ret").alias("_y"))
    place = F.xxhash64(F.lit(1), F.xxhash64(F.lit(42), *named.columns))
    dealt = named.select(*[batch_of(place, 42 + e, batches).cast("double").alias(f"b{e}") for e in range(epochs)], *named.columns)
    want = plain_adam(np.array(dealt.collect()), [4, 6, 3, 1], 42, epochs, batches, 0.01, 0.001)
    for got in fits:
        assert np.allclose(got, want, rtol=0, atol=1e-9)


def test_synchronous_training_stops_and_learns(spark):
    rng = np.random.default_rng(1)
    x = rng.uniform(-2, 2, size=(1500, 2))
    y = np.abs(x[:, 0]) * 2 + x[:, 1] + rng.normal(size=1500) * 0.1
    df = spark.createDataFrame([(*map(float, r), float(t)) for r, t in zip(x, y)], "a double, b double, ret double")
    model = NetworkRegressor(inputCols=["a", "b"], hidden=[16], maxIter=12, batchSize=50, learningRate=0.03, mode="synchronous", tasks=1).fit(df)
    mse = model.transform(df).agg(F.avg((F.col("prediction") - F.col("ret")) ** 2)).first()[0]
    assert 1 - mse / y.var() > 0.8
    with pytest.raises(ValueError, match="mode"):
        NetworkRegressor(inputCols=["a"], mode="other")


def test_folds_of_large_ids(spark):
    """Ids that a double cannot tell apart."""
    rows = [(10**17 + i // 5, f"2000-{i % 5 + 1:02d}-28", float(i)) for i in range(50)]
    df = spark.createDataFrame(rows, "permno long, date string, x double").withColumn("date", F.col("date").cast("date"))
    folds = df.select("x", row_order_folds(df, 5).alias("fold")).collect()
    assert {r["x"]: r["fold"] for r in folds} == {float(i): i // 10 for i in range(50)}


def test_an_empty_fold_is_an_error(spark):
    m = Moments(np.eye(3) * 10)
    with pytest.raises(ValueError, match="no rows"):
        choose_lasso({0: m}, 5, spark)


def test_lasso_on_more_features_than_a_matrix_holds(spark, monkeypatch):
    """1000 features, a few of which matter: the coefficients of coordinate descent on all."""
    import pandas as pd

    from panelwise.models import gram, screened

    rng = np.random.default_rng(21)
    x = rng.normal(size=(250, 1000))
    x[:, 1] = x[:, 0] + 0.05 * x[:, 1]
    y = 2.0 + x[:, [0, 17, 800]] @ [1.5, -2.0, 1.0] + rng.normal(size=250) * 0.5
    names = [f"f{i}" for i in range(1000)]
    df = spark.createDataFrame(pd.DataFrame(np.column_stack([x, y]), columns=[*names, "ret"])).repartition(3)
    monkeypatch.setattr(screened, "ROUND", 40)
    monkeypatch.setattr(gram, "MAX_MATRIX_BYTES", 500 * 500 * 8)
    for alpha in (0.25, 0.6):
        z = np.column_stack([np.ones(250), x, y])
        m = Moments(z.T @ z)
        want = solve_lasso(m, alpha)
        coef, icpt = weights(LinearFit(inputCols=names, kind="lasso", alpha=alpha).fit(df))
        assert np.allclose(coef, want, atol=1e-6) and icpt == pytest.approx(m.intercept(want), abs=1e-6)
        assert 3 <= np.count_nonzero(coef) < 200
    with pytest.raises(ValueError, match="cross products exceed"):
        LinearFit(inputCols=names, kind="ridge").fit(df)


def test_wide_panels_walk_forward_by_the_lasso(spark, monkeypatch):
    """With a small bound on matrices the walk-forward run goes the screened way: the same predictions."""
    from panelwise.models import gram, walk_forward as wf

    rng = np.random.default_rng(5)
    rows = [(p, date(2000 + y, m, 28), *map(float, v), float(v[0] - v[2] + rng.normal() * 0.1)) for y in range(3) for m in range(1, 13) for p in range(5) for v in [rng.normal(size=6)]]
    names = [f"f{i}" for i in range(6)]
    panel = spark.createDataFrame(rows, "permno long, date date, " + ", ".join(f"{c} double" for c in names) + ", ret double")
    run = lambda: {(r["permno"], r["date"]): r["pred"] for r in wf.walk_forward(panel, names, (), [2002], [("Lasso", "Lasso", {"alpha": 0.1})]).collect()}
    plain = run()
    monkeypatch.setattr(gram, "MAX_MATRIX_BYTES", 7 * 7 * 8)
    wide = run()
    assert plain.keys() == wide.keys() and all(plain[k] == pytest.approx(wide[k], abs=1e-8) for k in plain)


def test_network_rows_are_cached_as_blocks(spark):
    """Epochs read matrices: the same weights as plain minibatch Adam over the batches that Spark hands to a task."""
    rng = np.random.default_rng(4)
    x = rng.normal(size=(700, 3))
    rows = [(*map(float, r), float(r.sum())) for r in x]
    df = spark.createDataFrame(rows, "a double, b double, c double, ret double").repartition(3)
    seen = []

    class Watched(NetworkRegressor):
        def _train(self, rows, sizes):
            seen.append((rows.columns, [np.frombuffer(r[0]).reshape(-1, 5) for r in rows.collect()]))
            return super()._train(rows, sizes)

    settings = {"inputCols": ["a", "b", "c"], "hidden": [4], "maxIter": 2, "batchSize": 100, "validation": 0.0}
    old = spark.conf.get("spark.sql.execution.arrow.maxRecordsPerBatch")
    spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", "300")
    try:
        got = Watched(**settings).fit(df).getOrDefault("weights")
    finally:
        spark.conf.set("spark.sql.execution.arrow.maxRecordsPerBatch", old)
    columns, blocks = seen[0]
    assert columns == ["rows"] and [len(b) for b in blocks] == [300, 300, 100]
    w = start_weights([3, 4, 1], 42)
    first, second, step = np.zeros_like(w), np.zeros_like(w), 0
    for epoch in range(2):
        draw = np.random.default_rng(42 + epoch)
        for block in blocks:
            table = draw.permutation(block[:, :-1])
            for at in range(0, len(table), 100):
                g = gradient(w, [3, 4, 1], table[at : at + 100, :-1], table[at : at + 100, -1], 0.001)
                step += 1
                first, second = 0.9 * first + 0.1 * g, 0.999 * second + 0.001 * g * g
                w = w - 0.01 * (first / (1 - 0.9**step)) / (np.sqrt(second / (1 - 0.999**step)) + 1e-8)
    assert np.allclose(got, w, atol=1e-9)
