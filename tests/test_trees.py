"""Leaf-wise trees against growing one leaf at a time on plain arrays."""

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwise.models import trees as T
from panelwise.models.trees import LeafwiseModel, LeafwiseTrees

NAMES = ["a", "b", "c", "k"]


def plain_fit(x, y, rounds, rate, leaves, least):
    """Boosted trees by trying every split of every leaf on the values themselves."""
    f = np.full(len(y), y.mean())
    grown = []
    for _ in range(rounds):
        g, groups, splits = f - y, {0: np.arange(len(y))}, []
        while len(groups) < leaves:
            best = None
            for leaf in sorted(groups):
                rows = groups[leaf]
                for j in range(x.shape[1]):
                    own, gap = x[rows, j], np.isnan(x[rows, j])
                    for v in np.unique(own[~gap]):
                        for left_gap in (False, True):
                            left = np.where(gap, left_gap, own <= v)
                            if left.sum() < least or (~left).sum() < least or (left_gap and not gap.any()):
                                continue
                            gain = g[rows[left]].sum() ** 2 / left.sum() + g[rows[~left]].sum() ** 2 / (~left).sum() - g[rows].sum() ** 2 / len(rows)
                            if gain > 1e-9 * g[rows].sum() ** 2 / len(rows) and gain > 0 and (best is None or gain > best[0] * (1 + 1e-9)):
                                best = gain, leaf, rows[left], rows[~left]
            if best is None:
                break
            _, leaf, one, two = best
            del groups[leaf]
            groups[2 * len(splits) + 1], groups[2 * len(splits) + 2] = one, two
            splits.append(leaf)
        for rows in groups.values():
            f[rows] -= rate * g[rows].mean()
        grown.append(len(groups))
    return f, grown


@pytest.fixture(scope="module")
def data(spark):
    rng = np.random.default_rng(8)
    n = 900
    x = np.column_stack([rng.integers(0, 12, n), rng.integers(0, 7, n), np.round(rng.normal(size=n), 1), rng.integers(0, 2, n)]).astype(float)
    y = x[:, 0] * (x[:, 3] - 0.5) + np.where(x[:, 1] > 3, 4.0, 0.0) + rng.normal(size=n)
    x[rng.random(n) < 0.2, 0] = np.nan
    y[np.isnan(x[:, 0])] += 3
    x[rng.random(n) < 0.1, 2] = np.nan
    rows = [(i, *[None if np.isnan(v) else float(v) for v in r], float(t)) for i, (r, t) in enumerate(zip(x, y))]
    return spark.createDataFrame(rows, "id long, a double, b double, c double, k double, ret double").repartition(5), x, y


def predictions(model, df):
    return np.array([r["prediction"] for r in model.transform(df).orderBy("id").select("prediction").collect()])


@pytest.mark.parametrize("leaves, rounds, least", [(2, 1, 20), (6, 3, 20), (31, 2, 5)])
def test_equal_to_growing_one_leaf_at_a_time(data, leaves, rounds, least):
    df, x, y = data
    model = LeafwiseTrees(inputCols=NAMES, maxIter=rounds, learningRate=0.5, maxLeaves=leaves, minRows=least, validation=0.0).fit(df)
    want, grown = plain_fit(x, y, rounds, 0.5, leaves, least)
    assert model.leaves() == grown
    assert np.allclose(predictions(model, df), want, atol=1e-9)


def test_not_dependent_on_partitions_or_ways(data, monkeypatch):
    """Many tasks, summed by a shuffle, one node a pass, predictions written into the rows each round: the same trees."""
    df, _, _ = data
    fit = lambda d: LeafwiseTrees(inputCols=NAMES, maxIter=4, maxLeaves=9, validation=0.0).fit(d)
    one = fit(df)
    for name, value in (("TASK_ROWS", 100), ("DIRECT_BYTES", 0), ("PASS_BYTES", 1), ("KEEP", 1)):
        monkeypatch.setattr(T, name, value)
    other = fit(df.repartition(9))
    assert one.getOrDefault("nodes") == other.getOrDefault("nodes") and one.getOrDefault("cuts") == other.getOrDefault("cuts")
    assert np.allclose(one.getOrDefault("values"), other.getOrDefault("values"), atol=1e-12)


def test_bins_of_many_values(spark):
    """More values than bins: cuts at quantiles, each bin with about as many rows."""
    rng = np.random.default_rng(1)
    x = rng.normal(size=20_000)
    df = spark.createDataFrame([(float(v), 1.0 if i % 3 else None) for i, v in enumerate(x)], "x0 double, x1 double").repartition(4)
    cuts = T.find_cuts(df, 2, 16)
    assert len(cuts[0]) == 15 and len(cuts[1]) == 0
    assert np.bincount(T.to_bins(x[:, None], cuts[:1])[:, 0]) == pytest.approx([1250] * 16, abs=120)
    assert T.to_bins(np.array([[np.nan, np.nan], [0.0, 1.0]]), cuts).tolist() == [[255, 255], [np.searchsorted(cuts[0], 0.0), 0]]


def test_missing_values_unseen_in_training_follow_the_larger_child(spark):
    rows = [(i, float(i % 10 >= 7), float(10 * (i % 10 >= 7))) for i in range(100)]
    df = spark.createDataFrame(rows, "id long, a double, ret double")
    model = LeafwiseTrees(inputCols=["a"], maxIter=1, learningRate=1.0, validation=0.0).fit(df)
    new = spark.createDataFrame([(0, None), (1, 0.0), (2, 1.0)], "id long, a double")
    assert predictions(model, new).tolist() == pytest.approx([0.0, 0.0, 10.0])


def test_stops_and_saves(spark, tmp_path):
    rng = np.random.default_rng(4)
    noise = spark.createDataFrame([(i, *map(float, r)) for i, r in enumerate(rng.normal(size=(1500, 3)))], "id long, a double, b double, ret double")
    model = LeafwiseTrees(inputCols=["a", "b"], validation=0.2, maxIter=40, patience=4).fit(noise)
    assert model.getNumTrees < 20
    x = rng.uniform(-2, 2, size=(3000, 2))
    y = np.abs(x[:, 0]) * 2 + x[:, 1] + rng.normal(size=3000) * 0.1
    df = spark.createDataFrame([(i, *map(float, r), float(t)) for i, (r, t) in enumerate(zip(x, y))], "id long, a double, b double, ret double")
    model = LeafwiseTrees(inputCols=["a", "b"], maxIter=25).fit(df)
    assert 1 - ((predictions(model, df) - y) ** 2).mean() / y.var() > 0.95
    assert all(n <= 31 for n in model.leaves()) and sum(model.featureImportances) == pytest.approx(1.0)
    model.write().save(str(tmp_path / "m"))
    assert np.array_equal(predictions(LeafwiseModel.load(str(tmp_path / "m")), df), predictions(model, df))


def test_nothing_to_split(spark):
    df = spark.createDataFrame([(i, 1.0, None, 2.0) for i in range(30)], "id long, a double, b double, ret double")
    model = LeafwiseTrees(inputCols=["a", "b"]).fit(df)
    assert model.getNumTrees == 0 and set(predictions(model, df)) == {2.0}
    varied = df.withColumn("ret", df.id.cast("double"))
    model = LeafwiseTrees(inputCols=["a", "b"], validation=0.0).fit(varied)
    assert model.getNumTrees == 0 and predictions(model, df)[0] == pytest.approx(14.5)
    with pytest.raises(ValueError, match="maxBins"):
        LeafwiseTrees(inputCols=["a"], maxBins=300)


def test_passes_apply_no_finished_tree_again(data, monkeypatch):
    """Rows come to each pass with the predictions of all trees before; the caches that served are dropped."""
    df, x, y = data
    grown, seen = [], []
    plain = T._Grower._pass

    def watched(self, tree, nodes):
        if nodes == [0]:
            parts = [np.frombuffer(r["f"]) for r in self.rows.collect()]
            seen.append(sum(p.sum() for p in parts))
            grown.append(self)
        out = plain(self, tree, nodes)
        assert not self.older
        return out

    monkeypatch.setattr(T._Grower, "_pass", watched)
    model = LeafwiseTrees(inputCols=NAMES, maxIter=3, learningRate=0.5, validation=0.0).fit(df)
    assert len(seen) == 4 and seen[0] == 0
    assert seen[-1] == pytest.approx((predictions(model, df)[~np.isnan(y)] - model.getOrDefault("base")).sum(), abs=1e-6)


def test_tasks_grow_with_the_rows(data, monkeypatch):
    """Beyond four tasks a core, tasks get more rows instead of becoming more, up to a bound."""
    df, _, _ = data
    staged = df.select(*[F.lit(b"").alias(c) for c in ("bins", "y", "held", "f")]).limit(1)
    cores = df.sparkSession.sparkContext.defaultParallelism
    for n, tasks in ((10, 1), (100_000, 2), (T.TASK_ROWS * 5 * cores, 4 * cores), (T.MOST_TASK_ROWS * 6 * cores, 6 * cores)):
        grower = T._Grower(LeafwiseTrees(inputCols=NAMES), staged, 1, n, 0.0)
        assert grower.tasks == tasks
        grower.rows.unpersist()
