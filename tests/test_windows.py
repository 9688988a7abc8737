"""Windows learned together against each window learned alone, and against numpy."""

from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwise.models import shared, walk_forward as wf
from panelwise.models.linear import LinearFit
from panelwise.prep import windows as W
from panelwise.prep.pipeline import build_preprocessor, feature_names, fit_prepare
from panelwise.prep.stages import fill_from_sums, period_sums
from panelwise.runtime import stage_table

NAMES = ["a", "b", "late", "never", "same"]


@pytest.fixture(scope="module")
def panel(spark):
    """Five years; one column starts in the third, one has no value at all, one is constant and far from zero; levels come and go."""
    rng = np.random.default_rng(11)
    rows = []
    for y in range(2000, 2005):
        for m in range(1, 13):
            for p in range(15):
                a, b = rng.normal(size=2) * (1 + y - 2000)
                k = None if rng.random() < 0.2 else rng.choice(["u", "v", f"y{y}"])
                d = None if rng.random() < 0.1 else float(rng.integers(0, 3))
                late = float(rng.normal() + 5) if y >= 2002 and rng.random() < 0.7 else None
                rows.append((p, date(y, m, 28), float(a - b + rng.normal()), None if rng.random() < 0.1 else float(a), round(float(b), 1), late, None, 1e6, k, d))
    return spark.createDataFrame(rows, "permno long, date date, ret double, a double, b double, late double, never double, same double, k string, d double")


def learned(panel, years=(2001, 2003, 2004), rolling=None, by="year", **options):
    staged = stage_table(panel.withColumn("_year", F.year("date")), "_year")
    sums, small = period_sums(staged, NAMES, "date", by)
    means = W.YearMeans(sums, len(NAMES), by)
    filled = W.filled_by_period(staged, NAMES, sums, small, "date", by)
    windows = [W.Window(y, None if rolling is None else y - rolling) for y in years]
    W.learn_windows(filled, windows, NAMES, ["k", "d"], means, **options)
    return staged, filled, windows, means


def train_of(panel, window):
    rows = panel.filter(F.year("date").isin(list(window.years)))
    return fill_from_sums(rows, NAMES, *period_sums(rows, NAMES))


@pytest.mark.parametrize("rolling", [None, 2])
def test_equal_to_each_window_alone(panel, rolling):
    _, filled, windows, means = learned(panel, rolling=rolling)
    design = shared.Design(windows, NAMES, ["k", "d"], "ret")
    fits = shared.shared_moments(filled, design)
    for w, fit, light in zip(windows, fits, shared.shared_scales(filled, design)):
        assert w.years == tuple(y for y in range(2000, w.year) if rolling is None or y >= w.year - rolling)
        pre, prepared = fit_prepare(build_preprocessor(NAMES, ["k", "d"], impute=False), train_of(panel, w))
        stages = w.stages(NAMES, ["k", "d"], fit.means, fit.scales)
        for ours, alone in zip(stages.stages, pre.stages):
            assert type(ours) is type(alone)
            for p in alone.params:
                got, want = ours.getOrDefault(p.name), alone.getOrDefault(p.name)
                assert got == pytest.approx(want, abs=1e-9) if not want or isinstance(want[0], float) else got == want, p.name
        assert np.allclose(light.means, fit.means) and np.allclose(light.scales, fit.scales)
        names = feature_names(stages)
        alone = LinearFit(inputCols=names).moments(prepared)[0]
        assert np.allclose(fit.folds[0].z, alone.z, atol=1e-7)


def test_bounds_by_every_way(panel, monkeypatch):
    """Directly, by sketches and brackets, with brackets that miss, in small pieces: numpy's quantiles each time."""
    _, filled, windows, _ = learned(panel)
    want = np.zeros((len(windows), len(NAMES), 2))
    for i, w in enumerate(windows):
        table = train_of(panel, w).select(NAMES).toPandas().to_numpy()
        want[i] = np.quantile(table, [0.1, 0.8], axis=0).T
    rows = filled.filter("_year < 2004")
    find = lambda **o: W.window_quantiles(rows, windows, NAMES, [0.1, 0.8], **o)
    assert np.allclose(find(), want, atol=1e-9)
    assert np.allclose(find(direct_pairs=0), want, atol=1e-9)
    assert np.allclose(find(direct_pairs=0, segment_rows=7), want, atol=1e-9)
    monkeypatch.setattr(W, "SKETCH_K", 8)
    monkeypatch.setattr(W, "SKETCH_ERROR", 0.0)
    calls = []
    plain = W.exact_quantiles
    monkeypatch.setattr(W, "exact_quantiles", lambda *a: calls.append(1) or plain(*a))
    assert np.allclose(find(direct_pairs=0), want, atol=1e-9)
    assert calls
    rough = find(exact=False)
    assert np.abs(rough - want).max() < 0.6 and np.array_equal(rough[:, 3], want[:, 3])


def test_scans_do_not_grow_with_the_windows(panel, spark):
    """As many jobs for five windows as for two."""

    def jobs(years):
        sc = spark.sparkContext
        group = f"windows-{len(years)}"
        sc.setJobGroup(group, group)
        try:
            _, filled, windows, means = learned(panel, years)
            todo = {y: [(n, n, {}) for n in ("OLS", "Ridge", "Lasso", "RidgeCV", "LassoCV")] for y in years}
            wf.shared_fits(filled, windows, todo, NAMES, ["k", "d"], "ret")
            return len(sc.statusTracker().getJobIdsForGroup(group))
        finally:
            sc.setLocalProperty("spark.jobGroup.id", None)

    assert jobs((2002, 2003)) >= jobs((2001, 2002, 2003, 2004, 2005)) > 0


def test_matrices_are_dealt_into_scans(panel, monkeypatch):
    _, filled, windows, means = learned(panel)
    design = shared.Design(windows, NAMES, ["k", "d"], "ret")
    at_once = shared.shared_moments(filled, design)
    monkeypatch.setattr(shared, "MAX_TASK_BYTES", 1)
    for a, b in zip(at_once, shared.shared_moments(filled, design)):
        assert np.allclose(a.folds[0].z, b.folds[0].z) and np.array_equal(a.turn, b.turn)
    monkeypatch.setattr(shared.gram, "MAX_MATRIX_BYTES", 100)
    with pytest.raises(ValueError, match="cross products exceed"):
        shared.shared_moments(filled, design)


@pytest.mark.parametrize("by", ["year", "date"])
def test_predictions_as_of_windows_alone(panel, by):
    """All five linear models, both folds, by year and by month: what fitting each window by itself predicts."""
    variants = [(n, n, {}) for n in ("OLS", "Ridge", "RidgeCV", "LassoCV")] + [("Lasso", "Lasso", {"alpha": 0.05})]
    if by == "date":
        variants = [("LassoCV", "LassoCV", {"nAlphas": 7, "foldBy": "entity"}), ("Ridge", "Ridge", {})]
    got = wf.walk_forward(panel, NAMES, ["k", "d"], [2002, 2004], variants, impute_by=by)
    found = {(r["permno"], r["date"], r["model"]): r["pred"] for r in got.collect()}
    n = 0
    for year in (2002, 2004):
        train, test = panel.filter(F.year("date") < year), panel.filter(F.year("date") == year)
        train, test = (fill_from_sums(x, NAMES, *period_sums(x, NAMES, "date", by), "date", by) for x in (train, test))
        pre, prepared = fit_prepare(build_preprocessor(NAMES, ["k", "d"], impute=False), train)
        for name, model in wf.fit_variants(prepared, feature_names(pre), variants):
            for r in model.transform(pre.transform(test)).select("permno", "date", "prediction").collect():
                assert found[r["permno"], r["date"], name] == pytest.approx(r["prediction"], abs=1e-7)
                n += 1
    assert n == len(found) == 2 * 180 * len(variants)


def test_levels_alone_are_enough(panel):
    got = wf.walk_forward(panel, (), ["k", "d"], [2003], [("Ridge", "Ridge", {}), ("hgbr", "hgbr", {"maxIter": 2})])
    assert got.count() == 2 * 180 and got.filter("pred is null").count() == 0


def test_a_window_without_rows_is_an_error(panel):
    with pytest.raises(ValueError, match="no training rows"):
        wf.walk_forward(panel, NAMES, (), [2000], [("OLS", "OLS", {})])
