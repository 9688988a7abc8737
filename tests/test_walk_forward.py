from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwise.models import walk_forward as wf
from panelwise.models.interpret import coefficients, importances
from panelwise.sources import store

VARIANTS = [("Ridge", "Ridge", {}), ("LassoCV", "LassoCV", {"nAlphas": 5})]


@pytest.fixture(scope="module")
def panel(spark):
    rng = np.random.default_rng(2)
    rows = []
    for y in range(2000, 2005):
        for m in range(1, 13):
            for p in range(12):
                a, b = rng.normal(size=2)
                rows.append((p, date(y, m, 28), float(a + 0.5 * b + rng.normal() * 0.1), None if rng.random() < 0.1 else float(a), float(b), "ab"[p % 2]))
    rows[5] = (*rows[5][:2], None, *rows[5][3:])
    return spark.createDataFrame(rows, "permno long, date date, ret double, a double, b double, k string")


def as_dict(df):
    return {(r["permno"], r["date"], r["model"]): r["pred"] for r in df.collect()}


def test_predicts_each_year_from_the_years_before(panel):
    got = wf.walk_forward(panel, ["a", "b"], ["k"], [2002, 2003], VARIANTS)
    rows = as_dict(got)
    assert len(rows) == 2 * 2 * 144 and got.columns == ["permno", "date", "ret", "model", "pred"]
    quality = got.filter("model = 'Ridge'").agg(F.corr("pred", "ret")).first()[0]
    assert quality > 0.9


def test_later_data_do_not_leak(panel):
    changed = panel.withColumn("ret", F.when(F.year("date") >= 2003, F.col("ret") * -9 + 1).otherwise(F.col("ret")))
    changed = changed.withColumn("a", F.when(F.year("date") >= 2003, F.col("a") * 50).otherwise(F.col("a")))
    before = as_dict(wf.walk_forward(panel, ["a", "b"], ["k"], [2001, 2002, 2003], VARIANTS).filter(F.year("date") < 2003))
    after = as_dict(wf.walk_forward(changed, ["a", "b"], ["k"], [2001, 2002, 2003], VARIANTS).filter(F.year("date") < 2003))
    assert before.keys() == after.keys()
    assert all(before[k] == pytest.approx(after[k], abs=1e-12) for k in before)


def test_a_rolling_window_forgets(panel):
    odd = panel.withColumn("ret", F.when(F.year("date") == 2000, -F.col("ret")).otherwise(F.col("ret")))
    ridge = [("Ridge", "Ridge", {})]
    a = as_dict(wf.walk_forward(panel, ["a", "b"], (), [2003], ridge, window_years=2))
    b = as_dict(wf.walk_forward(odd, ["a", "b"], (), [2003], ridge, window_years=2))
    assert all(a[k] == pytest.approx(b[k], abs=1e-12) for k in a)
    c = as_dict(wf.walk_forward(odd, ["a", "b"], (), [2003], ridge))
    assert any(abs(a[k] - c[k]) > 1e-3 for k in a)


def test_a_second_run_fits_nothing(panel, tmp_path, monkeypatch):
    path = str(tmp_path / "predictions")
    first = as_dict(wf.walk_forward(panel, ["a", "b"], (), [2002, 2003], VARIANTS, store=path))
    calls = []
    plain = wf.fit_variants
    monkeypatch.setattr(wf, "fit_variants", lambda train, names, left, *more: calls.append([v[0] for v in left]) or plain(train, names, left, *more))
    again = as_dict(wf.walk_forward(panel, ["a", "b"], (), [2002, 2003], VARIANTS, store=path))
    assert calls == [] and again == first
    more = wf.walk_forward(panel, ["a", "b"], (), [2002, 2003, 2004], [*VARIANTS, ("OLS", "OLS", {})], store=path)
    assert sorted(calls) == [["OLS"], ["OLS"], ["Ridge", "LassoCV", "OLS"]]
    assert {k: v for k, v in as_dict(more).items() if k in first} == first
    assert store.finished_models(panel.sparkSession, path) == ["LassoCV", "OLS", "Ridge"]
    wf.walk_forward(panel, ["a", "b"], (), [2002], [("OLS", "OLS", {})], store=path, skip_done=False)
    assert calls[-1] == ["OLS"]


def test_final_fit_saves_and_reloads(panel, tmp_path, spark):
    folder = str(tmp_path / "models")
    variants = [("OLS", "OLS", {}), ("hgbr", "hgbr", {"maxIter": 2}), ("mlp-4", "mlp", {"hidden": [4], "maxIter": 2}), ("mlp-3", "mlp", {"hidden": [3], "maxIter": 2})]
    models = wf.final_fit(panel, ["a", "b"], ["k"], 2004, variants, folder=folder)
    loaded = wf.final_fit(panel, ["a", "b"], ["k"], 2004, variants, folder=folder)
    new = panel.filter(F.year("date") == 2004)
    sums = {}
    for name in models:
        one, two = (m[name].transform(new).agg(F.sum("prediction")).first()[0] for m in (models, loaded))
        assert one == pytest.approx(two)
        sums[name] = one
    assert len(set(sums.values())) == 4  # every variant has its own weights
    top = coefficients(loaded["OLS"], 2).collect()
    assert [r["feature"] for r in top] == ["a", "b"]
    assert {r["feature"] for r in importances(loaded["hgbr"]).collect()} == {"a", "b", "k_a", "k_b"}
    with pytest.raises(ValueError, match="no coefficients"):
        coefficients(loaded["hgbr"])
    with pytest.raises(ValueError, match="no feature importances"):
        importances(loaded["OLS"])


def test_upsert_prefers_new_and_rejects_repeats(spark):
    schema = "permno long, date date, ret double, model string, pred double"
    d = date(2000, 1, 28)
    old = spark.createDataFrame([(1, d, 0.1, "m", 1.0), (2, d, 0.2, "m", 2.0)], schema)
    new = spark.createDataFrame([(1, d, 0.1, "m", 9.0), (3, d, 0.3, "m", 3.0)], schema)
    got = {r["permno"]: r["pred"] for r in store.upsert_predictions(new, old).collect()}
    assert got == {1: 9.0, 2: 2.0, 3: 3.0}
    with pytest.raises(Exception, match="duplicate key"):
        store.upsert_predictions(new.unionByName(new), old).collect()
    wide = store.predictions_wide(old.unionByName(new.withColumn("model", F.lit("mlp-64-32"))), ["m", "mlp-64-32"])
    assert wide.columns == ["permno", "date", "ret", "pred_m", "pred_mlp-64-32"]


def test_single_precision_changes_little(panel):
    ridge = [("Ridge", "Ridge", {})]
    a = as_dict(wf.walk_forward(panel, ["a", "b"], ["k"], [2003], ridge))
    b = as_dict(wf.walk_forward(panel, ["a", "b"], ["k"], [2003], ridge, single_precision=True))
    assert a != b and all(a[k] == pytest.approx(b[k], abs=1e-5) for k in a)
