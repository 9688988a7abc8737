from datetime import date

import numpy as np
import pytest
from pyspark.sql import functions as F

from panelwise.operators import alphas

NAMES = ["mkt_excess", "SMB", "HML", "RMW", "CMA", "Mom"]


@pytest.fixture(scope="module")
def inputs(spark):
    rng = np.random.default_rng(5)
    months = [date(2000 + i // 12, i % 12 + 1, 28) for i in range(48)]
    x = rng.normal(size=(48, 6))
    rf = rng.uniform(0.1, 0.3, 48)
    factors = [(m, *map(float, x[i]), float(rf[i])) for i, m in enumerate(months)]
    factors[3] = (*factors[3][:6], None, factors[3][7])  # no momentum in one month
    f = spark.createDataFrame(factors[:-2], "date date, " + ", ".join(f"{n} double" for n in NAMES) + ", RF double")
    rows = []
    for b in ("1", "5", "LS"):
        y = 0.01 + x @ rng.normal(size=6) * 0.01 + rng.normal(size=48) * 0.02
        rows += [("Lasso", b, m, float(v)) for m, v in zip(months, y)]
    rows[7] = (*rows[7][:3], None)
    r = spark.createDataFrame(rows, "model string, bin string, date date, ret double")
    return r, f


def test_against_least_squares(inputs):
    r, f = inputs
    got = {(g["bin"], g["factor_model"]): g for g in alphas.factor_alphas(r, f).collect()}
    frame = r.join(f, "date").orderBy("date").toPandas()
    assert len(got) == 18
    for b, rows in frame.groupby("bin"):
        for spec, used in alphas.SIX_SPECS.items():
            known = rows.dropna(subset=["ret", "RF", *used])
            y = known["ret"].to_numpy() * 100 - known["RF"].to_numpy()
            x = np.column_stack([np.ones(len(known)), *[known[c] for c in used]])
            coef, *_ = np.linalg.lstsq(x, y, rcond=None)
            e = y - x @ coef
            cov = e @ e / (len(y) - x.shape[1]) * np.linalg.inv(x.T @ x)
            g = got[b, spec]
            assert g["n"] == len(y)
            assert g["alpha"] == pytest.approx(coef[0], abs=1e-9)
            assert g["t_stat"] == pytest.approx(coef[0] / cov[0, 0] ** 0.5, abs=1e-7)
            assert g["r2"] == pytest.approx(1 - e @ e / ((y - y.mean()) @ (y - y.mean())), abs=1e-9)
            for name, value in zip(used, coef[1:]):
                assert g[f"beta_{name}"] == pytest.approx(value, abs=1e-9)
            assert all(g[f"beta_{n}"] is None for n in NAMES if n not in used)


def test_scaling_returns_leaves_t_alone_without_rf(inputs):
    r, f = inputs
    free = f.withColumn("RF", F.lit(0.0))
    a = {(g["bin"], g["factor_model"]): g["t_stat"] for g in alphas.factor_alphas(r, free).collect()}
    b = {(g["bin"], g["factor_model"]): g["t_stat"] for g in alphas.factor_alphas(r.withColumn("ret", F.col("ret") * 7), free).collect()}
    assert all(a[k] == pytest.approx(b[k], rel=1e-6) for k in a)


def test_options_and_tables(inputs):
    r, f = inputs
    spec = {"r^e": ()}
    plain = {g["bin"]: g["alpha"] for g in alphas.factor_alphas(r, f, spec).collect()}
    kept = {g["bin"]: g["alpha"] for g in alphas.factor_alphas(r, f, spec, subtract_rf_from_ls=False).collect()}
    assert plain["1"] == kept["1"] and plain["LS"] < kept["LS"]
    table = alphas.alpha_table(alphas.factor_alphas(r, f))
    assert table.count() == 12 and set(table.columns) == {"factor_model", "metric", "Lasso_bin1", "Lasso_bin5", "Lasso_binLS"}
    with pytest.raises(ValueError, match="no long-short"):
        alphas.ls_alphas(r, f, ["LassoCV"])
    flags = alphas.flag_significant(alphas.ls_alphas(r, f, ["Lasso"])).collect()
    assert all(g["significant"] == (abs(g["t_stat"]) > 1.96) for g in flags) and len(flags) == 6


def test_too_few_months_give_no_t(spark, inputs):
    _, f = inputs
    r = spark.createDataFrame([("m", "LS", date(2000, 1, 28), 0.1), ("m", "LS", date(2000, 2, 28), 0.2)], "model string, bin string, date date, ret double")
    got = {g["factor_model"]: g["t_stat"] for g in alphas.factor_alphas(r, f).collect()}
    assert got["r^e"] is not None and got["CAPM"] is None and got["FF6"] is None
