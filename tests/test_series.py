from datetime import date

import numpy as np
import pytest

from panelwise.operators import series


def d(month, year=2020):
    return date(year, month, 28)


def frame(spark, values, model="m", bin_="LS", first=1):
    rows = [(model, bin_, d(first + i), v) for i, v in enumerate(values)]
    return spark.createDataFrame(rows, "model string, bin string, date date, ret double")


def test_product_skips_missing_and_handles_ruin(spark):
    got = {r["date"]: r["value"] for r in series.cumulative(frame(spark, [0.1, None, -1.0, 0.5, -2.5])).collect()}
    assert got[date(2019, 12, 28)] == 1.0
    assert got[d(1)] == pytest.approx(1.1) and got[d(2)] is None
    assert got[d(3)] == 0.0 and got[d(4)] == 0.0 and got[d(5)] == 0.0


def test_base_row_is_one_month_before_the_table(spark):
    both = frame(spark, [0.1, 0.2]).unionByName(frame(spark, [0.3], "late", first=2))
    base = [r for r in series.cumulative(both).collect() if r["date"] == date(2019, 12, 28)]
    assert {r["model"] for r in base} == {"m", "late"}
    assert series.cumulative(both, base_row=False).count() == 3


@pytest.mark.parametrize("window", [3, 4, 12])
def test_centred_average_needs_the_whole_window(spark, window):
    values = [float(v) for v in range(1, 13)]
    got = {r["date"].month: r["ma"] for r in series.moving_average(frame(spark, values), window).collect()}
    ahead = (window - 1) // 2
    for m in range(1, 13):
        part = values[max(m - 1 - (window - 1 - ahead), 0) : m + ahead]
        whole = m - 1 - (window - 1 - ahead) >= 0 and m + ahead <= 12
        assert got[m] == (pytest.approx(np.mean(part)) if whole else None)


def test_fill_zero_also_fills_absent_months(spark):
    both = frame(spark, [0.3, 0.6, 0.9]).unionByName(frame(spark, [3.0], "n", first=2))
    got = {(r["model"], r["date"]): r["ma"] for r in series.moving_average(both, 3).collect()}
    assert got["n", d(2)] == pytest.approx(1.0) and got["m", d(2)] == pytest.approx(0.6)
    gap = {r["date"]: r["ma"] for r in series.moving_average(frame(spark, [0.3, None, 0.9]), 3, fill_zero=False).collect()}
    assert gap[d(2)] is None


def test_drawdown_starts_at_the_first_value(spark):
    rets = frame(spark, [-0.5, 0.2, -0.1])
    assert series.max_drawdown(rets).first()["max_drawdown"] == pytest.approx(10.0)
    assert series.max_drawdown(rets, include_base=True).first()["max_drawdown"] == pytest.approx(50.0)


def test_metrics_and_sharpe(spark):
    values = [0.01, 0.03, -0.02, 0.05]
    r = series.model_metrics(frame(spark, values)).first()
    assert r["mean_pct"] == pytest.approx(np.mean(values) * 100)
    assert r["std_pct"] == pytest.approx(np.std(values, ddof=1) * 100)
    assert r["sharpe"] == pytest.approx(np.mean(values) / np.std(values, ddof=1) * 12**0.5)
    grown = np.cumprod(1 + np.array(values))
    assert r["max_drawdown"] == pytest.approx((1 - grown / np.maximum.accumulate(grown)).max() * 100)
    assert series.sharpe(frame(spark, [0.02, 0.02])).first()["sharpe"] is None
    assert series.sharpe(frame(spark, [0.02])).first()["sharpe"] is None
    scaled = series.sharpe(frame(spark, [10 * v for v in values])).first()["sharpe"]
    assert scaled == pytest.approx(r["sharpe"])


def test_zoo_comparison_uses_common_months(spark):
    zoo = spark.createDataFrame([("z", d(2), 10.0), ("z", d(3), 20.0), ("z", d(9), 5.0), ("y", d(3), 1.0)], "signalname string, date date, ret double")
    got = {(r["series"], r["date"]): r["value"] for r in series.against_zoo(frame(spark, [0.5, 0.1, 0.2]), "m", zoo).collect()}
    assert got["m", d(3)] == pytest.approx(1.1 * 1.2) and got["z", d(3)] == pytest.approx(1.1 * 1.2)
    assert ("m", d(1)) in got and got["m", d(1)] == 1.0 and ("z", d(9)) not in got
    assert got["y", d(3)] == pytest.approx(1.01)
    only = series.against_zoo(frame(spark, [0.5, 0.1, 0.2]), "m", zoo, ["y"])
    assert {r["series"] for r in only.collect()} == {"m", "y"}


def test_exact_model_names(spark):
    both = frame(spark, [0.1], "Lasso").unionByName(frame(spark, [0.2], "LassoCV"))
    assert [r["model"] for r in series.long_short_series(both, ["Lasso"]).collect()] == ["Lasso"]
    assert series.long_short_series(both, []).count() == 2
    assert series.wants_log_scale(series.cumulative(frame(spark, [60.0]))).first()[0] is True
