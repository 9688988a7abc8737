from datetime import date

import pandas as pd
import pytest
from pyspark.sql import functions as F

from panelwise.operators import portfolio


def d(month, year=2020):
    return date(year, month, 28)


def bins_frame(spark, rows):
    return spark.createDataFrame(rows, "model string, permno long, date date, ret double, bin int")


@pytest.fixture(scope="module")
def moves(spark):
    """Firm 1 stays in bin 1, firm 2 changes to bin 2 and misses March, firm 3 enters, firm 4 leaves."""
    rows = [
        ("m", 1, d(1), 0.01, 1), ("m", 1, d(2), 0.02, 1), ("m", 1, d(3), 0.03, 1),
        ("m", 2, d(1), 0.05, 1), ("m", 2, d(2), 0.04, 2), ("m", 2, d(4), 0.01, 1),
        ("m", 3, d(2), 0.00, 2), ("m", 3, d(3), None, 2),
        ("m", 4, d(1), 0.03, 2),
        ("flat", 1, d(1), 0.02, 1), ("flat", 1, d(2), 0.01, 1),
    ]
    return bins_frame(spark, rows)


def test_stats_of_a_single_firm_have_no_deviation(moves):
    got = {(r["model"], r["bin"], r["date"]): r for r in portfolio.portfolio_stats(moves).collect()}
    assert got["m", 1, d(1)]["nfirms"] == 2 and got["m", 1, d(1)]["ret"] == pytest.approx(0.03)
    assert got["m", 1, d(1)]["std"] == pytest.approx(0.04 / 2**0.5)
    assert got["m", 2, d(1)]["std"] is None
    assert got["m", 2, d(3)]["nfirms"] == 0 and got["m", 2, d(3)]["ret"] is None


def test_long_short_is_positional(moves):
    stats = portfolio.portfolio_stats(moves)
    got = {(r["model"], r["date"]): r["ret"] for r in portfolio.long_short(stats).collect()}
    assert got["m", d(1)] == pytest.approx(0.03 - 0.03)
    assert got["m", d(2)] == pytest.approx(0.02 - 0.02)
    assert got["m", d(3)] is None
    assert got["flat", d(1)] == 0.0
    strict = {(r["model"], r["date"]): r["ret"] for r in portfolio.long_short(stats, strict=True, nport=2).collect()}
    assert strict["flat", d(1)] is None and strict["m", d(1)] == pytest.approx(0.0)


def test_wide_and_back(moves):
    rets = portfolio.portfolio_returns(portfolio.portfolio_stats(moves))
    wide = portfolio.returns_wide(rets)
    assert set(wide.columns) == {"date", "ret_m_bin1", "ret_m_bin2", "ret_m_binLS", "ret_flat_bin1", "ret_flat_binLS"}
    back = {(r["model"], r["bin"], r["date"]): r["ret"] for r in portfolio.returns_long(wide).collect()}
    assert not rets.filter("ret is null and bin <> 'LS'").count()
    for r in rets.collect():
        assert back[r["model"], r["bin"], r["date"]] == r["ret"]


def test_names_with_signs_and_underscores_survive(spark):
    wide = spark.createDataFrame([(1, d(1), 0.1, 1.0, 2.0)], "permno long, date date, ret double, `pred_mlp-64-32` double, pred_my_model double")
    assert {r["model"] for r in portfolio.predictions_long(wide).collect()} == {"mlp-64-32", "my_model"}


def by_hand(pdf):
    out = {}
    for model, rows in pdf.groupby("model"):
        rows = rows.sort_values("date").copy()
        rows["prev"] = rows.groupby("permno")["bin"].shift(1)
        for b in sorted(rows["bin"].dropna().unique()):
            for day, g in rows.groupby("date"):
                now, then = g["bin"] == b, g["prev"] == b
                held = (now | then).sum()
                out[model, int(b), day] = tuple((x.sum() / held if held else None) for x in (now & ~then, ~now & then, now & then))
    return out


def test_turnover_by_definition(moves):
    got = {(r["model"], r["bin"], r["date"]): (r["buy"], r["sell"], r["hold"]) for r in portfolio.turnover(moves, 2).collect()}
    assert got == by_hand(moves.toPandas())
    assert got["m", 1, d(1)] == (1.0, 0.0, 0.0)
    assert got["m", 2, d(4)] == (0.0, 1.0, 0.0)
    assert got["flat", 1, d(2)] == (0.0, 0.0, 1.0)
    assert ("flat", 2, d(1)) not in got


def test_calendar_lag_ignores_a_gap(moves):
    got = {(r["model"], r["bin"], r["date"]): r["buy"] for r in portfolio.turnover(moves, 2, calendar=True).collect()}
    assert got["m", 1, d(4)] == 1.0 and got["m", 2, d(4)] is None


def test_shares_add_up(moves):
    for r in portfolio.turnover(moves, 2).filter("buy is not null").collect():
        assert r["buy"] + r["sell"] + r["hold"] == pytest.approx(1.0)


def test_turnover_rejects_bins_beyond_nport(moves):
    with pytest.raises(Exception, match="bins above nport"):
        portfolio.turnover(moves, 1).collect()


def test_turnover_rejects_repeated_firms(moves):
    with pytest.raises(Exception, match="duplicate key"):
        portfolio.turnover(moves.unionByName(moves.limit(1)), 2).collect()


def test_average_turnover(moves):
    t = portfolio.turnover(moves, 2)
    means = {(r["model"], r["bin"]): r["hold"] for r in portfolio.average_turnover(t, 2).collect()}
    frame = t.toPandas()
    for (m, b), g in frame.groupby(["model", "bin"]):
        assert means[m, b] == pytest.approx(round(pd.Series(g["hold"], dtype=float).mean(), 2))
    wide = portfolio.average_turnover_wide(t, "buy", 2)
    assert wide.columns == ["model", "1", "2"]
    assert portfolio.hold_series(t, "flat").filter(F.col("hold") == 1).count() == 1
