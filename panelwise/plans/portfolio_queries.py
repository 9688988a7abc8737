"""Bins, portfolio returns, long-short, turnover."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelwise.operators import portfolio
from panelwise.plans import oracle_parts as sql
from panelwise.plans import tables
from panelwise.plans.registry import day, num, nums, query, shown

_BIN_LIST = list(range(1, 6))
_SERIES = [(m, b) for m in tables.MODEL_SIGNALS for b in ("1", "2", "3", "4", "5", "LS")]


@query("assign_bins", sql.statement(sql.BINS, f"select permno, {day('date')}, model, {num('pred')}, cast(bin as double) as bin from bins"))
def assign_bins(spark, sf_dir):
    return shown(tables.bins(spark, sf_dir).select("permno", "date", "model", "pred", F.col("bin").cast("double").alias("bin")))


@query("bin_sizes", sql.statement(sql.BINS, "select model, bin, count(*) as n from bins where bin is not null group by 1, 2"))
def bin_sizes(spark, sf_dir):
    return portfolio.bin_sizes(tables.bins(spark, sf_dir).filter("bin is not null"))


@query("portfolio_stats", sql.statement(sql.STATS, f"select model, bin, {day('date')}, {nums('ret', 'std')}, nfirms from stats"))
def portfolio_stats(spark, sf_dir):
    return shown(tables.stats(spark, sf_dir))


@query("portfolio_nfirms_series", sql.statement(sql.STATS, f"select {day('date')}, bin, nfirms from stats where model = 'LassoCV'"))
def portfolio_nfirms_series(spark, sf_dir):
    chosen = tables.predictions(spark, sf_dir).filter(F.col("model") == "LassoCV")
    return shown(portfolio.portfolio_stats(portfolio.assign_bins(chosen)).select("date", "bin", "nfirms"))


_WIDE = ", ".join(
    num(f"max(ret) filter (model = '{m}' and bin = '{b}')", f'"ret_{m}_bin{b}"') for m, b in _SERIES
)


@query("portfolio_wide", sql.statement(sql.RETURNS, f"select {day('date')}, {_WIDE} from returns group by date"))
def portfolio_wide(spark, sf_dir):
    return shown(portfolio.returns_wide(tables.portfolio_returns(spark, sf_dir), _SERIES))


@query(
    "portfolio_wide_to_long",
    sql.statement(
        sql.RETURNS,
        f"select m.model, b.bin, {day('d.date', 'date')}, {num('r.ret', 'ret')} "
        "from (select distinct date from returns) d cross join (select distinct model from returns) m "
        "cross join (select unnest(['1', '2', '3', '4', '5', 'LS']) as bin) b "
        "left join returns r on r.date = d.date and r.model = m.model and r.bin = b.bin",
    ),
)
def portfolio_wide_to_long(spark, sf_dir):
    return shown(portfolio.returns_long(portfolio.returns_wide(tables.portfolio_returns(spark, sf_dir), _SERIES)))


@query("long_short", sql.statement(sql.RETURNS, f"select model, {day('date')}, {num('ret')} from ls"))
def long_short(spark, sf_dir):
    return shown(portfolio.long_short(tables.stats(spark, sf_dir)))


@query(
    "long_short_strict",
    sql.statement(
        sql.STATS,
        f"select model, {day('date')}, {num('max(ret) filter (bin = 5) - max(ret) filter (bin = 1)', 'ret')} "
        "from stats where ret is not null group by model, date",
    ),
)
def long_short_strict(spark, sf_dir):
    return shown(portfolio.long_short(tables.stats(spark, sf_dir), strict=True))


def turnover_sql(lag: str) -> list[str]:
    return [
        *sql.BINS,
        f"moves as (select model, permno, date, bin as curr, {lag} as prev from bins window w as (partition by model, permno order by date))",
        "touched as (select model, date, b as bin, curr is not distinct from b as now_in, prev is not distinct from b as then_in "
        "from moves cross join (select unnest([1, 2, 3, 4, 5]) as b))",
        "counted as (select model, bin, date, count(*) filter (now_in and not then_in) as nb, count(*) filter (then_in and not now_in) as ns, "
        "count(*) filter (now_in and then_in) as nh from touched group by 1, 2, 3)",
        'turnover as (select model, bin, date, nb / nullif(nb + ns + nh, 0) as buy, ns / nullif(nb + ns + nh, 0) as sell, '
        'nh / nullif(nb + ns + nh, 0) as hold from (select *, sum(nb + nh) over (partition by model, bin) as used from counted) where used > 0)',
    ]


_TURNOVER = turnover_sql("lag(bin) over w")


@query("turnover", sql.statement(_TURNOVER, f"select model, bin, {day('date')}, {nums('buy', 'sell', 'hold')} from turnover"))
def turnover(spark, sf_dir):
    return shown(portfolio.turnover(tables.bins(spark, sf_dir)))


@query(
    "turnover_calendar",
    sql.statement(
        turnover_sql("case when lag(date) over w = date - interval 1 month then lag(bin) over w end"),
        f"select model, bin, {day('date')}, {nums('buy', 'sell', 'hold')} from turnover",
    ),
)
def turnover_calendar(spark, sf_dir):
    return shown(portfolio.turnover(tables.bins(spark, sf_dir), calendar=True))


@query(
    "turnover_avg",
    sql.statement(
        _TURNOVER,
        f"select model, bin, {num('avg(buy)', 'buy', 7)}, {num('avg(sell)', 'sell', 7)}, {num('avg(hold)', 'hold', 7)} from turnover group by 1, 2",
    ),
)
def turnover_avg(spark, sf_dir):
    return shown(portfolio.average_turnover(portfolio.turnover(tables.bins(spark, sf_dir))), 7)


@query(
    "turnover_avg_wide",
    sql.statement(
        _TURNOVER,
        "select model, " + ", ".join(num(f"avg(hold) filter (bin = {b})", f'"{b}"', 7) for b in _BIN_LIST) + " from turnover group by 1",
    ),
)
def turnover_avg_wide(spark, sf_dir):
    return shown(portfolio.average_turnover_wide(portfolio.turnover(tables.bins(spark, sf_dir))), 7)


@query("turnover_hold_series", sql.statement(_TURNOVER, f"select {day('date')}, bin, {num('hold')} from turnover where model = 'Ridge'"))
def turnover_hold_series(spark, sf_dir):
    chosen = tables.predictions(spark, sf_dir).filter(F.col("model") == "Ridge")
    return shown(portfolio.hold_series(portfolio.turnover(portfolio.assign_bins(chosen)), "Ridge"))
