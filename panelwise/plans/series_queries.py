"""Cumulative returns, moving averages, drawdown, Sharpe, zoo comparison and alphas."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelwise.functions.columns import nan_to_null
from panelwise.operators import alphas, portfolio, series
from panelwise.plans import oracle_parts as sql
from panelwise.plans import tables
from panelwise.plans.registry import day, num, nums, query, shown

_LS = [*sql.RETURNS, "ls_series as (select model, date, ret from ls)"]


@query(
    "cumulative_returns",
    sql.statement([*sql.RETURNS, sql.cumulated("returns", "model, bin")], f"select model, bin, {day('date')}, {num('value', digits=8)} from cumulated"),
)
def cumulative_returns(spark, sf_dir):
    return shown(series.cumulative(tables.portfolio_returns(spark, sf_dir)), 8)


@query(
    "cumulative_product",
    sql.statement(
        _LS,
        f"select model, {day('date')}, {num('case when ret is not null then product(1 + ret) over (partition by model order by date) end', 'value', 8)} from ls",
    ),
)
def cumulative_product(spark, sf_dir):
    ls = portfolio.long_short(tables.stats(spark, sf_dir))
    return shown(series.running_product(ls, ["model"]).select("model", "date", "value"), 8)


@query(
    "cumulative_base_row",
    sql.statement(
        sql.RETURNS,
        f"select model, strftime((select min(date) from returns) - interval 1 month, '%Y-%m-%d') as date, 1.0e0 as value from (select distinct model from ls)",
    ),
)
def cumulative_base_row(spark, sf_dir):
    rets = tables.portfolio_returns(spark, sf_dir)
    start = rets.agg(F.add_months(F.min("date"), -1)).scalar()
    grown = series.cumulative(series.long_short_series(rets), ["model"])
    return shown(grown.filter(F.col("date") == start))


_MA = """case when count(ret) over w = {w} then avg(ret) over w end"""


def ma_sql(w: int, source: str, keys: str) -> str:
    ahead = (w - 1) // 2
    return (
        f"ma as (select {keys}, date, ret, {_MA.format(w=w)} as ma from {source} "
        f"window w as (partition by {keys} order by date rows between {w - 1 - ahead} preceding and {ahead} following))"
    )


_DENSE = """dense as (
  select k.model, k.bin, d.date, coalesce(r.ret, 0.0e0) as ret
  from (select distinct model, bin from returns) k cross join (select distinct date from returns) d
  left join returns r on r.model = k.model and r.bin = k.bin and r.date = d.date
)"""


@query("moving_average_12", sql.statement([*sql.RETURNS, _DENSE, ma_sql(12, "dense", "model, bin")], f"select model, bin, {day('date')}, {nums('ret', 'ma')} from ma"))
def moving_average_12(spark, sf_dir):
    return shown(series.moving_average(tables.portfolio_returns(spark, sf_dir), 12))


@query("moving_average_7", sql.statement([*sql.RETURNS, _DENSE, ma_sql(7, "dense", "model, bin")], f"select model, bin, {day('date')}, {nums('ret', 'ma')} from ma where bin = 'LS'"))
def moving_average_7(spark, sf_dir):
    return shown(series.moving_average(tables.portfolio_returns(spark, sf_dir), 7).filter("bin = 'LS'"))


@query(
    "moving_average_daily",
    sql.statement(
        [
            "daily as (select event_type as series, cast(ts as date) as date, cast(sum(cast(round(value * 100) as bigint)) as double) / count(*) as ret from events group by 1, 2)",
            ma_sql(5, "daily", "series"),
        ],
        f"select series, {day('date')}, {nums('ret', 'ma', digits=7)} from ma",
    ),
)
def moving_average_daily(spark, sf_dir):
    return shown(series.moving_average(tables.daily_events(spark, sf_dir), 5, ["series"], fill_zero=False), 7)


@query("fill_zero", sql.statement([*sql.RETURNS, _DENSE], f"select model, bin, {day('date')}, {num('ret')} from dense"))
def fill_zero(spark, sf_dir):
    dense = series.with_all_months(tables.portfolio_returns(spark, sf_dir))
    return shown(dense.withColumn("ret", F.coalesce("ret", F.lit(0.0))))


@query(
    "market_ma",
    sql.statement(
        [sql.PANEL, "market as (select 1 as one, date, avg(ret) as ret from panel group by date)", ma_sql(12, "market", "one")],
        f"select {day('date')}, {nums('ret', 'ma')} from ma",
    ),
)
def market_ma(spark, sf_dir):
    return shown(series.market_moving_average(tables.panel(spark, sf_dir)))


@query("market_mean_by_date", sql.statement([sql.PANEL], f"select {day('date')}, {num('avg(ret)', 'ret')} from panel group by date"))
def market_mean_by_date(spark, sf_dir):
    return shown(series.market_mean(tables.panel(spark, sf_dir)))


_PATH = """path as (
  select *, 1 - value / max(value) over (partition by model, bin order by date) as drawdown
  from (select model, bin, date, ret, case when ret is not null then product(1 + ret) over (partition by model, bin order by date) end as value from returns)
)"""


@query("drawdown", sql.statement([*sql.RETURNS, _PATH], f"select model, bin, {num('max(drawdown) * 100', 'max_drawdown', 7)} from path group by 1, 2"))
def drawdown(spark, sf_dir):
    return shown(series.max_drawdown(tables.portfolio_returns(spark, sf_dir)), 7)


@query("drawdown_path", sql.statement([*sql.RETURNS, _PATH], f"select model, {day('date')}, {nums('value', 'drawdown', digits=8)} from path where bin = 'LS'"))
def drawdown_path(spark, sf_dir):
    ls = series.long_short_series(tables.portfolio_returns(spark, sf_dir))
    return shown(series.drawdown_path(ls).select("model", "date", "value", "drawdown"), 8)


@query(
    "sharpe",
    sql.statement(sql.RETURNS, f"select model, bin, {num('avg(ret) / nullif(stddev_samp(ret), 0) * sqrt(12.0e0)', 'sharpe', 7)} from returns group by 1, 2"),
)
def sharpe(spark, sf_dir):
    return shown(series.sharpe(tables.portfolio_returns(spark, sf_dir)), 7)


@query(
    "ls_metrics",
    sql.statement(
        [*sql.RETURNS, _PATH],
        f"select model, {num('avg(ret) * 100', 'mean_pct', 7)}, {num('stddev_samp(ret) * 100', 'std_pct', 7)}, "
        f"{num('avg(ret) / nullif(stddev_samp(ret), 0) * sqrt(12.0e0)', 'sharpe', 7)}, {num('max(drawdown) * 100', 'max_drawdown', 7)} "
        "from path where bin = 'LS' group by model",
    ),
)
def ls_metrics(spark, sf_dir):
    return shown(series.model_metrics(tables.portfolio_returns(spark, sf_dir)), 7)


_AGAINST = [
    *sql.RETURNS,
    *sql.ZOO_PORTS,
    "both_series as (select 'Ridge' as series, date, ret from ls where model = 'Ridge' and date in (select date from zoo) "
    "union all select signalname, date, ret / 100 from zoo where date in (select date from ls where model = 'Ridge'))",
    sql.cumulated("both_series", "series"),
]


@query("ls_vs_zoo", sql.statement(_AGAINST, f"select series, {day('date')}, {num('value', digits=8)} from cumulated"))
def ls_vs_zoo(spark, sf_dir):
    return shown(series.against_zoo(tables.portfolio_returns(spark, sf_dir), "Ridge", tables.zoo(spark, sf_dir)), 8)


@query(
    "zoo_wide",
    sql.statement(
        sql.ZOO_PORTS,
        f"select {day('date')}, " + ", ".join(num(f"max(ret) filter (signalname = '{s}')", s) for s in tables.SIGNALS) + " from zoo group by date",
    ),
)
def zoo_wide(spark, sf_dir):
    from panelwise.sources.tables import zoo_returns_wide

    return shown(zoo_returns_wide(tables.zoo_portfolios(spark, sf_dir), tables.SIGNALS))


@query("zoo_select", sql.statement(sql.ZOO_PORTS, f"select signalname, {day('date')}, {num('ret')} from zoo where signalname in ('sig_qty', 'sig_price')"))
def zoo_select(spark, sf_dir):
    zoo = tables.zoo(spark, sf_dir)
    return shown(zoo.filter(F.col("signalname").isin("sig_qty", "sig_price")))


@query(
    "ls_unpivot",
    sql.statement([*_LS, sql.cumulated("ls_series", "model")], f"select {day('date')}, model as \"Model\", {num('value', '\"Return\"', 8)} from cumulated"),
)
def ls_unpivot(spark, sf_dir):
    return shown(series.ls_comparison(tables.portfolio_returns(spark, sf_dir)), 8)


@query(
    "ls_wide_melt",
    sql.statement(
        _LS,
        f"select {day('d.date', 'date')}, m.model as \"Model\", {num('ls.ret', '\"Return\"')} from (select distinct date from ls) d "
        "cross join (select distinct model from ls) m left join ls on ls.date = d.date and ls.model = m.model",
    ),
)
def ls_wide_melt(spark, sf_dir):
    ls = series.long_short_series(tables.portfolio_returns(spark, sf_dir))
    wide = ls.groupBy("date").pivot("model", list(tables.MODEL_SIGNALS)).agg(F.first("ret"))
    return shown(series.unpivot_series(wide))


@query("log_scale_hint", sql.statement([*sql.RETURNS, sql.cumulated("returns", "model, bin")], "select max(value) > 50 as log_scale from cumulated"))
def log_scale_hint(spark, sf_dir):
    return series.wants_log_scale(series.cumulative(tables.portfolio_returns(spark, sf_dir)))


@query("date_range", sql.statement(sql.RETURNS, "select strftime(min(date), '%Y-%m-%d') as first_date, strftime(max(date), '%Y-%m-%d') as last_date from returns"))
def date_range(spark, sf_dir):
    return shown(series.date_range(tables.portfolio_returns(spark, sf_dir)))


def alpha_sql(spec: str, source: str = "returns") -> list[str]:
    """Alpha and t by taking one factor after the other out of the return, the constant and the later factors."""
    names = alphas.SIX_SPECS[spec]
    tag = "".join(c for c in spec if c.isalnum()).lower()
    quoted = [f'f."{f}"' for f in names]
    complete = "".join(f" and {q} is not null" for q in quoted)
    steps = [
        f"{tag}_0 as (select r.model, r.bin, r.ret * 100 - f.\"RF\" as y, 1.0e0 as o"
        + "".join(f", {q} as x{i}" for i, q in enumerate(quoted, 1))
        + f" from {source} r join factors f on f.date = r.date where r.ret is not null and f.\"RF\" is not null{complete})"
    ]
    k = len(names)
    for j in range(1, k + 1):
        left = ["y", "o"] + [f"x{i}" for i in range(j + 1, k + 1)]
        parts = ", ".join(f"{v} - x{j} * sum({v} * x{j}) over w / sum(x{j} * x{j}) over w as {v}" for v in left)
        steps.append(f"{tag}_{j} as (select model, bin, {parts} from {tag}_{j - 1} window w as (partition by model, bin))")
    steps.append(
        f"{tag} as (select model, bin, '{spec}' as factor_model, alpha, case when n > {k + 1} then alpha / nullif(sqrt(greatest(sse, 0) / (n - {k + 1}) / oo), 0) end as t_stat, n from ("
        f"select model, bin, count(*) as n, sum(o * o) as oo, case when count(*) > {k} then sum(y * o) / sum(o * o) end as alpha, sum(y * y) - sum(y * o) ^ 2 / sum(o * o) as sse from {tag}_{k} group by 1, 2))"
    )
    return steps


def _tag(spec: str) -> str:
    return "".join(c for c in spec if c.isalnum()).lower()


def _register_alpha(key: str, spec: str) -> None:
    select = f"select model, bin, factor_model, {nums('alpha', 't_stat', digits=6)}, n from {_tag(spec)}"

    @query(key, sql.statement([*sql.RETURNS, sql.FACTORS, *alpha_sql(spec)], select))
    def run(spark, sf_dir):
        found = alphas.factor_alphas(tables.portfolio_returns(spark, sf_dir), tables.factors(spark, sf_dir), {spec: alphas.SIX_SPECS[spec]})
        return shown(found.select("model", "bin", "factor_model", "alpha", "t_stat", "n"), 6)


for _key, _spec in {"alpha_raw": "r^e", "alpha_capm": "CAPM", "alpha_ff3": "FF3", "alpha_ff4": "FF4", "alpha_ff5": "FF5", "alpha_ff6": "FF6"}.items():
    _register_alpha(_key, _spec)

_ALL = [*sql.RETURNS, sql.FACTORS] + [part for s in alphas.SIX_SPECS for part in alpha_sql(s)]
_UNION = " union all ".join(f"select * from {_tag(s)}" for s in alphas.SIX_SPECS)


@query("alpha_models_ls", sql.statement([*_ALL, f"every as ({_UNION})"], f"select model, factor_model, {nums('alpha', 't_stat', digits=6)}, n from every where bin = 'LS'"))
def alpha_models_ls(spark, sf_dir):
    found = alphas.ls_alphas(tables.portfolio_returns(spark, sf_dir), tables.factors(spark, sf_dir))
    return shown(found.select("model", "factor_model", "alpha", "t_stat", "n"), 6)


@query("significant_alphas", sql.statement([*_ALL, f"every as ({_UNION})"], "select model, bin, factor_model, abs(t_stat) > 1.96 as significant from every"))
def significant_alphas(spark, sf_dir):
    found = alphas.factor_alphas(tables.portfolio_returns(spark, sf_dir), tables.factors(spark, sf_dir))
    return alphas.flag_significant(found).select("model", "bin", "factor_model", "significant")


@query(
    "alpha_capm_beta",
    sql.statement(
        [*sql.RETURNS, sql.FACTORS],
        f"select model, bin, {num('regr_intercept(r.ret * 100 - f.\"RF\", f.mkt_excess)', 'alpha', 6)}, "
        f"{num('regr_slope(r.ret * 100 - f.\"RF\", f.mkt_excess)', 'beta', 6)}, {num('regr_r2(r.ret * 100 - f.\"RF\", f.mkt_excess)', 'r2', 6)} "
        "from returns r join factors f on f.date = r.date where r.ret is not null group by 1, 2",
    ),
)
def alpha_capm_beta(spark, sf_dir):
    found = alphas.factor_alphas(tables.portfolio_returns(spark, sf_dir), tables.factors(spark, sf_dir), {"CAPM": ("mkt_excess",)})
    return shown(found.select("model", "bin", "alpha", F.col("beta_mkt_excess").alias("beta"), "r2"), 6)


_TABLE = [f"{m}_bin{b}" for m in tables.MODEL_SIGNALS for b in ("1", "2", "3", "4", "5", "LS")]


@query(
    "alpha_table",
    sql.statement(
        [*_ALL, f"every as ({_UNION})"],
        "select factor_model, metric, "
        + ", ".join(num(f"max(v) filter (portfolio = '{p}')", f'"{p}"', 6) for p in _TABLE)
        + " from (select factor_model, 'alpha' as metric, model || '_bin' || bin as portfolio, alpha as v from every "
        "union all select factor_model, 't-stat', model || '_bin' || bin, t_stat from every) group by 1, 2",
    ),
)
def alpha_table(spark, sf_dir):
    rets = nan_to_null(tables.portfolio_returns(spark, sf_dir))
    return shown(alphas.alpha_table(alphas.factor_alphas(rets, tables.factors(spark, sf_dir)), _TABLE), 6)
