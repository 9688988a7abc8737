"""Assembling the panel: anchoring, filters, joins, samples, counts."""

from __future__ import annotations

from datetime import date as Date

from pyspark.sql import functions as F

from panelwise.functions import columns, dates
from panelwise.operators import panel, portfolio, series, summary
from panelwise.plans import oracle_parts as sql
from panelwise.plans import tables
from panelwise.plans.registry import day, num, nums, query, shown
from panelwise.runtime import key_duplicates, stage_table
from panelwise.sources import store

_SIG = ("sig_qty", "sig_tax", "sig_price", "sig_rare")


def _raw_returns(spark, sf_dir):
    items = tables.table(spark, sf_dir, "lineitem")
    return items.select(
        F.col("l_orderkey").alias("row"), F.col("l_linenumber").alias("line"), F.col("l_suppkey").alias("permno"),
        F.to_date("l_shipdate").alias("date"), (F.round(F.col("l_discount") * 100) - 5).alias("ret"),
    )


_RAW = "raw as (select l_orderkey as row, l_linenumber as line, l_suppkey as permno, cast(l_shipdate as date) as date, round(l_discount * 100) - 5 as ret from lineitem)"


@query("panel_month_anchor", sql.statement([_RAW], "select row, line, permno, strftime(make_date(year(date), month(date), 28), '%Y-%m-%d') as date, " + num("ret") + " from raw"))
def panel_month_anchor(spark, sf_dir):
    return shown(dates.anchor_month(_raw_returns(spark, sf_dir)))


@query(
    "panel_filter_from_year",
    sql.statement([_RAW], "select row, line, permno, strftime(make_date(year(date), month(date), 28), '%Y-%m-%d') as date, " + num("ret") + " from raw where ret is not null and year(date) >= 1998"),
)
def panel_filter_from_year(spark, sf_dir):
    return shown(panel.returns_panel(_raw_returns(spark, sf_dir), 1998))


_JOINED = [sql.PANEL, sql.RAW_SIGNALS, sql.LAGGED_SIGNALS,
           "joined as (select p.permno, p.date, p.ret, l.yyyymm_signals, l.sig_qty, l.sig_tax, l.sig_price, l.sig_rare from panel p join lagged l on l.permno = p.permno and l.date = p.date)"]


def _joined(spark, sf_dir):
    return panel.join_signals(tables.returns(spark, sf_dir), panel.lag_signals(tables.raw_signals(spark, sf_dir)))


@query("signals_shift_join", sql.statement(_JOINED, f"select permno, {day('date')}, {nums('ret', *_SIG)}, yyyymm_signals from joined"))
def signals_shift_join(spark, sf_dir):
    return shown(_joined(spark, sf_dir))


def _factor_join(lag: int) -> str:
    return sql.statement(
        [sql.PANEL, sql.FACTORS],
        f"select p.permno, {day('p.date', 'date')}, {num('p.ret', 'ret')}, {num('f.mkt_excess', 'mkt_excess')}, {num('f.\"SMB\"', '\"SMB\"')}, {num('f.\"RF\"', '\"RF\"')} "
        f"from panel p left join factors f on cast(f.date + interval ({lag}) month as date) = p.date",
    )


def _with_factors(spark, sf_dir, lag):
    joined = panel.join_factors(tables.returns(spark, sf_dir), tables.factors(spark, sf_dir), lag)
    return shown(joined.select("permno", "date", "ret", "mkt_excess", "SMB", "RF"))


@query("factors_lag_join", _factor_join(1))
def factors_lag_join(spark, sf_dir):
    return _with_factors(spark, sf_dir, 1)


@query("factors_lead_join", _factor_join(-1))
def factors_lead_join(spark, sf_dir):
    return _with_factors(spark, sf_dir, -1)


@query(
    "factors_outer_merge",
    sql.statement(
        [sql.FACTORS],
        f"""select strftime(coalesce(a.date, b.date), '%Y-%m-%d') as date, {num('a.mkt_excess', 'mkt_excess')}, {num('b."Mom"', '"Mom"')},
        case when b.date is null then 'left_only' when a.date is null then 'right_only' else 'both' end as _merge
        from (select * from factors where date < date '2001-03-01') a full outer join (select * from factors where date >= date '1996-01-01') b on a.date = b.date""",
    ),
)
def factors_outer_merge(spark, sf_dir):
    f = tables.factors(spark, sf_dir)
    a = f.filter(F.col("date") < F.lit(Date(2001, 3, 1))).select("date", "mkt_excess")
    b = f.filter(F.col("date") >= F.lit(Date(1996, 1, 1))).select("date", "Mom")
    return shown(panel.merge_factors(a, b, provenance=True))


@query(
    "entity_sample_intersect",
    sql.statement(
        [sql.PART_PANEL,
         "chosen as (select permno from (select permno from part_panel where date < date '1995-06-01' intersect select permno from part_panel where date >= date '2001-06-01') "
         "order by md5('123-' || cast(permno as varchar)), permno limit 100)"],
        f"select permno, {day('date')}, {num('ret')} from part_panel where permno in (select permno from chosen)",
    ),
)
def entity_sample_intersect(spark, sf_dir):
    p = tables.panel(spark, sf_dir, "l_partkey").select("permno", "date", "ret")
    chosen = panel.sample_entities(p, Date(1995, 6, 1), Date(2001, 6, 1), 100)
    return shown(panel.rows_of(p, chosen))


@query(
    "entity_ids_intersect",
    sql.statement([sql.PART_PANEL], "select permno from part_panel where date < date '1995-03-01' intersect select permno from part_panel where date >= date '2001-10-01'"),
)
def entity_ids_intersect(spark, sf_dir):
    p = tables.panel(spark, sf_dir, "l_partkey")
    early, late = panel.temporal_split(p, Date(1995, 2, 28))[0], p.filter(F.col("date") >= F.lit(Date(2001, 10, 1)))
    return early.select("permno").intersect(late.select("permno"))


_SHARE = "(6 - (sig_tax is null)::int - (sig_rare is null)::int) / 6.0e0"


def _lagged(spark, sf_dir):
    return panel.lag_signals(tables.raw_signals(spark, sf_dir)).drop("yyyymm_signals")


@query("completeness_filter", sql.statement(_JOINED[:3], f"select permno, {day('date')}, {nums(*_SIG)} from lagged where {_SHARE} >= 0.8"))
def completeness_filter(spark, sf_dir):
    return shown(panel.completeness_filter(_lagged(spark, sf_dir), 0.8))


@query(
    "rows_kept_share",
    sql.statement(_JOINED[:3], f"select count(*) filter ({_SHARE} >= 0.8) as kept, count(*) as total, {num(f'1 - count(*) filter ({_SHARE} >= 0.8) / count(*)', 'dropped_share')} from lagged"),
)
def rows_kept_share(spark, sf_dir):
    return shown(panel.kept_rows(_lagged(spark, sf_dir), 0.8))


_COLS = ("permno", "date", *_SIG)


@query(
    "sparse_column_report",
    sql.statement(
        _JOINED[:3],
        " union all ".join(f"select '{c}' as \"column\", {num(f'avg(({c} is null)::int)', 'null_share')}, avg(({c} is null)::int) > 0.9 as dropped from lagged" for c in _COLS),
    ),
)
def sparse_column_report(spark, sf_dir):
    return shown(panel.null_shares(_lagged(spark, sf_dir))).withColumn("dropped", F.col("null_share") > 0.9)


@query("drop_sparse_columns", sql.statement([sql.PANEL], f"select permno, {day('date')}, {nums('ret', 'sig_qty', 'sig_tax', 'sig_price')} from panel"))
def drop_sparse_columns(spark, sf_dir):
    p = tables.panel(spark, sf_dir).select("permno", "date", "ret", *_SIG)
    train, _ = panel.temporal_split(p, Date(1999, 12, 28))
    return shown(panel.drop_sparse(p, 0.9, fit_on=train, keep=["permno", "date", "ret"]))


@query(
    "holdout_counts",
    sql.statement([sql.PANEL], "select case when date <= date '2000-12-28' then 'train' else 'test' end as part, year(date) as year, count(*) as n from panel group by 1, 2"),
)
def holdout_counts(spark, sf_dir):
    train, test = panel.temporal_split(tables.returns(spark, sf_dir), Date(2000, 12, 28))
    labelled = train.withColumn("part", F.lit("train")).unionByName(test.withColumn("part", F.lit("test")))
    return labelled.groupBy("part", F.year("date").alias("year")).agg(F.count(F.lit(1)).alias("n"))


@query("train_rows_by_year", sql.statement([sql.PANEL], "select year(date) as year, count(*) as n from panel where year(date) < 2000 group by 1"))
def train_rows_by_year(spark, sf_dir):
    train = panel.training_window(tables.returns(spark, sf_dir), Date(2000, 1, 1))
    return summary.rows_per(train, F.year("date"), "year")


@query(
    "rolling_window_rows",
    sql.statement([sql.PANEL], "select strftime(date, '%Y-%m') as month, count(*) as n from panel where date >= date '1999-01-28' and date < date '2000-01-28' group by 1"),
)
def rolling_window_rows(spark, sf_dir):
    train = panel.training_window(tables.returns(spark, sf_dir), Date(2000, 1, 28), months=12)
    return summary.rows_per(train, dates.month_label(F.col("date")), "month")


@query("entities_per_period", sql.statement([_RAW], "select year(date) as year, count(distinct permno) as entities from raw group by 1"))
def entities_per_period(spark, sf_dir):
    return summary.entities_per(_raw_returns(spark, sf_dir), F.year("date"), "year")


@query("entities_per_month", sql.statement([_RAW], "select strftime(date, '%Y-%m') as month, count(distinct permno) as entities from raw group by 1"))
def entities_per_month(spark, sf_dir):
    return summary.entities_per(_raw_returns(spark, sf_dir), dates.month_label(F.col("date")), "month")


_DESCRIBED = ("ret", "sig_qty", "sig_tax", "sig_price")


def _describe_sql(c: str) -> str:
    quartiles = ", ".join(num(f"quantile_cont({c}, {q})", n, 7) for q, n in ((0.25, "q25"), (0.5, "q50"), (0.75, "q75")))
    return (
        f"select '{c}' as \"column\", count({c}) as count, {num(f'avg({c})', 'mean', 7)}, {num(f'stddev_samp({c})', 'std', 7)}, "
        f"{num(f'min({c})', 'min', 7)}, {quartiles}, {num(f'max({c})', 'max', 7)} from panel"
    )


@query("describe_predictions", sql.statement([sql.PANEL], " union all ".join(_describe_sql(c) for c in _DESCRIBED)))
def describe_predictions(spark, sf_dir):
    return shown(summary.describe_columns(stage_table(tables.panel(spark, sf_dir).select(*_DESCRIBED)), _DESCRIBED), 7)


@query(
    "column_moments",
    "select 'l_quantity' as \"column\", count(l_quantity) as count, round(avg(l_quantity), 6) as mean, round(stddev_samp(l_quantity), 6) as std, min(l_quantity) as min, max(l_quantity) as max from lineitem "
    "union all select 'l_extendedprice', count(l_extendedprice), round(avg(l_extendedprice), 6), round(stddev_samp(l_extendedprice), 6), min(l_extendedprice), max(l_extendedprice) from lineitem",
)
def column_moments(spark, sf_dir):
    return shown(summary.column_moments(tables.table(spark, sf_dir, "lineitem"), ["l_quantity", "l_extendedprice"]), 6)


@query("column_info", sql.statement([sql.PANEL], " union all ".join(f"select '{c}' as \"column\", '{t}' as type, count({c}) as present from panel" for c, t in (("permno", "bigint"), ("date", "date"), ("sig_tax", "double"), ("disc_flag", "string")))))
def column_info(spark, sf_dir):
    return summary.column_info(tables.panel(spark, sf_dir).select("permno", "date", "sig_tax", "disc_flag"))


@query("key_duplicates", sql.statement([_RAW], f"select permno, {day('date')}, count(*) as n from raw group by permno, date having count(*) > 1"))
def duplicated_keys(spark, sf_dir):
    return shown(key_duplicates(_raw_returns(spark, sf_dir), ["permno", "date"]))


@query(
    "next_period_relabel",
    sql.statement([sql.PART_PANEL], f"select permno, strftime(lead(date) over (partition by permno order by date), '%Y-%m-%d') as date, {num('sig_qty')} from part_panel"),
)
def next_period_relabel(spark, sf_dir):
    p = tables.panel(spark, sf_dir, "l_partkey").select("permno", "date", "sig_qty")
    return shown(panel.relabel_next(p, "permno", "date"))


@query(
    "calendar_lag",
    sql.statement(
        [sql.PART_PANEL],
        f"select permno, {day('date')}, {num('lag(ret) over w', 'previous_row')}, "
        f"{num('case when lag(date) over w = date - interval 1 month then lag(ret) over w end', 'previous_month')} from part_panel window w as (partition by permno order by date)",
    ),
)
def calendar_lag(spark, sf_dir):
    p = tables.panel(spark, sf_dir, "l_partkey").select("permno", "date", "ret")
    rows = portfolio.previous_in_entity(p, ["permno"], "date", "ret", "previous_row")
    both = portfolio.previous_in_entity(rows, ["permno"], "date", "ret", "previous_month", calendar=True)
    return shown(both.drop("ret"))


@query(
    "timeline_labels",
    sql.statement(
        [sql.PANEL],
        f"select {day('date')}, case when date < date '1996-01-28' then 'Past' when date < date '2000-01-28' then 'Train' when date = date '2000-01-28' then 'Predict' else 'Future' end as \"set\" from (select distinct date from panel)",
    ),
)
def timeline_labels(spark, sf_dir):
    months = tables.panel(spark, sf_dir).select("date").distinct()
    return shown(panel.timeline_labels(months, Date(1996, 1, 28), Date(2000, 1, 28)))


_TOY = [
    sql.PANEL,
    "lagged_toy as (select permno, lead(date) over (partition by permno order by date) as date, sig_qty from panel)",
    "toy as (select p.permno, p.date, p.ret, l.sig_qty as pred, 'toy' as model from panel p left join lagged_toy l on l.permno = p.permno and l.date = p.date)",
]


def _toy(spark, sf_dir):
    p = tables.panel(spark, sf_dir)
    joined = panel.join_lagged(p.select("permno", "date", "ret"), p.select("permno", "date", "sig_qty"), "permno", "date")
    return joined.select("permno", "date", "ret", F.col("sig_qty").alias("pred"), F.lit("toy").alias("model"))


@query("toy_left_join", sql.statement(_TOY, f"select permno, {day('date')}, {nums('ret', 'pred')} from toy"))
def toy_left_join(spark, sf_dir):
    return shown(_toy(spark, sf_dir).drop("model"))


@query("drop_missing_rows", sql.statement(_TOY, f"select permno, {day('date')}, {nums('ret', 'pred')} from toy where pred is not null"))
def drop_missing_rows(spark, sf_dir):
    return shown(_toy(spark, sf_dir).drop("model").dropna(subset=["pred"]))


_TOY_BINS = [*_TOY, "toy_known as (select * from toy where pred is not null)", sql.bins("toy_known", "toy_bins", 2), sql.stats("toy_bins", "toy_stats"), sql.long_short("toy_stats", "toy_ls")]


def _toy_stats(spark, sf_dir):
    return portfolio.portfolio_stats(portfolio.assign_bins(_toy(spark, sf_dir).dropna(subset=["pred"]), 2))


@query("toy_two_bin", sql.statement(_TOY_BINS, f"select {day('date')}, {num('ret')} from toy_ls"))
def toy_two_bin(spark, sf_dir):
    return shown(portfolio.long_short(_toy_stats(spark, sf_dir)).drop("model"))


@query(
    "toy_portfolios_wide",
    sql.statement(
        _TOY_BINS,
        f"select strftime(date, '%Y-%m') as month, {num('max(ret) filter (bin = 1)', '\"Portfolio1\"')}, {num('max(ret) filter (bin = 2)', '\"Portfolio2\"')}, "
        f"{num('max(ret) filter (bin = 2) - max(ret) filter (bin = 1)', '\"Long-Short\"')} from toy_stats group by date",
    ),
)
def toy_portfolios_wide(spark, sf_dir):
    named = _toy_stats(spark, sf_dir).withColumn("bin", F.concat(F.lit("Portfolio"), F.col("bin").cast("string")))
    wide = named.groupBy(dates.month_label(F.col("date")).alias("month")).pivot("bin", ["Portfolio1", "Portfolio2"]).agg(F.first("ret"))
    return shown(wide.withColumn("Long-Short", F.col("Portfolio2") - F.col("Portfolio1")))


@query(
    "predicted_rows_only",
    sql.statement(_TOY, f"select permno, {day('date')}, " + num("case when date >= date '2000-01-28' then pred end", "prediction") + " from toy"),
)
def predicted_rows_only(spark, sf_dir):
    marked = panel.predicted_only(_toy(spark, sf_dir), F.col("date") >= F.lit(Date(2000, 1, 28)), F.col("pred"))
    return shown(marked.select("permno", "date", "prediction"))


@query(
    "prediction_upsert",
    sql.statement(
        [sql.PANEL, sql.PREDICTIONS,
         "every as materialized (select * from predictions)",
         "new as (select permno, date, model, ret, pred * 2 as pred from every where model = 'LassoCV' and date >= date '2000-01-01')",
         "merged as (select permno, date, model, ret, pred from every o where date < date '2001-01-01' "
         "and not exists (select 1 from new n where n.permno = o.permno and n.date = o.date and n.model = o.model) union all select * from new)"],
        f"select permno, {day('date')}, model, {nums('ret', 'pred')} from merged",
    ),
)
def prediction_upsert(spark, sf_dir):
    every = tables.predictions(spark, sf_dir)
    old = every.filter(F.col("date") < F.lit(Date(2001, 1, 1)))
    new = every.filter((F.col("model") == "LassoCV") & (F.col("date") >= F.lit(Date(2000, 1, 1)))).withColumn("pred", F.col("pred") * 2)
    return shown(store.upsert_predictions(new, old))


_WIDE_PREDICTIONS = ", ".join(num(f"max(pred) filter (model = '{m}')", f'"pred_{m}"') for m in tables.MODEL_SIGNALS)


@query("predictions_wide", sql.statement([sql.PANEL, sql.PREDICTIONS], f"select permno, {day('date')}, {num('ret')}, {_WIDE_PREDICTIONS} from predictions group by permno, date, ret"))
def predictions_wide(spark, sf_dir):
    return shown(store.predictions_wide(tables.predictions(spark, sf_dir), list(tables.MODEL_SIGNALS)))


_PRED_RIDGE = "a as (select permno, date, ret, pred as \"pred_Ridge\" from predictions where model = 'Ridge' and date < date '2001-01-01')"
_PRED_MLP = "b as (select permno, date, ret, pred as \"pred_mlp-64-32\" from predictions where model = 'mlp-64-32' and date >= date '1996-01-01')"


@query(
    "predictions_merge_wide",
    sql.statement(
        [sql.PANEL, sql.PREDICTIONS, _PRED_RIDGE, _PRED_MLP],
        f"select coalesce(a.permno, b.permno) as permno, strftime(coalesce(a.date, b.date), '%Y-%m-%d') as date, {num('coalesce(a.ret, b.ret)', 'ret')}, "
        f"{num('a.\"pred_Ridge\"', '\"pred_Ridge\"')}, {num('b.\"pred_mlp-64-32\"', '\"pred_mlp-64-32\"')} "
        "from a full outer join b on a.permno = b.permno and a.date = b.date and a.ret = b.ret",
    ),
)
def predictions_merge_wide(spark, sf_dir):
    every = tables.predictions(spark, sf_dir)
    a = every.filter((F.col("model") == "Ridge") & (F.col("date") < F.lit(Date(2001, 1, 1)))).select("permno", "date", "ret", F.col("pred").alias("pred_Ridge"))
    b = every.filter((F.col("model") == "mlp-64-32") & (F.col("date") >= F.lit(Date(1996, 1, 1)))).select("permno", "date", "ret", F.col("pred").alias("pred_mlp-64-32"))
    return shown(store.merge_wide_predictions([a, b]))


_ORDERED = ["l_orderkey", "l_linenumber", "l_partkey", "l_extendedprice", "l_quantity"]


@query(
    "prediction_dedupe",
    f"select permno, {day('date')}, {', '.join(_ORDERED)} from (select l_suppkey as permno, make_date(year(l_shipdate), month(l_shipdate), 28) as date, {', '.join(_ORDERED)}, "
    f"row_number() over (partition by l_suppkey, year(l_shipdate), month(l_shipdate) order by {', '.join(_ORDERED)}) as nth from lineitem) where nth = 1",
)
def prediction_dedupe(spark, sf_dir):
    items = tables.table(spark, sf_dir, "lineitem")
    rows = items.select(F.col("l_suppkey").alias("permno"), dates.month_anchor(F.col("l_shipdate")).alias("date"), *_ORDERED)
    return shown(panel.keep_first(rows, ["permno", "date"], _ORDERED))


@query("distinct_pairs", "select distinct l_returnflag, l_linestatus from lineitem")
def distinct_pairs(spark, sf_dir):
    return tables.table(spark, sf_dir, "lineitem").select("l_returnflag", "l_linestatus").distinct()


@query("distinct_models", sql.statement([sql.PANEL, sql.PREDICTIONS], "select model from (select distinct model from predictions)"))
def distinct_models(spark, sf_dir):
    return summary.model_names(tables.predictions(spark, sf_dir))


@query("default_models", sql.statement([sql.PANEL, sql.PREDICTIONS], "select distinct model from predictions order by model limit 3"))
def default_models(spark, sf_dir):
    return summary.default_models(tables.predictions(spark, sf_dir), 3)


@query("entity_union", "select 'supplier' as kind, s_nationkey as nation, count(*) as n from supplier group by 2 union all select 'customer', c_nationkey, count(*) from customer group by 2")
def entity_union(spark, sf_dir):
    s = tables.table(spark, sf_dir, "supplier").select(F.lit("supplier").alias("kind"), F.col("s_nationkey").alias("nation"))
    c = tables.table(spark, sf_dir, "customer").select(F.lit("customer").alias("kind"), F.col("c_nationkey").alias("nation"))
    return s.unionByName(c).groupBy("kind", "nation").agg(F.count(F.lit(1)).alias("n"))


@query(
    "top_models",
    sql.statement(sql.RETURNS, f"select model, {num('sharpe', digits=7)} from (select model, avg(ret) / stddev_samp(ret) * sqrt(12.0e0) as sharpe from ls group by 1) order by abs(sharpe) desc, model limit 2"),
)
def top_models(spark, sf_dir):
    ranked = series.sharpe(series.long_short_series(tables.portfolio_returns(spark, sf_dir)), ["model"])
    return shown(ranked.orderBy(F.abs("sharpe").desc(), "model").limit(2), 7)


@query(
    "member_flag",
    sql.statement([sql.PANEL], f"select permno, {day('date')}, permno in (select s_suppkey from supplier where s_acctbal > 5000) as is_member from panel"),
)
def member_flag(spark, sf_dir):
    rich = tables.table(spark, sf_dir, "supplier").filter("s_acctbal > 5000").select(F.col("s_suppkey").alias("permno"))
    return shown(panel.member_flag(tables.panel(spark, sf_dir).select("permno", "date"), rich, ["permno"]))


@query(
    "period_labels",
    sql.statement(
        [sql.PANEL],
        "select distinct strftime(date, '%Y-%m') as month, strftime(date, '%Y-%m-01') as first_day, 'ret_' || strftime(date, '%Y') || '_bin' || cast(month(date) as varchar) as label, "
        "replace(strftime(date, '%Y-%m'), '-', '') as yyyymm, split_part(strftime(date, '%Y-%m'), '-', 2) as part from panel",
    ),
)
def period_labels(spark, sf_dir):
    month = dates.month_label(F.col("date"))
    return tables.panel(spark, sf_dir).select("date").distinct().select(
        month.alias("month"),
        F.date_format("date", "yyyy-MM-01").alias("first_day"),
        F.concat(F.lit("ret_"), F.date_format("date", "yyyy"), F.lit("_bin"), F.month("date").cast("string")).alias("label"),
        F.replace(month, F.lit("-"), F.lit("")).alias("yyyymm"),
        F.get(F.split(month, "-"), F.lit(1)).alias("part"),
    )


@query(
    "number_scaling",
    sql.statement(
        [sql.PANEL],
        f"select permno, {day('date')}, {num('ret / 100', 'decimal')}, {num('ret / 100 * 100', 'percent')}, {num('least(greatest(ret, -2.0e0), 2.0e0)', 'clipped')}, "
        f"{num('sqrt(abs(ret))', 'root')}, cast(ceil(sig_qty) as bigint) as above, {num('case when sig_tax is not null then least(greatest(sig_tax, 2.0e0), 6.0e0) end', 'clipped_tax')} from panel",
    ),
)
def number_scaling(spark, sf_dir):
    p = tables.panel(spark, sf_dir)
    scaled = columns.scale_columns(p.withColumn("decimal", F.col("ret")), ["decimal"], divide=100)
    return shown(
        scaled.select(
            "permno",
            "date",
            "decimal",
            (F.col("decimal") * 100).alias("percent"),
            columns.clip(F.col("ret"), F.lit(-2.0), F.lit(2.0)).alias("clipped"),
            F.sqrt(F.abs("ret")).alias("root"),
            F.ceil("sig_qty").alias("above"),
            columns.clip(F.col("sig_tax"), F.lit(2.0), F.lit(6.0)).alias("clipped_tax"),
        )
    )
