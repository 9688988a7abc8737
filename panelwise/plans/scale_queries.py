"""The ways taken for large data, forced on these tables: each must give what its small twin gives, so the SQL is the same."""

from __future__ import annotations

from pyspark.sql import functions as F

from panelwise.functions.columns import to_long
from panelwise.operators import panel, portfolio, summary
from panelwise.operators.order_stats import exact_quantiles
from panelwise.operators.panel import shift_period
from panelwise.plans import oracle_parts as sql
from panelwise.plans import tables
from panelwise.plans.prep_queries import _SIGNALS, imputed_sql
from panelwise.plans.registry import ORACLES, day, nums, query, shown
from panelwise.prep.stages import fill_from_sums, period_sums
from panelwise.runtime import drop_staged, lookup_join, stage_table
from panelwise.sources.bucketed import entity_joins, write_bucketed

_GAPS = """gaps as (
  select permno, case when permno % 17 = 0 then null else date end as date, model,
         cast(floor(pred * 1000000) as bigint) + 1152921504606846976 as pred
  from predictions
)"""
_BINNED = sql.statement(
    [sql.PANEL, sql.PREDICTIONS, _GAPS, sql.bins("gaps", "bins")],
    f"select permno, {day('date')}, model, cast(pred as varchar) as pred, cast(bin as double) as bin from bins",
)


def _gaps(spark, sf_dir):
    """Whole-number predictions from 2^60 on, and rows without a date: a group of their own per model."""
    p = tables.predictions(spark, sf_dir)
    return p.select("permno", F.when(F.col("permno") % 17 != 0, F.col("date")).alias("date"), "model", (F.floor(F.col("pred") * 1000000).cast("long") + 2**60).alias("pred"))


def _binned(spark, sf_dir, **options):
    found = portfolio.assign_bins(_gaps(spark, sf_dir), **options)
    return shown(found.select("permno", "date", "model", F.col("pred").cast("string").alias("pred"), F.col("bin").cast("double").alias("bin")))


@query("assign_bins_gaps", _BINNED)
def assign_bins_gaps(spark, sf_dir):
    return _binned(spark, sf_dir)


@query("assign_bins_cuts", _BINNED)
def assign_bins_cuts(spark, sf_dir):
    """By cut values, found directly."""
    return _binned(spark, sf_dir, window_rows=0)


@query("assign_bins_brackets", _BINNED)
def assign_bins_brackets(spark, sf_dir):
    """By cut values, found in brackets."""
    return _binned(spark, sf_dir, window_rows=0, direct_rows=0)


@query("quantiles_brackets", ORACLES["quantile_bounds"])
def quantiles_brackets(spark, sf_dir):
    """Brackets that are cut again until a task sorts 20 values at most."""
    long = to_long(stage_table(tables.panel(spark, sf_dir).select(*_SIGNALS)), [], _SIGNALS, "column", "value")
    found = exact_quantiles(long, ["column"], "value", [0.0025, 0.5, 0.9975], direct_rows=0, segment_rows=20)
    return shown(found.select("column", *[F.get("quantiles", F.lit(i)).alias(n) for i, n in enumerate(("lower", "middle", "upper"))]), 7)


@query("lookup_shuffled", ORACLES["factors_lag_join"])
def lookup_shuffled(spark, sf_dir):
    """A lookup beyond the broadcast bound: staged, and joined by a shuffle."""
    joined = lookup_join(tables.returns(spark, sf_dir), shift_period(tables.factors(spark, sf_dir), "date", 1), ["date"], "left", max_bytes=1)
    return shown(joined.select("permno", "date", "ret", "mkt_excess", "SMB", "RF"))


@query("impute_by_join", sql.statement([sql.PANEL, imputed_sql("year(date)")], f"select permno, {day('date')}, {nums(*_SIGNALS, digits=7)} from imputed"))
def impute_by_join(spark, sf_dir):
    """Means joined instead of carried in the plan."""
    p = stage_table(tables.panel(spark, sf_dir).select("permno", "date", *_SIGNALS))
    sums, small = period_sums(p, _SIGNALS)
    return shown(fill_from_sums(p, _SIGNALS, sums, small, max_constants=0), 7)


@query(
    "join_row_counts",
    sql.statement(
        [sql.PANEL, sql.RAW_SIGNALS, sql.LAGGED_SIGNALS],
        "select 'left' as side, count(*) as rows from panel union all select 'right', count(*) from lagged "
        "union all select 'joined', count(*) from panel p join lagged l on l.permno = p.permno and l.date = p.date",
    ),
)
def join_row_counts(spark, sf_dir):
    return panel.join_row_counts(tables.returns(spark, sf_dir), panel.lag_signals(tables.raw_signals(spark, sf_dir)), ["permno", "date"])


@query("join_row_counts_observed", ORACLES["join_row_counts"])
def join_row_counts_observed(spark, sf_dir):
    """Counted by the join itself while its result is staged."""
    joined, counts = panel.counted_join(tables.returns(spark, sf_dir), panel.lag_signals(tables.raw_signals(spark, sf_dir)), panel.join_signals)
    drop_staged(stage_table(joined))
    return counts.table(spark)


@query("signals_shift_join_bucketed", ORACLES["signals_shift_join"])
def signals_shift_join_bucketed(spark, sf_dir):
    """Both sides stored by entity: the join itself shuffles and sorts nothing."""
    entity_joins(spark)
    returns = write_bucketed(tables.returns(spark, sf_dir), buckets=8)
    signals = write_bucketed(panel.lag_signals(tables.raw_signals(spark, sf_dir)), buckets=8)
    return shown(panel.join_signals(returns, signals))


@query("calendar_lag_bucketed", ORACLES["calendar_lag"])
def calendar_lag_bucketed(spark, sf_dir):
    stored = write_bucketed(tables.panel(spark, sf_dir, "l_partkey").select("permno", "date", "ret"), buckets=8)
    rows = portfolio.previous_in_entity(stored, ["permno"], "date", "ret", "previous_row")
    return shown(portfolio.previous_in_entity(rows, ["permno"], "date", "ret", "previous_month", calendar=True).drop("ret"))


@query("describe_brackets", ORACLES["describe_predictions"])
def describe_brackets(spark, sf_dir):
    """Quartiles through brackets, moments through pairs."""
    from panelwise.plans.panel_queries import _DESCRIBED

    return shown(summary.describe_columns(stage_table(tables.panel(spark, sf_dir).select(*_DESCRIBED)), _DESCRIBED, direct_rows=0), 7)


@query(
    "entities_from_sketches",
    sql.statement([sql.PART_PANEL], "select year(date) as year, count(distinct permno) as entities, true as close from part_panel group by 1"),
)
def entities_from_sketches(spark, sf_dir):
    """Sketches per month answer for years: within the stated error of the exact count beside them."""
    p = stage_table(tables.panel(spark, sf_dir, "l_partkey").select("permno", "date"))
    stored = stage_table(summary.entity_sketches(p, F.col("date"), "date"))
    about = summary.entities_from_sketches(stored, F.year("date"), "year").withColumnRenamed("entities", "about")
    both = summary.entities_per(p, F.year("date"), "year").join(about, "year")
    return both.select("year", "entities", (F.abs(F.col("about") - F.col("entities")) <= F.lit(summary.HLL_ERROR) * F.col("entities")).alias("close"))
