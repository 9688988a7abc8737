"""Preprocessing stages on the derived panel."""

from __future__ import annotations

from datetime import date as Date

from pyspark.ml.functions import vector_to_array
from pyspark.sql import functions as F

from panelwise.operators.order_stats import exact_quantiles
from panelwise.operators.panel import join_factors, training_window
from panelwise.functions.columns import to_long
from panelwise.plans import oracle_parts as sql
from panelwise.plans import tables
from panelwise.plans.registry import day, num, nums, query, shown
from panelwise.prep.pipeline import build_preprocessor, column_routes, feature_names, fit_prepare, route_columns
from panelwise.prep.stages import CrossSectionalImputer, ModeImputer, OneHot, PopScaler, Winsorizer, one_hot_vector
from panelwise.runtime import stage_table

_SIGNALS = ["sig_qty", "sig_tax", "sig_price", "sig_rare"]
TRAIN_BEFORE = Date(2000, 1, 1)


def _panel(spark, sf_dir, *more):
    """Fitting and applying a stage read the panel several times, so it is staged."""
    return stage_table(tables.panel(spark, sf_dir).select("permno", "date", *(more or _SIGNALS)))


def _train(df):
    return training_window(df, TRAIN_BEFORE)


def imputed_sql(period: str, source: str = "panel", name: str = "imputed") -> str:
    fills = ", ".join(f"coalesce({c}, avg({c}) over (partition by {period}), avg({c}) over (), 0.0e0) as {c}" for c in _SIGNALS)
    return f"{name} as (select permno, date, {fills} from {source})"


@query("impute_year_mean", sql.statement([sql.PANEL, imputed_sql("year(date)")], f"select permno, {day('date')}, {nums(*_SIGNALS, digits=7)} from imputed"))
def impute_year_mean(spark, sf_dir):
    return shown(CrossSectionalImputer(inputCols=_SIGNALS).transform(_panel(spark, sf_dir)), 7)


@query("impute_month_mean", sql.statement([sql.PANEL, imputed_sql("date")], f"select permno, {day('date')}, {nums(*_SIGNALS, digits=7)} from imputed"))
def impute_month_mean(spark, sf_dir):
    return shown(CrossSectionalImputer(inputCols=_SIGNALS, by="date").transform(_panel(spark, sf_dir)), 7)


_BOUNDS = "bounds as (select " + ", ".join(f"quantile_cont({c}, {q}) as {c}_{n}" for c in _SIGNALS for q, n in ((0.0025, "lo"), (0.9975, "hi"))) + " from panel where date < date '2000-01-01')"
_CLIPPED = ", ".join(num(f"case when {c} is not null then least(greatest({c}, {c}_lo), {c}_hi) end", c, 7) for c in _SIGNALS)


@query("winsorize", sql.statement([sql.PANEL, _BOUNDS], f"select permno, {day('date')}, {_CLIPPED} from panel cross join bounds"))
def winsorize(spark, sf_dir):
    p = _panel(spark, sf_dir)
    return shown(Winsorizer(inputCols=_SIGNALS).fit(_train(p)).transform(p), 7)


@query(
    "quantile_bounds",
    sql.statement([sql.PANEL], " union all ".join(
        f"select '{c}' as \"column\", {num(f'quantile_cont({c}, 0.0025)', 'lower', 7)}, {num(f'quantile_cont({c}, 0.5)', 'middle', 7)}, {num(f'quantile_cont({c}, 0.9975)', 'upper', 7)} from panel" for c in _SIGNALS)),
)
def quantile_bounds(spark, sf_dir):
    long = to_long(_panel(spark, sf_dir), [], _SIGNALS, "column", "value")
    found = exact_quantiles(long, ["column"], "value", [0.0025, 0.5, 0.9975])
    return shown(found.select("column", *[F.get("quantiles", F.lit(i)).alias(n) for i, n in enumerate(("lower", "middle", "upper"))]), 7)


_SCALED = ", ".join(num(f"({c} - {c}_m) / case when {c}_d = 0 then 1 else {c}_d end", c, 7) for c in _SIGNALS)


@query(
    "standardize_pop",
    sql.statement(
        [sql.PANEL, "moments as (select " + ", ".join(f"avg({c}) as {c}_m, stddev_pop({c}) as {c}_d" for c in _SIGNALS) + " from panel where date < date '2000-01-01')"],
        f"select permno, {day('date')}, {_SCALED} from panel cross join moments",
    ),
)
def standardize_pop(spark, sf_dir):
    p = _panel(spark, sf_dir)
    return shown(PopScaler(inputCols=_SIGNALS).fit(_train(p)).transform(p), 7)


_DISCRETE = ["disc_flag", "disc_line"]
_MODES = "modes as (select " + ", ".join(
    f"(select {c} from panel where date < date '2000-01-01' and {c} is not null group by 1 order by count(*) desc, 1 limit 1) as {c}_mode" for c in _DISCRETE
) + ")"


@query("mode_impute", sql.statement([sql.PANEL, _MODES], f"select permno, {day('date')}, coalesce(disc_flag, disc_flag_mode) as disc_flag, coalesce(disc_line, disc_line_mode) as disc_line from panel cross join modes"))
def mode_impute(spark, sf_dir):
    p = _panel(spark, sf_dir, *_DISCRETE)
    return shown(ModeImputer(inputCols=_DISCRETE).fit(_train(p)).transform(p))


_LEVELS = {"disc_flag": ["'A'", "'N'", "'R'"], "disc_line": ["0.0e0", "1.0e0"]}
_HOT = ", ".join(
    f"case when coalesce({c} = {v}, false) then 1.0e0 else 0.0e0 end as {c}_{v.strip(chr(39)).removesuffix('.0e0')}" for c, vs in _LEVELS.items() for v in vs if v != "'R'"
)


@query("one_hot_ignore", sql.statement([sql.PANEL], f"select permno, {day('date')}, {_HOT} from panel"))
def one_hot_ignore(spark, sf_dir):
    """Learned without flag R, whose rows then get zeros in every flag column."""
    p = _panel(spark, sf_dir, *_DISCRETE)
    learned = p.withColumn("disc_flag", F.when(F.col("disc_flag") != "R", F.col("disc_flag")))
    return shown(OneHot(inputCols=_DISCRETE).fit(learned).transform(p).drop(*_DISCRETE))


def _doc(spark, sf_dir):
    """The form of each signal, as a documentation table would give it."""
    columns = tables.panel(spark, sf_dir).columns
    rows = [(c, "continuous" if c.startswith("sig_") else "discrete") for c in columns if c.startswith(("sig_", "disc_"))]
    return spark.createDataFrame(rows, "Acronym string, `Cat.Form` string")


_NUMBERS = ("sig_qty", "sig_tax", "sig_price", "sig_step", "sig_rare", "mkt_excess", "SMB", "HML", "RMW", "CMA", "Mom")
_FILLED = {"disc_flag": ("A", "N", "R"), "disc_line": ("0", "1")}
_FILLED_TRAIN = "filled_train as (select coalesce(disc_flag, disc_flag_mode) as disc_flag, coalesce(disc_line, disc_line_mode) as disc_line from panel cross join modes where date < date '2000-01-01')"


@query(
    "feature_matrix_columns",
    sql.statement(
        [sql.PANEL, _MODES, _FILLED_TRAIN],
        " union all ".join(
            [f"select '{c}' as feature, count(*) as n, 0.0e0 as mean, 1.0e0 as std from filled_train" for c in _NUMBERS]
            + [
                f"select '{c}_{v}', count(*), {num(f'avg(({c} = {v!r})::int)', 'mean', 6)}, {num(f'stddev_pop(({c} = {v!r})::int)', 'std', 6)} from filled_train"
                for c, levels in _FILLED.items()
                for v in levels
            ]
        ),
    ),
)
def feature_matrix_columns(spark, sf_dir):
    """Which feature columns the fitted preprocessing produces, and how each is distributed in training."""
    p = stage_table(join_factors(tables.panel(spark, sf_dir), tables.factors(spark, sf_dir)))
    continuous, discrete = route_columns(p, _doc(spark, sf_dir))
    fitted, prepared = fit_prepare(build_preprocessor(continuous, discrete), _train(p))
    names = feature_names(fitted)
    values = to_long(prepared.select(*[F.col(c).cast("double").alias(c) for c in names]), [], names, "feature", "value")
    return shown(values.groupBy("feature").agg(F.count("value").alias("n"), F.avg("value").alias("mean"), F.stddev_pop("value").alias("std")), 6)


@query(
    "column_routes",
    " union all ".join(f"select 'numbers' as transformer, '{c}' as \"column\"" for c in _NUMBERS)
    + "".join(f" union all select 'categoricals', '{c}'" for c in _FILLED),
)
def routed_columns(spark, sf_dir):
    p = stage_table(join_factors(tables.panel(spark, sf_dir), tables.factors(spark, sf_dir)))
    fitted, _ = fit_prepare(build_preprocessor(*route_columns(p, _doc(spark, sf_dir))), _train(p))
    return column_routes(fitted)


@query(
    "one_hot_vector",
    "with seen as (select p_type as t from part where p_size <= 25 group by 1), ordered as (select t, row_number() over (order by t) - 1 as i from seen) "
    "select p_partkey, cast(o.i as int) as hot from part p left join ordered o on o.t = p.p_type",
)
def one_hot_sparse(spark, sf_dir):
    """Levels learned from small parts; the place of each part's level, none for levels only large parts have."""
    part = tables.table(spark, sf_dir, "part")
    coded = one_hot_vector(["p_type"], "hot").fit(part.filter("p_size <= 25")).transform(part)
    values = vector_to_array("hot")
    return coded.select("p_partkey", F.nullif(F.array_position(values, 1.0).cast("int"), F.lit(0)).alias("at")).select("p_partkey", (F.col("at") - 1).alias("hot"))
