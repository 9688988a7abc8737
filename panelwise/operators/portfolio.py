"""Ranked portfolios: bins, their returns and statistics, long-short returns, turnover.

Long forms: ``predictions(permno, date, ret, model, pred)``, ``bins = predictions + bin``,
``portfolio_returns(model, bin, date, ret)`` with ``bin`` a string in ``'1'..'N','LS'``.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelwise.functions.columns import float_columns, nan_to_null, ratio, to_long
from panelwise.operators.order_stats import GROUP_ROWS, group_sizes, order_statistics
from panelwise.runtime import col, largest_of, lookup_join, only, pocket

LONG_SHORT = "LS"


def predictions_long(wide: DataFrame, models: Sequence[str] | None = None, ids: Sequence[str] = ("permno", "date", "ret")) -> DataFrame:
    """One row per (entity, month, model) from a table with ``pred_<model>`` columns."""
    models = [c[len("pred_"):] for c in wide.columns if c.startswith("pred_")] if models is None else models
    long = to_long(wide, list(ids), [f"pred_{m}" for m in models], "model", "pred")
    return long.withColumn("model", F.substr("model", F.lit(len("pred_") + 1)))


def assign_bins(
    predictions: DataFrame,
    nport: int = 5,
    by: Sequence[str] = ("model", "date"),
    pred: str = "pred",
    window_rows: int | None = None,
    direct_rows: int | None = None,
) -> DataFrame:
    """Add ``bin`` = ceil(rank * nport / (n + 1)) within each group, ties sharing the lowest rank.

    ``n`` counts all rows of the group, also those without a prediction, which get no bin.

    While no group exceeds ``window_rows`` rows this is a plain window rank. Beyond that, a value
    reaches bin b exactly when it exceeds the k-th smallest value, k = floor((b - 1)(n + 1) / nport),
    so a group needs only ``nport - 1`` cut values; the rows themselves are then neither shuffled nor
    sorted but compared with the cuts of their group.
    """
    predictions = nan_to_null(predictions, [pred]) if pred in float_columns(predictions) else predictions
    sizes = group_sizes(predictions, by, pred)
    if largest_of(sizes[0], "n") <= (GROUP_ROWS if window_rows is None else window_rows):
        group = Window.partitionBy(*by)
        rank = F.rank().over(group.orderBy(F.col(pred).asc_nulls_last()))
        spread = F.ceil(rank * F.lit(nport) / (F.count(F.lit(1)).over(group) + 1))
        return predictions.withColumn("bin", F.when(F.col(pred).isNotNull(), spread.cast("int")))
    if nport == 1:
        return predictions.withColumn("bin", F.when(F.col(pred).isNotNull(), F.lit(1)))

    def ranks(n: Column, m: Column) -> list[Column]:
        return [F.floor(F.lit(b - 1) * (n + 1) / F.lit(nport)) for b in range(2, nport + 1)]

    found = order_statistics(predictions, by, pred, ranks, direct_rows, sizes=sizes)
    group, cuts = "_group", F.struct("m", "ranks", "stats").alias("_cuts")
    found = found.select(F.struct(*[col(c) for c in by]).alias(group), cuts)
    marked = lookup_join(predictions.withColumn(group, F.struct(*[col(c) for c in by])), found, [group], "left")
    missing = F.raise_error(F.lit("a group has no cut values")).cast("int")
    reached = F.when(F.col("_cuts").isNull(), missing).otherwise(F.lit(1))
    for i in range(nport - 1):
        # A rank of 0 is exceeded by every value, a rank above m by none.
        rank, cut = F.get("_cuts.ranks", F.lit(i)), F.get("_cuts.stats", F.lit(i))
        reached = reached + F.when(rank < 1, 1).when(rank > F.col("_cuts.m"), 0).otherwise((col(pred) > cut).cast("int"))
    return marked.withColumn("bin", F.when(col(pred).isNotNull(), reached)).drop("_cuts", group)


def bin_sizes(bins: DataFrame) -> DataFrame:
    """Rows per (model, bin)."""
    return bins.groupBy("model", "bin").agg(F.count(F.lit(1)).alias("n"))


def portfolio_stats(bins: DataFrame) -> DataFrame:
    """``(model, bin, date, ret, std, nfirms)``: mean, sample deviation and count of returns per portfolio month."""
    return (
        bins.filter(F.col("bin").isNotNull())
        .groupBy("model", "bin", "date")
        .agg(F.avg("ret").alias("ret"), F.stddev_samp("ret").alias("std"), F.count("ret").alias("nfirms"))
    )


def long_short(stats: DataFrame, strict: bool = False, nport: int = 5) -> DataFrame:
    """``(model, date, ret)``: top bin minus bottom bin.

    Positional by default: the highest minus the lowest bin that has a return in any month of that
    model, missing in months that lack either. ``strict=True`` always means bin ``nport`` minus bin 1.
    """
    seen = stats.filter(F.col("ret").isNotNull())
    if strict:
        top, bottom = F.lit(nport), F.lit(1)
    else:
        # stats has one row per portfolio month, so a model's window holds months x bins rows.
        w = Window.partitionBy("model")
        seen = seen.withColumns({"_top": F.max("bin").over(w), "_bottom": F.min("bin").over(w)})
        top, bottom = F.col("_top"), F.col("_bottom")
    return seen.groupBy("model", "date").agg(
        (F.max(F.when(F.col("bin") == top, F.col("ret"))) - F.max(F.when(F.col("bin") == bottom, F.col("ret")))).alias("ret")
    )


def portfolio_returns(stats: DataFrame, strict: bool = False, nport: int = 5) -> DataFrame:
    """All portfolio return series in one long table, the long-short series as ``bin = 'LS'``.

    The statistics are computed here, once: the series tables built from the result read them many times.
    """
    stats, _ = pocket(stats)
    each = stats.filter(F.col("ret").isNotNull()).select("model", F.col("bin").cast("string").alias("bin"), "date", "ret")
    spread = long_short(stats, strict, nport).select("model", F.lit(LONG_SHORT).alias("bin"), "date", "ret")
    return each.unionByName(spread)


def returns_wide(returns: DataFrame, series: Sequence[tuple[str, str]] | None = None) -> DataFrame:
    """One row per date, one column ``ret_<model>_bin<bin>`` per series. Pass ``series`` to fix the columns."""
    keyed = returns.withColumn("_series", F.concat(F.lit("ret_"), "model", F.lit("_bin"), "bin"))
    names = [f"ret_{m}_bin{b}" for m, b in series] if series is not None else None
    grouped = keyed.groupBy("date")
    pivot = grouped.pivot("_series", names) if names is not None else grouped.pivot("_series")
    return pivot.agg(only("ret"))


def returns_long(wide: DataFrame) -> DataFrame:
    """Back from the wide layout; model and bin are parsed out of the column names."""
    names = [c for c in wide.columns if c.startswith("ret_")]
    pattern = r"^ret_(.+)_bin(\w+)$"
    long = to_long(wide, ["date"], names, "_series", "ret")
    return long.select(
        F.regexp_extract("_series", pattern, 1).alias("model"),
        F.regexp_extract("_series", pattern, 2).alias("bin"),
        "date",
        "ret",
    )


def previous_in_entity(
    df: DataFrame, entity: Sequence[str], date: str, column: str, out: str = "prev", calendar: bool = False
) -> DataFrame:
    """The value of the entity's previous row; with ``calendar=True`` only if that row is last month's.

    (entity, date) must be a key, else the job fails: an entity's window then holds one row per month at most.
    """
    w = Window.partitionBy(*entity).orderBy(date)
    day_before = F.lag(date, 1).over(w)
    before = F.lag(column, 1).over(w)
    if calendar:
        before = F.when(day_before == F.add_months(date, -1), before)
    repeated = F.raise_error(F.lit(f"duplicate key ({', '.join([*entity, date])})")).cast(df.schema[column].dataType)
    return df.withColumn(out, F.when(day_before == F.col(date), repeated).otherwise(before))


def turnover(bins: DataFrame, nport: int = 5, entity: str = "permno", calendar: bool = False) -> DataFrame:
    """``(model, bin, date, buy, sell, hold)``: shares of the names held now or one row earlier.

    Every month of a model has a row for each bin the model ever uses; the shares are missing where
    nobody is or was in the bin. A firm without a row this month is not counted as sold.
    """
    moves = previous_in_entity(bins.select("model", entity, "date", "bin"), ["model", entity], "date", "bin", "prev", calendar)
    sums = []
    for b in range(1, nport + 1):
        now = F.coalesce(F.col("bin") == b, F.lit(False))
        then = F.coalesce(F.col("prev") == b, F.lit(False))
        sums += [
            F.count_if(now & ~then).alias(f"buy{b}"),
            F.count_if(~now & then).alias(f"sell{b}"),
            F.count_if(now & then).alias(f"hold{b}"),
        ]
    beyond = F.max(F.col("bin")).alias("_max")
    # One row per (model, month) from here on; the bins become rows of this small table.
    months = moves.groupBy("model", "date").agg(*sums, beyond)
    months = months.filter(
        F.when(F.coalesce("_max", F.lit(0)) <= nport, F.lit(True)).otherwise(
            F.raise_error(F.lit(f"bins above nport={nport}")).cast("boolean")
        )
    )
    rows = months.select(
        "model",
        "date",
        F.inline(
            F.array(
                *[
                    F.struct(
                        F.lit(b).alias("bin"),
                        F.col(f"buy{b}").alias("_buy"),
                        F.col(f"sell{b}").alias("_sell"),
                        F.col(f"hold{b}").alias("_hold"),
                    )
                    for b in range(1, nport + 1)
                ]
            )
        ),
    )
    used = F.max(F.col("_buy") + F.col("_hold")).over(Window.partitionBy("model", "bin"))
    held = F.col("_buy") + F.col("_sell") + F.col("_hold")
    return (
        rows.withColumn("_used", used)
        .filter("_used > 0")
        .select(
            "model",
            "bin",
            "date",
            ratio(F.col("_buy"), held).alias("buy"),
            ratio(F.col("_sell"), held).alias("sell"),
            ratio(F.col("_hold"), held).alias("hold"),
        )
    )


def average_turnover(moves: DataFrame, digits: int | None = None) -> DataFrame:
    """Mean over months per (model, bin), skipping missing months."""
    means = [F.avg(c) for c in ("buy", "sell", "hold")]
    if digits is not None:
        means = [F.round(m, digits) for m in means]
    return moves.groupBy("model", "bin").agg(*[m.alias(c) for m, c in zip(means, ("buy", "sell", "hold"))])


def average_turnover_wide(moves: DataFrame, kind: str = "hold", nport: int = 5) -> DataFrame:
    """One row per model, one column per bin, for ``kind`` in buy / sell / hold."""
    return moves.groupBy("model").pivot("bin", list(range(1, nport + 1))).agg(F.avg(kind))


def hold_series(moves: DataFrame, model: str) -> DataFrame:
    """The hold share of each bin of one model through time."""
    return moves.filter(F.col("model") == model).select("date", "bin", "hold")
