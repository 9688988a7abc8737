"""Return series: cumulative value, moving averages, drawdown, Sharpe ratio, comparison tables.

Inputs are aggregated series with one row per (series, month), e.g. ``portfolio_returns``. A window
over a series therefore holds at most as many rows as there are months.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelwise.functions.columns import ratio, to_long
from panelwise.operators.portfolio import LONG_SHORT

SERIES = ("model", "bin")
MONTHS_PER_YEAR = 12


def pick_series(returns: DataFrame, models: Sequence[str] | None = None, bins: Sequence[str] | None = None) -> DataFrame:
    """Series of the named models and bins; an empty list means all."""
    if models:
        returns = returns.filter(F.col("model").isin(list(models)))
    if bins:
        returns = returns.filter(F.col("bin").isin([str(b) for b in bins]))
    return returns


def long_short_series(returns: DataFrame, models: Sequence[str] | None = None) -> DataFrame:
    return pick_series(returns, models, [LONG_SHORT])


def running_product(returns: DataFrame, series: Sequence[str] = SERIES, value: str = "ret", out: str = "value") -> DataFrame:
    """``out`` = product of (1 + value) up to this month; a missing month stays missing and is skipped."""
    w = Window.partitionBy(*series).orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    return returns.withColumn(out, F.when(F.col(value).isNotNull(), F.product(F.lit(1.0) + F.col(value)).over(w)))


def cumulative(
    returns: DataFrame, series: Sequence[str] = SERIES, value: str = "ret", base_row: bool = True
) -> DataFrame:
    """``(series, date, value)``: growth of 1, with a row of value 1 one month before the table starts."""
    grown = running_product(returns, series, value).select(*series, "date", "value")
    if not base_row:
        return grown
    start = returns.agg(F.add_months(F.min("date"), -1).alias("start")).scalar()
    base = returns.select(*series).distinct().select(*series, start.alias("date"), F.lit(1.0).alias("value"))
    return base.unionByName(grown)


def with_all_months(returns: DataFrame, series: Sequence[str] = SERIES, value: str = "ret") -> DataFrame:
    """Give every series a row for each month of the table; added rows have no value."""
    months = returns.agg(F.collect_set("date").alias("months")).scalar()
    frame = returns.select(*series).distinct().withColumn("_months", months)
    frame = frame.select(*series, F.explode("_months").alias("date"))
    return frame.join(returns.select(*series, "date", value), [*series, "date"], "left")


def moving_average(
    returns: DataFrame,
    window: int = 12,
    series: Sequence[str] = SERIES,
    value: str = "ret",
    fill_zero: bool = True,
    out: str = "ma",
) -> DataFrame:
    """Centred moving average over ``window`` rows, missing unless the whole window is there.

    An even window reaches one row further back than ahead. With ``fill_zero`` a missing month counts as 0.
    """
    if fill_zero:
        returns = with_all_months(returns, series, value).withColumn(value, F.coalesce(value, F.lit(0.0)))
    ahead = (window - 1) // 2
    frame = Window.partitionBy(*series).orderBy("date").rowsBetween(-(window - 1 - ahead), ahead)
    full = F.count(value).over(frame) == window
    return returns.withColumn(out, F.when(full, F.avg(value).over(frame)))


def drawdown_path(returns: DataFrame, series: Sequence[str] = SERIES, value: str = "ret", include_base: bool = False) -> DataFrame:
    """Adds ``value`` and ``drawdown`` = 1 - value / running peak.

    The peak starts at the first observed value, so a loss in the first month only counts with ``include_base``.
    """
    w = Window.partitionBy(*series).orderBy("date").rowsBetween(Window.unboundedPreceding, Window.currentRow)
    grown = running_product(returns, series, value)
    peak = F.max("value").over(w)
    if include_base:
        peak = F.greatest(peak, F.lit(1.0))
    return grown.withColumn("drawdown", F.lit(1.0) - ratio(F.col("value"), peak))


def max_drawdown(returns: DataFrame, series: Sequence[str] = SERIES, value: str = "ret", include_base: bool = False) -> DataFrame:
    path = drawdown_path(returns, series, value, include_base)
    return path.groupBy(*series).agg((F.max("drawdown") * 100).alias("max_drawdown"))


def sharpe(returns: DataFrame, series: Sequence[str] = SERIES, value: str = "ret") -> DataFrame:
    """Annualised mean over sample deviation; no risk-free rate is subtracted."""
    annual = F.sqrt(F.lit(float(MONTHS_PER_YEAR)))
    return returns.groupBy(*series).agg((ratio(F.avg(value), F.stddev_samp(value)) * annual).alias("sharpe"))


def model_metrics(returns: DataFrame, models: Sequence[str] | None = None) -> DataFrame:
    """``(model, mean_pct, std_pct, sharpe, max_drawdown)`` of each long-short series."""
    path = drawdown_path(long_short_series(returns, models), ["model"])
    annual = F.sqrt(F.lit(float(MONTHS_PER_YEAR)))
    return path.groupBy("model").agg(
        (F.avg("ret") * 100).alias("mean_pct"),
        (F.stddev_samp("ret") * 100).alias("std_pct"),
        (ratio(F.avg("ret"), F.stddev_samp("ret")) * annual).alias("sharpe"),
        (F.max("drawdown") * 100).alias("max_drawdown"),
    )


def against_zoo(returns: DataFrame, model: str, zoo: DataFrame, signals: Sequence[str] | None = None) -> DataFrame:
    """``(series, date, value)``: growth of one model's long-short return and of zoo returns over common months.

    ``zoo(signalname, date, ret)`` is in percent, ``returns`` in decimals.
    """
    if signals:
        zoo = zoo.filter(F.col("signalname").isin(list(signals)))
    mine = long_short_series(returns, [model]).select(F.col("model").alias("series"), "date", "ret")
    theirs = zoo.select(F.col("signalname").alias("series"), "date", (F.col("ret") / 100).alias("ret"))
    mine_common = mine.join(theirs.select("date").distinct(), "date", "left_semi")
    theirs_common = theirs.join(mine.select("date").distinct(), "date", "left_semi")
    return cumulative(mine_common.unionByName(theirs_common), ["series"])


def ls_comparison(returns: DataFrame, models: Sequence[str] | None = None) -> DataFrame:
    """``(date, Model, Return)``: growth of every long-short series, in the long layout charts want."""
    grown = cumulative(long_short_series(returns, models), ["model"])
    return grown.select("date", F.col("model").alias("Model"), F.col("value").alias("Return"))


def unpivot_series(wide: DataFrame, id_column: str = "date") -> DataFrame:
    """Melt a wide table of series into ``(id, Model, Return)``."""
    return to_long(wide, [id_column], [c for c in wide.columns if c != id_column], "Model", "Return")


def market_mean(panel: DataFrame, value: str = "ret") -> DataFrame:
    """Equal-weighted mean return per month."""
    return panel.groupBy("date").agg(F.avg(value).alias(value))


def market_moving_average(panel: DataFrame, window: int = 12) -> DataFrame:
    """The market mean and its centred moving average; here a missing month leaves a gap."""
    mean = market_mean(panel).withColumn("model", F.lit("market"))
    return moving_average(mean, window, ["model"], "ret", fill_zero=False).drop("model")


def wants_log_scale(grown: DataFrame, threshold: float = 50.0) -> DataFrame:
    return grown.agg((F.max("value") > F.lit(threshold)).alias("log_scale"))


def date_range(returns: DataFrame) -> DataFrame:
    return returns.agg(F.min("date").alias("first_date"), F.max("date").alias("last_date"))
