"""The panel roles (returns, signals, factors, predictions, zoo) derived from the trade tables.

Values are built from integer sums and one division, so two engines agree on them to the last bit and
hence on every rank derived from them.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwise.functions.dates import month_anchor
from panelwise.operators import portfolio, series
from panelwise.operators.portfolio import predictions_long
from panelwise.runtime import stage_table

# Which signal stands in for which model's prediction.
MODEL_SIGNALS = {"Ridge": "sig_qty", "Lasso": "sig_step", "LassoCV": "sig_tax", "mlp-64-32": "sig_price"}
SIGNALS = ("sig_qty", "sig_tax", "sig_price")


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def _mean(units: Column) -> Column:
    return F.sum(units.cast("long")) / F.count(F.lit(1))


def panel(spark: SparkSession, sf_dir: str, entity: str = "l_suppkey") -> DataFrame:
    """(entity, month) panel: percent return, continuous signals with gaps, two discrete attributes."""
    items = table(spark, sf_dir, "lineitem")
    n = F.count(F.lit(1))
    cells = items.groupBy(F.col(entity).alias("permno"), month_anchor(F.col("l_shipdate")).alias("date")).agg(
        n.alias("n_items"),
        (_mean(F.round(F.col("l_discount") * 100)) - F.lit(5.0)).alias("ret"),
        _mean(F.round("l_quantity")).alias("sig_qty"),
        _mean(F.round(F.col("l_tax") * 100)).alias("_tax"),
        _mean(F.floor("l_extendedprice")).alias("sig_price"),
        F.count_if(F.col("l_returnflag") == "A").alias("_a"),
        F.count_if(F.col("l_returnflag") == "N").alias("_n"),
        F.count_if(F.col("l_returnflag") == "R").alias("_r"),
        F.count_if(F.col("l_linestatus") == "F").alias("_f"),
    )
    busy = F.col("n_items") >= 4
    flag = (
        F.when((F.col("_a") >= F.col("_n")) & (F.col("_a") >= F.col("_r")), "A")
        .when(F.col("_n") >= F.col("_r"), "N")
        .otherwise("R")
    )
    return cells.select(
        "permno",
        "date",
        "n_items",
        "ret",
        "sig_qty",
        F.when(busy, F.col("_tax")).alias("sig_tax"),
        "sig_price",
        F.floor(F.col("_tax") / 4).cast("double").alias("sig_step"),
        F.when(F.col("n_items") >= 15, F.col("_tax")).alias("sig_rare"),
        F.when(busy, flag).alias("disc_flag"),
        F.when(busy, (F.col("_f") * 2 >= F.col("n_items")).cast("double")).alias("disc_line"),
    )


def raw_signals(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Signals as delivered: keyed by an integer month ``yyyymm``."""
    p = panel(spark, sf_dir)
    return p.select("permno", (F.year("date") * 100 + F.month("date")).alias("yyyymm"), "sig_qty", "sig_tax", "sig_price", "sig_rare")


def returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return panel(spark, sf_dir).select("permno", "date", "ret")


def factors(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Monthly factors in percent from order values; months without orders have none."""
    price = F.floor("o_totalprice").cast("long")

    def mean_of(condition: Column | None, name: str) -> Column:
        if condition is None:
            value = F.sum(price) / F.count(F.lit(1))
        else:
            value = F.try_divide(F.sum(F.when(condition, price)), F.count_if(condition))
        return (value / F.lit(100000.0) - F.lit(2.5)).alias(name)

    rank = F.substring("o_orderpriority", 1, 1)
    return (
        table(spark, sf_dir, "orders")
        .groupBy(month_anchor(F.col("o_orderdate")).alias("date"))
        .agg(
            mean_of(None, "mkt_excess"),
            mean_of(rank == "1", "SMB"),
            mean_of(rank == "2", "HML"),
            mean_of(rank == "3", "RMW"),
            mean_of(rank == "4", "CMA"),
            (F.count_if(rank == "5") / F.lit(1000.0)).alias("RF"),
            mean_of(F.col("o_orderstatus") == "P", "Mom"),
        )
    )


def predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(permno, date, ret, model, pred)`` in decimals, one signal standing in for each model.

    Sorting reads its input more than once, so the aggregated panel is staged.
    """
    p = stage_table(panel(spark, sf_dir).select("permno", "date", "ret", *MODEL_SIGNALS.values()))
    wide = p.select("permno", "date", (F.col("ret") / 100).alias("ret"), *[(F.col(s) / 100).alias(f"pred_{m}") for m, s in MODEL_SIGNALS.items()])
    return predictions_long(wide)


def bins(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portfolio.assign_bins(predictions(spark, sf_dir))


def stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portfolio.portfolio_stats(bins(spark, sf_dir))


def portfolio_returns(spark: SparkSession, sf_dir: str) -> DataFrame:
    return portfolio.portfolio_returns(stats(spark, sf_dir))


def zoo_portfolios(spark: SparkSession, sf_dir: str) -> DataFrame:
    """``(signalname, port, date, ret)`` in percent: portfolios sorted on each single signal."""
    p = stage_table(panel(spark, sf_dir).select("permno", "date", "ret", *SIGNALS))
    wide = p.select("permno", "date", "ret", *[F.col(s).alias(f"pred_{s}") for s in SIGNALS])
    sorted_on = portfolio.assign_bins(predictions_long(wide))
    rets = portfolio.portfolio_returns(portfolio.portfolio_stats(sorted_on))
    return rets.select(F.col("model").alias("signalname"), F.col("bin").alias("port"), "date", "ret")


def zoo(spark: SparkSession, sf_dir: str) -> DataFrame:
    return zoo_portfolios(spark, sf_dir).filter(F.col("port") == portfolio.LONG_SHORT).drop("port")


def cumulative(spark: SparkSession, sf_dir: str) -> DataFrame:
    return series.cumulative(portfolio_returns(spark, sf_dir))


def daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Mean event value in cents per type and day, as a daily set of series."""
    e = table(spark, sf_dir, "events")
    cents = F.round(F.col("value") * 100).cast("long")
    return e.groupBy(F.col("event_type").alias("series"), F.to_date("ts").alias("date")).agg((F.sum(cents) / F.count(F.lit(1))).alias("ret"))
