"""Readers with explicit schemas and writers for the tables the library consumes and produces."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwise.functions.columns import check_case_collisions, nan_to_null, to_long
from panelwise.functions.dates import anchor_month
from panelwise.operators.panel import merge_factors
from panelwise.operators.portfolio import LONG_SHORT, predictions_long
from panelwise.runtime import col, only

# Names and units of the monthly factor table (percent).
FACTOR_NAMES = ("mkt_excess", "SMB", "HML", "RMW", "CMA", "RF", "Mom")
FACTOR_RENAMES = {"Mkt-RF": "mkt_excess", "Date": "date"}
RETURNS = T.StructType([T.StructField("permno", T.LongType()), T.StructField("date", T.DateType()), T.StructField("ret", T.DoubleType())])
PORT_STATS = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("bin", T.IntegerType()),
        T.StructField("date", T.DateType()),
        T.StructField("ret", T.DoubleType()),
        T.StructField("std", T.DoubleType()),
        T.StructField("nfirms", T.LongType()),
    ]
)
TURNOVER = T.StructType(
    [
        T.StructField("model", T.StringType()),
        T.StructField("bin", T.IntegerType()),
        T.StructField("date", T.DateType()),
        T.StructField("% buy", T.DoubleType()),
        T.StructField("% sell", T.DoubleType()),
        T.StructField("% hold", T.DoubleType()),
    ]
)
ZOO = T.StructType(
    [
        T.StructField("signalname", T.StringType()),
        T.StructField("port", T.StringType()),
        T.StructField("date", T.DateType()),
        T.StructField("ret", T.DoubleType()),
    ]
)
SHOWN_TURNOVER = {"buy": "% buy", "sell": "% sell", "hold": "% hold"}


def is_csv(path: str) -> bool:
    return ".csv" in path.rstrip("/").rsplit("/", 1)[-1]


def read_table(spark: SparkSession, path: str, schema: T.StructType | None = None, date_format: str = "yyyy-MM-dd") -> DataFrame:
    """Parquet, or CSV with a header. A CSV needs a schema: nothing is inferred from data.

    Spark has no codec for zip archives, so those must be unpacked before; gzip and bzip2 work.
    """
    if path.endswith(".zip"):
        raise ValueError(f"{path}: unpack zip archives before reading")
    if is_csv(path):
        if schema is None:
            raise ValueError(f"{path}: a CSV needs a schema")
        # The file may have more columns than are wanted, in any order: those are read as text and dropped.
        header, wanted = csv_columns(spark, path), {f.name: f for f in schema.fields}
        lacking = [c for c in wanted if c not in header]
        if lacking:
            raise ValueError(f"{path} lacks the columns {lacking}")
        whole = T.StructType([wanted.get(c, T.StructField(c, T.StringType())) for c in header])
        df = spark.read.csv(path, header=True, schema=whole, enforceSchema=False, nullValue="", dateFormat=date_format, mode="FAILFAST").select(*[col(c) for c in wanted])
    else:
        df = spark.read.parquet(path)
    return nan_to_null(df)


def csv_columns(spark: SparkSession, path: str) -> list[str]:
    """The header of a CSV."""
    return spark.read.option("header", True).csv(path).columns


def read_returns(spark: SparkSession, path: str, date_format: str = "yyyy-MM-dd") -> DataFrame:
    """``(permno, date, ret)``; other columns are passed over."""
    return read_table(spark, path, RETURNS, date_format).select("permno", "date", "ret")


def read_signals(spark: SparkSession, path: str, keys: Sequence[str] = ("permno", "yyyymm")) -> DataFrame:
    """The wide signal table: the keys as numbers, whatever else the header names as doubles."""
    if not is_csv(path):
        return nan_to_null(check_case_collisions(spark.read.parquet(path)))
    types = {"permno": T.LongType(), "yyyymm": T.IntegerType()}
    names = check_case_collisions(spark.read.option("header", True).csv(path)).columns
    schema = T.StructType([T.StructField(c, types.get(c, T.LongType()) if c in keys else T.DoubleType()) for c in names])
    return read_table(spark, path, schema)


def read_factors(spark: SparkSession, path: str, date_format: str = "yyyy-MM-dd") -> DataFrame:
    """Monthly factors, anchored to the month."""
    schema = None
    if is_csv(path):
        types = {"date": T.DateType(), "Date": T.DateType(), "_merge": T.StringType()}
        schema = T.StructType([T.StructField(c, types.get(c, T.DoubleType())) for c in csv_columns(spark, path)])
    return anchor_month(read_table(spark, path, schema, date_format).withColumnsRenamed(FACTOR_RENAMES))


def combine_factors(five: DataFrame, momentum: DataFrame, provenance: bool = False) -> DataFrame:
    """One factor table from the five-factor and the momentum table, unshifted and anchored."""
    a = anchor_month(five.withColumnsRenamed(FACTOR_RENAMES))
    b = anchor_month(momentum.withColumnsRenamed(FACTOR_RENAMES))
    named = b.toDF(*["date" if c == "date" else "Mom" for c in b.columns])
    return merge_factors(a, named, "date", provenance)


def read_signal_doc(spark: SparkSession, path: str) -> DataFrame:
    """``(Acronym, Cat.Form)``, distinct."""
    if is_csv(path):
        names = csv_columns(spark, path)
        doc = spark.read.csv(path, header=True, schema=T.StructType([T.StructField(c, T.StringType()) for c in names]), multiLine=True, escape='"')
    else:
        doc = spark.read.parquet(path)
    return doc.select("Acronym", col("Cat.Form")).distinct()


def read_zoo(spark: SparkSession, path: str) -> DataFrame:
    """``(signalname, date, ret)`` of the long-short portfolios, in percent."""
    zoo = read_table(spark, path, ZOO).select(*ZOO.names).filter(F.col("port") == LONG_SHORT)
    return anchor_month(zoo).drop("port")


def zoo_returns_wide(portfolios: DataFrame, signals: Sequence[str] | None = None) -> DataFrame:
    """One row per month, one column per signal, from ``(signalname, port, date, ret)``."""
    ls = anchor_month(portfolios.filter(F.col("port") == LONG_SHORT))
    grouped = ls.groupBy("date")
    pivot = grouped.pivot("signalname", list(signals)) if signals else grouped.pivot("signalname")
    return pivot.agg(only("ret"))


def read_wide(spark: SparkSession, path: str, whole: Sequence[str] = ("permno",)) -> DataFrame:
    """A wide table of series or predictions: a ``date``, whole-number keys, and doubles for whatever else the header names."""
    schema = None
    if is_csv(path):
        types = {"date": T.DateType(), **{c: T.LongType() for c in whole}}
        schema = T.StructType([T.StructField(c, types.get(c, T.DoubleType())) for c in csv_columns(spark, path)])
    return read_table(spark, path, schema)


def read_predictions_wide(spark: SparkSession, path: str) -> DataFrame:
    """``(permno, date, ret, model, pred)`` from a table with one ``pred_<model>`` column per model."""
    return predictions_long(read_wide(spark, path))


def read_zoo_wide(spark: SparkSession, path: str) -> DataFrame:
    """``(signalname, date, ret)`` from a table with one column per signal."""
    wide = anchor_month(read_wide(spark, path))
    return to_long(wide, ["date"], [c for c in wide.columns if c != "date"], "signalname", "ret").select("signalname", "date", "ret")


def read_portfolio_outputs(spark: SparkSession, folder: str, csv: bool = False) -> tuple[DataFrame, DataFrame, DataFrame]:
    """``(returns_wide, port_stats_tall, turnover)`` as written by :func:`write_portfolio_outputs`."""
    end = ".csv" if csv else ""
    wide = read_wide(spark, f"{folder}/returns_wide{end}")
    stats = read_table(spark, f"{folder}/port_stats_tall{end}", PORT_STATS if csv else None)
    moves = read_table(spark, f"{folder}/turnover{end}", TURNOVER if csv else None)
    return wide, stats, moves.withColumnsRenamed({shown: c for c, shown in SHOWN_TURNOVER.items()})


def write_portfolio_outputs(folder: str, returns_wide: DataFrame, stats: DataFrame, moves: DataFrame, csv: bool = False) -> None:
    end = ".csv" if csv else ""
    write_table(returns_wide, f"{folder}/returns_wide{end}")
    write_table(stats, f"{folder}/port_stats_tall{end}")
    write_table(moves.withColumnsRenamed(SHOWN_TURNOVER), f"{folder}/turnover{end}")


def write_table(df: DataFrame, path: str, partition_by: Sequence[str] = ()) -> None:
    """Overwrite ``path``; CSV if the name says so, else Parquet."""
    writer = df.write.mode("overwrite")
    if partition_by:
        writer = writer.partitionBy(*partition_by)
    if is_csv(path):
        writer.csv(path, header=True)
    else:
        writer.parquet(path)


def percent_text(value: Column, digits: int = 2) -> Column:
    """Display text such as ``12.34%``; a dash where there is no value."""
    return F.when(value.isNotNull(), F.format_string(f"%.{digits}f%%", value * 100)).otherwise("-")


def number_text(value: Column, digits: int = 3, brackets: bool = False) -> Column:
    """Display text such as ``0.123`` or, for t-statistics, ``(1.23)``."""
    return F.when(value.isNotNull(), F.format_string(f"(%.{digits}f)" if brackets else f"%.{digits}f", value)).otherwise("-")
