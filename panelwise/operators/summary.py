"""Counts, distinct values, ranges and column descriptions."""

from __future__ import annotations

from collections.abc import Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwise.functions.columns import by_position, numeric_columns
from panelwise.operators.order_stats import DIRECT_ROWS, exact_quantiles
from panelwise.runtime import col


def rows_per(df: DataFrame, key: Column, name: str) -> DataFrame:
    return df.groupBy(key.alias(name)).agg(F.count(F.lit(1)).alias("n"))


def entities_per(df: DataFrame, key: Column, name: str, entity: str = "permno") -> DataFrame:
    """Exact number of distinct entities per period."""
    return df.groupBy(key.alias(name)).agg(F.countDistinct(entity).alias("entities"))


#: Size of the distinct-count sketches (2^k cells) and three times their standard error.
HLL_K = 12
HLL_ERROR = 3 * 1.04 / 2 ** (HLL_K / 2)


def entity_sketches(df: DataFrame, key: Column, name: str, entity: str = "permno") -> DataFrame:
    """(period, sketch): a sketch of a period's distinct entities that merges with others, to be stored once and asked for any range."""
    return df.groupBy(key.alias(name)).agg(F.hll_sketch_agg(entity, HLL_K).alias("sketch"))


def entities_from_sketches(sketches: DataFrame, key: Column, name: str) -> DataFrame:
    """(range, entities): distinct entities of any grouping of stored periods, about right: off by ``HLL_ERROR`` at most in 99.7 of 100 cases.

    Only sketches are read, one row per period; :func:`entities_per` counts exactly, from the rows.
    """
    merged = sketches.groupBy(key.alias(name)).agg(F.hll_union_agg("sketch").alias("sketch"))
    return merged.select(name, F.hll_sketch_estimate("sketch").alias("entities"))


def model_names(predictions: DataFrame, first: str | None = "Ridge") -> DataFrame:
    """Distinct models in alphabetical order, one of them pulled to the front."""
    return predictions.select("model").distinct().orderBy(F.col("model") != F.lit(first or ""), "model")


def default_models(predictions: DataFrame, n: int = 5) -> DataFrame:
    return predictions.select("model").distinct().orderBy("model").limit(n)


def _named(df: DataFrame, rows: list[tuple], schema: str) -> DataFrame:
    """A row per column, by position, to hang aggregates on; a table without rows has its columns, too."""
    return F.broadcast(df.sparkSession.createDataFrame([(i, *r) for i, r in enumerate(rows)], f"position int, {schema}"))


def column_moments(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, count, mean, std, min, max)`` per column, from (position, value) pairs, so hundreds of columns stay in compiled code."""
    names = numeric_columns(df) if columns is None else list(columns)
    values = by_position(df, [col(c).cast("double") for c in names])
    moments = values.groupBy("position").agg(
        F.count("value").alias("count"), F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"), F.min("value").alias("min"), F.max("value").alias("max")
    )
    joined = _named(df, [(c,) for c in names], "column string").join(moments, "position", "left")
    return joined.select("column", F.coalesce("count", F.lit(0)).alias("count"), "mean", "std", "min", "max")


def describe_columns(df: DataFrame, columns: Sequence[str] | None = None, direct_rows: int | None = None) -> DataFrame:
    """``(column, count, mean, std, min, q25, q50, q75, max)`` with exact quartiles.

    Up to ``direct_rows`` values everything comes from one scan, which counts the distinct values of each column.
    """
    names = numeric_columns(df) if columns is None else list(columns)
    values = by_position(df, [col(c).cast("double") for c in names])
    if df.count() * len(names) <= (DIRECT_ROWS if direct_rows is None else direct_rows):
        return _described_directly(df, values, names)
    quartiles = exact_quantiles(values, ["position"], "value", [0.25, 0.5, 0.75], direct_rows)
    name = F.get(F.array(*[F.lit(c) for c in names]), F.col("position")).alias("column")
    quartiles = quartiles.select(name, *[F.get("quantiles", F.lit(i)).alias(q) for i, q in enumerate(("q25", "q50", "q75"))])
    joined = column_moments(df, names).join(quartiles, "column", "left")
    return joined.select("column", "count", "mean", "std", "min", "q25", "q50", "q75", "max")


def _described_directly(df: DataFrame, values: DataFrame, names: Sequence[str]) -> DataFrame:
    """The distinct values of a column in one group: there are few enough of them."""
    out = "position int, count long, mean double, std double, min double, q25 double, q50 double, q75 double, max double"

    def run(table: pa.Table) -> pa.Table:
        order = np.argsort(table.column("value").to_numpy())
        value, n = table.column("value").to_numpy()[order], table.column("n").to_numpy()[order]
        upto = np.cumsum(n)
        total = int(upto[-1])
        mean = float((value * n).sum() / total)
        spread = float(np.sqrt(((value - mean) ** 2 * n).sum() / (total - 1))) if total > 1 else None
        quartiles = []
        for p in (0.25, 0.5, 0.75):
            spot = (total - 1) * p
            low, high = (value[np.searchsorted(upto, r)] for r in (int(spot) + 1, min(int(spot) + 2, total)))
            quartiles.append(float(low + (high - low) * (spot - int(spot))))
        return pa.Table.from_pylist([dict(zip(fields, [table.column("position")[0].as_py(), total, mean, spread, float(value[0]), *quartiles, float(value[-1])]))], schema)

    fields = [f.split()[0] for f in out.split(", ")]
    schema = pa.schema([(f, pa.int32() if f == "position" else pa.int64() if f == "count" else pa.float64()) for f in fields])
    counts = values.filter(F.col("value").isNotNull()).groupBy("position", "value").agg(F.count(F.lit(1)).alias("n"))
    joined = _named(df, [(c,) for c in names], "column string").join(counts.groupBy("position").applyInArrow(run, out), "position", "left")
    return joined.select("column", F.coalesce("count", F.lit(0)).alias("count"), *fields[2:])


def column_info(df: DataFrame) -> DataFrame:
    """``(column, type, present)``: declared type and number of non-missing values."""
    fields = df.schema.fields
    present = by_position(df, [col(f.name).isNotNull().cast("int") for f in fields]).groupBy("position").agg(F.sum("value").alias("present"))
    joined = _named(df, [(f.name, f.dataType.simpleString()) for f in fields], "column string, type string").join(present, "position", "left")
    return joined.select("column", "type", F.coalesce("present", F.lit(0)).alias("present"))
