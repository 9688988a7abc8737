"""Assembling the modelling panel: filters, month alignment, joins, samples and splits."""

from __future__ import annotations

from collections.abc import Callable, Sequence
from datetime import date as Date

from pyspark.sql import Column, DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from panelwise.functions.columns import by_position, check_case_collisions, move_to_front, nan_to_null
from panelwise.functions.dates import anchor_month, shift_period, yyyymm_anchor
from panelwise.runtime import col, guard_unique, lookup_join, pocket, repeats

HOLDOUT_DATE = Date(2020, 12, 28)


def returns_panel(raw: DataFrame, from_year: int = 1975) -> DataFrame:
    """``(permno, date, ret)`` with a return, from ``from_year`` on, anchored to the month."""
    kept = nan_to_null(raw).filter(F.col("ret").isNotNull() & (F.col("date") >= F.lit(Date(from_year, 1, 1))))
    return anchor_month(kept)


def lag_signals(signals: DataFrame, months: int = 1) -> DataFrame:
    """Date signals one month after they were measured; the measuring month stays as ``yyyymm_signals``."""
    named = nan_to_null(check_case_collisions(signals)).withColumnRenamed("yyyymm", "yyyymm_signals")
    named = named.withColumn("yyyymm_signals", F.col("yyyymm_signals").cast("string"))
    dated = named.withColumn("date", F.add_months(yyyymm_anchor(F.col("yyyymm_signals")), months))
    return move_to_front(dated, ["permno", "date"])


def present_share(df: DataFrame, columns: Sequence[str] | None = None) -> Column:
    """Share of non-missing columns of a row, as one expression."""
    names = df.columns if columns is None else list(columns)
    present = [col(c).isNotNull().cast("int") for c in names]
    return F.aggregate(F.array(*present), F.lit(0), lambda total, p: total + p) / F.lit(len(names))


def completeness_filter(df: DataFrame, min_share: float = 0.1, keys: Sequence[str] = (), count_keys: bool = True) -> DataFrame:
    """Keep rows with enough non-missing columns. Key columns count as present unless told otherwise."""
    names = df.columns if count_keys else [c for c in df.columns if c not in keys]
    return df.filter(present_share(df, names) >= F.lit(min_share))


def kept_rows(df: DataFrame, min_share: float = 0.1) -> DataFrame:
    """What :func:`completeness_filter` keeps: ``(kept, total, dropped_share)``."""
    kept = F.count_if(present_share(df) >= F.lit(min_share))
    total = F.count(F.lit(1))
    return df.agg(kept.alias("kept"), total.alias("total"), (F.lit(1.0) - F.try_divide(kept, total)).alias("dropped_share"))


def null_shares(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """``(column, null_share)`` of the named columns, from one pass over the table."""
    names = df.columns if columns is None else list(columns)
    marks = by_position(df, [col(c).isNull().cast("int") for c in names])
    shares = marks.groupBy("position").agg(F.avg("value").alias("null_share"))
    return shares.select(F.get(F.array(*[F.lit(c) for c in names]), F.col("position")).alias("column"), "null_share")


def sparse_columns(df: DataFrame, max_null_share: float = 0.9, columns: Sequence[str] | None = None) -> list[str]:
    """Names of the columns whose null share exceeds the limit (one row per column reaches the driver)."""
    return [r[0] for r in null_shares(df, columns).filter(F.col("null_share") > max_null_share).select("column").collect()]


def drop_sparse(df: DataFrame, max_null_share: float = 0.9, fit_on: DataFrame | None = None, keep: Sequence[str] = ()) -> DataFrame:
    """Drop almost empty columns. Pass the training rows as ``fit_on``, else the holdout has its say."""
    names = [c for c in df.columns if c not in keep]
    return df.drop(*sparse_columns(df if fit_on is None else fit_on, max_null_share, names))


def sample_entities(
    df: DataFrame, seen_before: Date, seen_from: Date, n: int = 100, seed: int = 123, entity: str = "permno", date: str = "date"
) -> DataFrame:
    """``n`` entities seen both before one date and from another on, chosen by a seeded hash."""
    spans = df.groupBy(entity).agg(F.min(date).alias("_first"), F.max(date).alias("_last"))
    lasting = spans.filter((F.col("_first") < F.lit(seen_before)) & (F.col("_last") >= F.lit(seen_from)))
    order = F.md5(F.concat_ws("-", F.lit(str(seed)), F.col(entity).cast("string")))
    return lasting.orderBy(order, entity).limit(n).select(entity)


def rows_of(df: DataFrame, entities: DataFrame, entity: str = "permno") -> DataFrame:
    """The rows of the given entities."""
    return lookup_join(df, entities.select(entity), [entity], "left_semi")


def member_flag(df: DataFrame, members: DataFrame, on: Sequence[str], out: str = "is_member") -> DataFrame:
    """Mark, rather than filter, the rows whose key occurs in ``members``."""
    marks = members.select(*on).distinct().withColumn(out, F.lit(True))
    return lookup_join(df, marks, list(on), "left").withColumn(out, F.coalesce(out, F.lit(False)))


def temporal_split(df: DataFrame, holdout: Date = HOLDOUT_DATE, date: str = "date") -> tuple[DataFrame, DataFrame]:
    """Rows up to the holdout date, and rows after it."""
    return df.filter(F.col(date) <= F.lit(holdout)), df.filter(F.col(date) > F.lit(holdout))


def join_signals(returns: DataFrame, signals: DataFrame, on: Sequence[str] = ("permno", "date")) -> DataFrame:
    """Inner join, one to one; the job fails if either side repeats a key."""
    on = list(on)
    return guard_unique(returns, on, "returns").join(guard_unique(signals, on, "signals"), on, "inner")


def join_factors(panel: DataFrame, factors: DataFrame, lag_months: int = 1) -> DataFrame:
    """Left join of monthly factors, many to one.

    ``lag_months=1`` gives a return last month's factors. ``-1`` relabels the following month's
    factors as this month's, which looks ahead; it is kept only to reproduce such results.
    """
    table, small = pocket(shift_period(factors, "date", lag_months))
    if repeats(table, "date"):
        raise ValueError("duplicate key (date) in factors")
    return lookup_join(panel, table, ["date"], "left", pocketed=small)


def join_row_counts(left: DataFrame, right: DataFrame, on: Sequence[str]) -> DataFrame:
    """(side, rows): how many rows stand on either side of an inner join, and how many come out of it.

    Counted per key first, so a key that repeats on both sides is multiplied, not expanded.
    """
    on = list(on)
    a = left.groupBy(*on).agg(F.count(F.lit(1)).alias("_a"))
    b = right.groupBy(*on).agg(F.count(F.lit(1)).alias("_b"))
    sums = a.join(b, on, "full_outer").agg(F.sum("_a").alias("left"), F.sum("_b").alias("right"), F.sum(F.col("_a") * F.col("_b")).alias("joined"))
    return sums.select(F.inline(F.array(*[F.struct(F.lit(s).alias("side"), F.coalesce(F.col(s), F.lit(0)).alias("rows")) for s in ("left", "right", "joined")])))


class JoinCounts:
    """Rows on both sides of a join and in its result, counted while the join runs for its own sake.

    Known once an action on the result has ended. Tasks that are run again after an executor was lost are counted again; where the
    numbers must be exact whatever happens, :func:`join_row_counts` counts by itself.
    """

    def __init__(self, left: Observation, right: Observation, joined: Observation):
        self._parts = {"left": left, "right": right, "joined": joined}

    def get(self) -> dict[str, int]:
        return {side: part.get["rows"] for side, part in self._parts.items()}

    def table(self, spark: SparkSession) -> DataFrame:
        """(side, rows)"""
        return spark.createDataFrame(list(self.get().items()), "side string, rows long")


def counted_join(left: DataFrame, right: DataFrame, join: Callable[[DataFrame, DataFrame], DataFrame]) -> tuple[DataFrame, JoinCounts]:
    """What ``join`` makes of the two tables, and its row counts: no pass, no shuffle and no sort of their own."""
    parts = [Observation(), Observation(), Observation()]
    rows = F.count(F.lit(1)).alias("rows")
    joined = join(left.observe(parts[0], rows), right.observe(parts[1], rows)).observe(parts[2], rows)
    return joined, JoinCounts(*parts)


def merge_factors(a: DataFrame, b: DataFrame, on: str = "date", provenance: bool = False) -> DataFrame:
    """Full outer join of two factor tables; ``_merge`` tells where each month came from."""
    left, right = a.withColumn("_left", F.lit(True)), b.withColumn("_right", F.lit(True))
    both = left.join(right, on, "full_outer")
    if provenance:
        origin = F.when(F.col("_right").isNull(), "left_only").when(F.col("_left").isNull(), "right_only").otherwise("both")
        both = both.withColumn("_merge", origin)
    return both.drop("_left", "_right")


def relabel_next(df: DataFrame, entity: str, period: str) -> DataFrame:
    """Move every row to its entity's next observed period; the last row gets none."""
    return df.withColumn(period, F.lead(period, 1).over(Window.partitionBy(entity).orderBy(period)))


def join_lagged(returns: DataFrame, signals: DataFrame, entity: str, period: str) -> DataFrame:
    """Returns with the signals of the entity's previous observed period."""
    return returns.join(relabel_next(signals, entity, period), [entity, period], "left")


def timeline_labels(months: DataFrame, first_train: Date, predict: Date, date: str = "date") -> DataFrame:
    """Label months Past / Train / Predict / Future around an expanding training window."""
    d = F.col(date)
    label = (
        F.when(d < F.lit(first_train), "Past")
        .when(d < F.lit(predict), "Train")
        .when(d == F.lit(predict), "Predict")
        .otherwise("Future")
    )
    return months.withColumn("set", label)


def training_window(df: DataFrame, predict: Date, months: int | None = None, date: str = "date") -> DataFrame:
    """Rows before ``predict``: all of them (expanding) or the last ``months`` (rolling)."""
    rows = df.filter(F.col(date) < F.lit(predict))
    return rows if months is None else rows.filter(F.col(date) >= F.add_months(F.lit(predict), -months))


def predicted_only(df: DataFrame, condition: Column, value: Column, out: str = "prediction") -> DataFrame:
    """A prediction column that is defined only where ``condition`` holds."""
    return df.withColumn(out, F.when(condition, value))


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[str]) -> DataFrame:
    """One row per key, the first in the given order.

    Spark keeps only the first row per key and task before it shuffles, so many copies of one key do no harm.
    """
    w = Window.partitionBy(*[col(c) for c in keys]).orderBy(*[col(c) for c in order])
    return df.withColumn("_nth", F.row_number().over(w)).filter(F.col("_nth") == 1).drop("_nth")
