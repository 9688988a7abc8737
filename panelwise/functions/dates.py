"""Month arithmetic. A month is represented by its 28th day, which exists in every month."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

ANCHOR_DAY = 28


def month_anchor(date: Column, day: int = ANCHOR_DAY) -> Column:
    return F.make_date(F.year(date), F.month(date), F.lit(day))


def yyyymm_anchor(yyyymm: Column) -> Column:
    """The anchored date of an integer or string such as ``201001``."""
    return F.to_date(F.concat(yyyymm.cast("string"), F.lit(str(ANCHOR_DAY))), "yyyyMMdd")


def anchor_month(df: DataFrame, date: str = "date", day: int = ANCHOR_DAY) -> DataFrame:
    """Move ``date`` to the anchor day of its month."""
    return df.withColumn(date, month_anchor(F.col(date), day))


def shift_period(df: DataFrame, date: str, months: int) -> DataFrame:
    """Relabel rows ``months`` later (negative: earlier)."""
    return df.withColumn(date, F.add_months(date, months))


def month_label(date: Column) -> Column:
    return F.date_format(date, "yyyy-MM")
