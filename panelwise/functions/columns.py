"""Column helpers: missing values, clipping, ratios, selecting and ordering columns."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwise.runtime import col


def float_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]


def numeric_columns(df: DataFrame) -> list[str]:
    return [f.name for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]


def nan_to_null(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Make NULL the only missing value. Done once at load, so no NaN can poison a later average."""
    names = float_columns(df) if columns is None else list(columns)
    return df.withColumns({c: F.nanvl(col(c), F.lit(None)) for c in names}) if names else df


def clip(value: Column, lower: Column, upper: Column) -> Column:
    """Clip both sides; a missing value stays missing and a missing bound does not bind."""
    return F.when(value.isNotNull(), F.least(F.greatest(value, lower), upper))


def ratio(top: Column, bottom: Column) -> Column:
    """Division that gives NULL on a zero denominator instead of failing."""
    return F.try_divide(top.cast("double"), bottom.cast("double"))


def scale_columns(
    df: DataFrame,
    columns: Sequence[str] | None = None,
    keys: Sequence[str] = (),
    multiply: float = 1.0,
    divide: float = 1.0,
) -> DataFrame:
    """Change the unit of the named columns (default: all but ``keys``), e.g. ``divide=100`` for percent."""
    names = [c for c in df.columns if c not in keys] if columns is None else list(columns)
    return df.withColumns({c: col(c) * F.lit(float(multiply)) / F.lit(float(divide)) for c in names})


def move_to_front(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*[col(c) for c in columns], *[col(c) for c in df.columns if c not in columns])


def columns_starting(df: DataFrame, prefix: str) -> list[str]:
    return [c for c in df.columns if c.startswith(prefix)]


def columns_containing(df: DataFrame, part: str) -> list[str]:
    """Substring match, as loosely as it sounds: ``Lasso`` also finds ``LassoCV``."""
    return [c for c in df.columns if part in c]


def columns_after(df: DataFrame, k: int) -> list[str]:
    """All but the first ``k`` column names."""
    return df.columns[k:]


def narrow_floats(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Store doubles in single precision."""
    names = float_columns(df) if columns is None else list(columns)
    return df.withColumns({c: col(c).cast("float") for c in names}) if names else df


def check_case_collisions(df: DataFrame) -> DataFrame:
    """Spark resolves names without case, so two signals must not differ by case alone."""
    seen: dict[str, str] = {}
    for c in df.columns:
        if c.lower() in seen:
            raise ValueError(f"columns {seen[c.lower()]!r} and {c!r} differ only by case")
        seen[c.lower()] = c
    return df


def to_long(df: DataFrame, ids: Sequence[str], columns: Sequence[str], name: str, value: str) -> DataFrame:
    """Melt the named columns into (name, value) rows."""
    return df.unpivot([col(c) for c in ids], [col(c) for c in columns], name, value)


def by_position(df: DataFrame, values: Sequence[Column], position: str = "position", value: str = "value") -> DataFrame:
    """One row per value and row: the position of the value in the list, and the value.

    For statistics over hundreds of columns: a plan with two narrow columns stays in compiled code,
    where one aggregate per wide column would not.
    """
    return df.select(F.posexplode(F.array(*values)).alias(position, value))
