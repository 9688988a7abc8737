"""The named queries over the trade tables and their SQL counterparts."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from panelwise.runtime import col

Query = Callable[[SparkSession, str], DataFrame]

QUERIES: dict[str, Query] = {}
ORACLES: dict[str, str] = {}


def query(name: str, sql: str | None = None) -> Callable[[Query], Query]:
    """Register a query under ``name``, with the SQL that must give the same rows."""

    def add(run: Query) -> Query:
        if name in QUERIES:
            raise ValueError(f"query {name} is registered twice")
        QUERIES[name] = run
        if sql is not None:
            ORACLES[name] = sql
        return run

    return add


def shown(df: DataFrame, digits: int = 9) -> DataFrame:
    """Dates as text and doubles rounded, so that two engines can be compared value by value."""
    out = []
    for f in df.schema.fields:
        c = col(f.name)
        if isinstance(f.dataType, T.DateType):
            c = F.date_format(c, "yyyy-MM-dd")
        elif isinstance(f.dataType, (T.DoubleType, T.FloatType)):
            c = F.when(F.abs(c) < 0.5 * 10.0**-digits, F.lit(0.0)).otherwise(F.round(c.cast("double"), digits))
        out.append(c.alias(f.name))
    return df.select(*out)


def day(expression: str, name: str | None = None) -> str:
    """SQL of :func:`shown` for a date."""
    return f"strftime({expression}, '%Y-%m-%d') as {name or expression}"


def num(expression: str, name: str | None = None, digits: int = 9) -> str:
    """SQL of :func:`shown` for a double."""
    return f"case when abs({expression}) < 0.5e0 * 1e-{digits} then 0.0e0 else round({expression}, {digits}) end as {name or expression}"


def nums(*names: str, digits: int = 9) -> str:
    return ", ".join(num(n, digits=digits) for n in names)
