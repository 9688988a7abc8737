"""Run queries next to their SQL on DuckDB and compare every value. Usage: oracle_check.py [sf_dir] [name ...]"""

from __future__ import annotations

import os
import sys
import tempfile
import time

import duckdb
import pandas as pd

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

# The tables of the test data.
TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations").split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.execute(f"create view {t} as select * from read_parquet('{sf_dir}/{t}.parquet')")
    return con


def canonical(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    columns = []
    for c in df.columns:
        columns.append(["~" if pd.isna(v) else repr(float(v)) if isinstance(v, (float, int)) and not isinstance(v, bool) else str(v) for v in df[c].tolist()])
    return sorted(zip(*columns))


def difference(spark_df: pd.DataFrame, oracle_df: pd.DataFrame) -> str | None:
    if sorted(spark_df.columns) != sorted(oracle_df.columns):
        return f"columns {sorted(spark_df.columns)} != {sorted(oracle_df.columns)}"
    a, b = canonical(spark_df), canonical(oracle_df)
    if len(a) != len(b):
        return f"rows {len(a)} != {len(b)}"
    wrong = [(x, y) for x, y in zip(a, b) if x != y]
    return f"{len(wrong)} rows differ, first {wrong[0]}" if wrong else None


def session(partitions: int = 8):
    from pyspark.sql import SparkSession

    spark = (
        SparkSession.builder.master("local[8]")
        .config("spark.sql.shuffle.partitions", str(partitions))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", "8g")
        .config("spark.sql.session.timeZone", "UTC")
        .config("spark.checkpoint.dir", tempfile.mkdtemp(prefix="panelwise-"))
        .config("spark.ui.showConsoleProgress", "false")
        .getOrCreate()
    )
    spark.sparkContext.setLogLevel("ERROR")
    return spark


def main() -> int:
    import __spark_entry__ as entry

    sf_dir = sys.argv[1] if len(sys.argv) > 1 else "/root/testdata/sf0.01"
    names = sys.argv[2:]
    spark, con = session(), connect(sf_dir)
    oracles, bad = entry.oracle_sql(), 0
    for name, run in entry.queries().items():
        if names and not any(n in name for n in names):
            continue
        start = time.time()
        try:
            got = run(spark, sf_dir).toPandas()
            took = time.time() - start
            verdict = difference(got, con.execute(oracles[name]).df()) if name in oracles else "rows only"
        except Exception as e:  # noqa: BLE001
            took, verdict, got = time.time() - start, f"{type(e).__name__}: {str(e)[:900]}", []
        bad += verdict not in (None, "rows only")
        print(f"{name:30s} {len(got):7d} rows {took:6.2f}s  {verdict or 'ok'}", flush=True)
    print("bad:", bad)
    return bad


if __name__ == "__main__":
    sys.exit(main())
