"""Shared-folder checkpoints, size-checked broadcasts and lazy key guards.

The three things every operator needs to stay correct on a cluster whose executors may vanish and
whose keys may be badly skewed.
"""

from __future__ import annotations

import tempfile
import uuid

import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

# A side is broadcast only when its measured size stays below this.
MAX_BROADCAST_BYTES = 64 * 1024 * 1024


def shared_folder(spark: SparkSession) -> str:
    """The folder for checkpoints and staged tables, as named by ``spark.checkpoint.dir``.

    Only a local session may fall back to a temporary folder of its own machine.
    """
    sc = spark.sparkContext
    current = sc.getCheckpointDir()
    if current:
        return current
    folder = spark.conf.get("spark.checkpoint.dir", None)
    if not folder:
        if not sc.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors can reach")
        folder = tempfile.mkdtemp(prefix="panelwise-")
    sc.setCheckpointDir(folder)
    return sc.getCheckpointDir()


def stage_table(df: DataFrame, partition_by: str | None = None) -> DataFrame:
    """Compute ``df`` once into a Parquet table on the shared folder, optionally laid out by a column.

    Cuts the lineage like a checkpoint, but computes the rows only once and lets later reads prune
    columns and folders.
    """
    spark = df.sparkSession
    path = f"{shared_folder(spark)}/staged-{uuid.uuid4().hex}"
    if partition_by is None:
        df.write.parquet(path)
    else:
        # Even out the files: few per folder, and a folder holding much of the data is split over many tasks.
        df.hint("rebalance", partition_by).write.partitionBy(partition_by).parquet(path)
    staged = spark.read.parquet(path)
    staged._staged_at = path
    return staged


def drop_staged(*tables: DataFrame) -> None:
    """Delete staged tables that nothing will read any more."""
    for t in tables:
        where = t.sparkSession._jvm.org.apache.hadoop.fs.Path(t._staged_at)
        where.getFileSystem(t.sparkSession._jsc.hadoopConfiguration()).delete(where, True)


class Memo:
    """Results by what computes them: the same plan over the same files is computed once, and read from a staged table afterwards.

    Two frames are the same if their canonical plans are (``sameSemantics``) and every file they read has the size and the time of change
    it had. A frame that reads no files is never remembered, as nothing tells when it changes. Every ``get`` must be followed by a
    ``release`` in the end: the table is deleted with its last user, and so is one whose files have changed.
    """

    def __init__(self) -> None:
        self.entries: list[dict] = []

    @staticmethod
    def _files(df: DataFrame) -> tuple[tuple[str, int, int], ...]:
        spark = df.sparkSession
        found = []
        for name in sorted(df.inputFiles()):
            where = spark._jvm.org.apache.hadoop.fs.Path(name)
            status = where.getFileSystem(spark._jsc.hadoopConfiguration()).getFileStatus(where)
            found.append((name, status.getLen(), status.getModificationTime()))
        return tuple(found)

    def get(self, df: DataFrame) -> DataFrame:
        """``df``, computed at most once."""
        files, key = self._files(df), df.semanticHash()
        for entry in self.entries:
            if entry["key"] == key and entry["frame"].sameSemantics(df) and not entry["stale"]:
                if entry["files"] == files:
                    entry["users"] += 1
                    return entry["staged"]
                entry["stale"] = True
        if not files:
            return df
        entry = {"key": key, "frame": df, "files": files, "staged": stage_table(df), "users": 1, "stale": False}
        self.entries = [e for e in self.entries if not (e["stale"] and e["users"] == 0)] + [entry]
        return entry["staged"]

    def release(self, staged: DataFrame) -> None:
        """One user less; without any the table is deleted."""
        for entry in self.entries:
            if entry["staged"] is staged:
                entry["users"] -= 1
                if entry["users"] == 0:
                    self.entries.remove(entry)
                    drop_staged(staged)
                return


def row_bytes(schema: T.StructType) -> int:
    """An estimate of one row's size in memory, to bound what is fetched before its size is known."""

    def width(t: T.DataType) -> int:
        if isinstance(t, T.ArrayType):
            return 64 * width(t.elementType)
        if isinstance(t, T.StructType):
            return sum(width(f.dataType) for f in t.fields)
        return 64 if isinstance(t, T.StringType) else 16

    return 32 + width(schema)


def pocket(df: DataFrame, max_bytes: int | None = None) -> tuple[DataFrame, bool]:
    """``df`` computed once, and whether it is small.

    At most one row more than the broadcast bound is fetched. If that suffices, the result is a local
    table without lineage, ready to be broadcast; otherwise the table is staged on the shared folder.
    """
    limit = MAX_BROADCAST_BYTES if max_bytes is None else max_bytes
    rows = max(limit // row_bytes(df.schema), 1)
    head = df.limit(rows + 1).toArrow()
    # The estimate bounds what is fetched; what counts are the bytes that came, and what a row costs besides.
    if head.num_rows <= rows and head.nbytes + 32 * head.num_rows <= max(limit, 32):
        table = df.sparkSession.createDataFrame(head, df.schema)
        table._fetched = head
        return table, True
    return stage_table(df), False


def largest_of(table: DataFrame, name: str) -> int:
    """The largest value of a column of a pocketed table, without a job if its rows are at hand; 0 if there are none."""
    head = getattr(table, "_fetched", None)
    if head is not None:
        return pc.max(head.column(name)).as_py() or 0
    return table.agg(F.max(col(name))).first()[0] or 0


def repeats(table: DataFrame, key: str) -> bool:
    """Does a pocketed table hold a value of ``key`` more than once?"""
    head = getattr(table, "_fetched", None)
    if head is not None:
        return pc.count_distinct(head.column(key), mode="all").as_py() < head.num_rows
    return key_duplicates(table, [key]).limit(1).count() > 0


#: What tasks may hand back for one sum of matrices, all together.
MATRICES_BYTES = 64 * 1024**3


def fewer_tasks(df: DataFrame, bytes_each: int) -> DataFrame:
    """Let a task read several splits where every task hands back ``bytes_each`` of matrices, so that fewer matrices are shuffled.

    As many tasks as ``MATRICES_BYTES`` allow, but never fewer than 2000 or four per core known now: executors may still be joining.
    """
    allowed = min(MATRICES_BYTES // max(bytes_each, 1), 1_000_000)
    return df.coalesce(max(4 * df.sparkSession.sparkContext.defaultParallelism, 2000, allowed))


def lookup_join(
    big: DataFrame,
    small: DataFrame,
    on: list[str],
    how: str = "left",
    max_bytes: int | None = None,
    pocketed: bool | None = None,
) -> DataFrame:
    """Join ``big`` (left / inner / semi / anti) with a lookup table whose size is measured first.

    If the lookup fits it is broadcast and ``big`` is not shuffled. Otherwise both sides are
    shuffled on the keys; the lookup is a staged table with unique keys, so adaptive execution can split a key that holds a
    large share of ``big`` among tasks. ``pocketed`` passes on the answer of an earlier :func:`pocket` for
    the same lookup.
    """
    if how not in ("left", "inner", "left_semi", "left_anti"):
        raise ValueError(f"lookup_join keeps the left side: {how} is not supported")
    fits = pocketed
    if fits is None:
        small, fits = pocket(small, max_bytes)
    return big.join(F.broadcast(small) if fits else small, on, how)


def guard_unique(df: DataFrame, keys: list[str], name: str) -> DataFrame:
    """``df`` unchanged, but the job fails as soon as a key repeats.

    The guard is a window on the join keys: it uses the same hash partitioning and sort order as the
    join that follows, so it adds no shuffle of its own.
    """
    w = Window.partitionBy(*keys).orderBy(*keys)
    ok = F.when(F.col("_nth") == 1, F.lit(True)).otherwise(
        F.raise_error(F.lit(f"duplicate key ({', '.join(keys)}) in {name}")).cast("boolean")
    )
    return df.withColumn("_nth", F.row_number().over(w)).filter(ok).drop("_nth")


def only(name: str) -> Column:
    """Aggregate for reshapes: the one value of a cell; the job fails if a cell has several rows."""
    several = F.raise_error(F.lit(f"several rows for one cell of {name}"))
    return F.when(F.count(F.lit(1)) <= 1, F.first(col(name))).otherwise(several)


def key_duplicates(df: DataFrame, keys: list[str]) -> DataFrame:
    """The keys that occur more than once, with their row count ``n``."""
    return df.groupBy(*keys).agg(F.count(F.lit(1)).alias("n")).filter("n > 1")


def col(name: str) -> Column:
    """A column by its literal name, also when it contains dots, blanks or signs."""
    return F.col("`" + name.replace("`", "``") + "`")
