"""Stored predictions and fitted models."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce
from urllib.parse import unquote

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwise.functions.columns import move_to_front
from panelwise.runtime import drop_staged, guard_unique, only, stage_table

KEYS = ("permno", "date", "model")


def path_exists(spark: SparkSession, path: str) -> bool:
    """Whether a path exists on whatever file system its scheme names."""
    jvm = spark.sparkContext._jvm
    hadoop_path = jvm.org.apache.hadoop.fs.Path(path)
    return hadoop_path.getFileSystem(spark.sparkContext._jsc.hadoopConfiguration()).exists(hadoop_path)


def write_predictions(predictions: DataFrame, path: str) -> None:
    """Store ``(permno, date, ret, model, pred)`` by model and year; only the partitions present in the input are replaced."""
    laid_out = predictions.withColumn("year", F.year("date"))
    writer = laid_out.write.mode("overwrite").option("partitionOverwriteMode", "dynamic")
    writer.partitionBy("model", "year").parquet(path)


def store_predictions(new: DataFrame, path: str) -> None:
    """Merge predictions into a store: new rows win, stored rows of the same models and years fill in.

    Only the partitions that the new rows touch are read and written again.
    """
    spark = new.sparkSession
    if not path_exists(spark, path):
        write_predictions(new, path)
        return
    new = stage_table(new)
    touched = new.select("model", F.year("date").alias("year")).distinct().collect()
    if not touched:
        drop_staged(new)
        return
    stored = spark.read.schema("permno long, date date, ret double, pred double, model string, year int").parquet(path)
    same = reduce(lambda a, b: a | b, [(F.col("model") == r["model"]) & (F.col("year") == r["year"]) for r in touched])
    old = stored.filter(same).select("permno", "date", "ret", "model", "pred")
    # The rows to be replaced are read before they are overwritten.
    merged = stage_table(upsert_predictions(new.select(old.columns), old))
    write_predictions(merged, path)
    drop_staged(new, merged)


def read_predictions(spark: SparkSession, path: str) -> DataFrame:
    stored = spark.read.schema("permno long, date date, ret double, pred double, model string, year int").parquet(path)
    return stored.select("permno", "date", "ret", "model", "pred")


def finished_models(spark: SparkSession, path: str) -> list[str]:
    """Names of the models with stored predictions."""
    if not path_exists(spark, path):
        return []
    return sorted({model for model, _ in finished_pairs(spark, path)})


def finished_pairs(spark: SparkSession, path: str) -> set[tuple[str, int]]:
    """The (model, year) pairs that have files in a store, from the names of its folders; no rows are read."""
    if not path_exists(spark, path):
        return set()
    files = spark.read.schema("permno long, model string, year int").parquet(path).inputFiles()
    found = set()
    for f in files:
        parts = dict(p.split("=", 1) for p in f.split("/") if "=" in p)
        found.add((unquote(unquote(parts["model"])), int(parts["year"])))
    return found


def upsert_predictions(new: DataFrame, old: DataFrame, keys: Sequence[str] = KEYS) -> DataFrame:
    """New rows win, old rows fill what is missing; each side must hold a key once."""
    keys = list(keys)
    values = [c for c in dict.fromkeys([*new.columns, *old.columns]) if c not in keys]
    a = guard_unique(new, keys, "new predictions").alias("a")
    b = guard_unique(old, keys, "old predictions").alias("b")

    def pick(c: str):
        sides = [F.col(f"{s}.`{c}`") for s, df in (("a", new), ("b", old)) if c in df.columns]
        return F.coalesce(*sides).alias(c)

    on = reduce(lambda x, y: x & y, [F.col(f"a.`{k}`") == F.col(f"b.`{k}`") for k in keys])
    return a.join(b, on, "full_outer").select(*[pick(c) for c in [*keys, *values]])


def predictions_wide(predictions: DataFrame, models: Sequence[str]) -> DataFrame:
    """One row per (permno, date, ret), one column ``pred_<model>`` per model, for delivery."""
    pivot = predictions.groupBy("permno", "date", "ret").pivot("model", list(models)).agg(only("pred"))
    named = pivot.withColumnsRenamed({m: f"pred_{m}" for m in models})
    return move_to_front(named, ["permno", "date", "ret"])


def merge_wide_predictions(frames: Sequence[DataFrame], on: Sequence[str] = ("permno", "date", "ret")) -> DataFrame:
    """Full outer join of several wide prediction tables."""
    return reduce(lambda left, right: left.join(right, list(on), "full_outer"), frames)


def model_path(folder: str, name: str) -> str:
    return f"{folder}/{name}"


def save_model(model: PipelineModel, folder: str, name: str) -> None:
    model.write().overwrite().save(model_path(folder, name))


def load_model(folder: str, name: str) -> PipelineModel:
    return PipelineModel.load(model_path(folder, name))


def model_saved(spark: SparkSession, folder: str, name: str) -> bool:
    return path_exists(spark, f"{model_path(folder, name)}/metadata")
