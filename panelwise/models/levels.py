"""Least squares and ridge with a column of any number of levels, without a column per level.

A one-hot block has a diagonal cross product: level by level, its coefficient follows from the others. So the block is never
built. One aggregate keeps per level the sums of (1, features, label); eliminating all levels takes from the small cross-product matrix of the
features the sum over levels of u u' / (n + alpha), u being a level's sums, and what is left is solved on the driver. The
level's coefficients go back into a table, which scoring looks up. Neither the driver nor a task ever holds the levels, and
the result is that of the full one-hot design.

A missing level, or one that training has not seen, has no column: its coefficient is 0. The intercept is not penalised.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.stat import Summarizer
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsReader, DefaultParamsWritable, DefaultParamsWriter, MLReadable, MLReader, MLWritable, MLWriter
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwise.models.gram import moments_by_fold
from panelwise.models.linear import RIDGE_ALPHAS, dot
from panelwise.runtime import col, lookup_join, stage_table

KINDS = ("ols", "ridge", "ridge_cv")


def level_sums(df: DataFrame, features: Sequence[str], label: str, level: str) -> DataFrame:
    """(level, u): per level the sums of 1, the features and the label, as an array."""
    row = [F.lit(1.0), *[col(c).cast("double") for c in features], col(label).cast("double")]
    known = df.filter(col(level).isNotNull())
    # One plain sum per column: there can be as many levels as rows, and each vector that is summed would be an object of its own.
    sums = known.groupBy(col(level).alias("level")).agg(*[F.sum(x).alias(f"u{i}") for i, x in enumerate(row)])
    return sums.select("level", F.array(*[f"u{i}" for i in range(len(row))]).alias("u"))


def eliminated(levels: DataFrame, size: int, alphas: Sequence[float]) -> np.ndarray:
    """Per penalty the sum over levels of u u' / (n + alpha): matrices of the tasks, added up."""

    def reduce_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums = np.zeros((len(alphas), size, size))
        for batch in batches:
            column = batch.column(0)
            u = column.flatten().to_numpy().reshape(len(column), size)
            for a, alpha in enumerate(alphas):
                sums[a] += u.T @ (u / (u[:, :1] + alpha))
        keys = [(a, i) for a in range(len(alphas)) for i in range(size)]
        yield pa.RecordBatch.from_arrays([pa.array([a for a, _ in keys], pa.int32()), pa.array([i for _, i in keys], pa.int32()), pa.array(list(sums.reshape(-1, size)), pa.list_(pa.float64()))], names=["a", "i", "v"])

    parts = levels.select("u").mapInArrow(reduce_task, "a int, i int, v array<double>")
    added = parts.groupBy("a", "i").agg(vector_to_array(Summarizer.sum(array_to_vector("v"))).alias("v"))
    out = np.zeros((len(alphas), size, size))
    for r in added.collect():
        out[r["a"], r["i"]] = r["v"]
    return out


class LevelFit(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """kind ``ols``; ``ridge`` with ``alpha``; ``ridge_cv`` by leave-one-out over ``alphas``. ``levelCol`` stands for one column per level of it."""

    kind = Param(Params._dummy(), "kind", "which model", TypeConverters.toString)
    alpha = Param(Params._dummy(), "alpha", "penalty", TypeConverters.toFloat)
    alphas = Param(Params._dummy(), "alphas", "penalties to choose from", TypeConverters.toListFloat)
    levelCol = Param(Params._dummy(), "levelCol", "column of levels", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "label", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, inputCols=None, levelCol=None, kind="ridge", alpha=1.0, alphas=RIDGE_ALPHAS, labelCol="ret"):
        super().__init__()
        self._setDefault(kind="ridge", alpha=1.0, alphas=list(RIDGE_ALPHAS), labelCol="ret")
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        if self.getOrDefault("kind") not in KINDS:
            raise ValueError(f"kind must be one of {KINDS}")

    def _fit(self, df: DataFrame) -> LevelFitModel:
        names, label, level, kind = self.getInputCols(), self.getOrDefault("labelCol"), self.getOrDefault("levelCol"), self.getOrDefault("kind")
        alphas = [0.0] if kind == "ols" else list(self.getOrDefault("alphas")) if kind == "ridge_cv" else [self.getOrDefault("alpha")]
        levels = stage_table(level_sums(df, names, label, level))
        z = moments_by_fold(df, names, label)[0].z
        solved = []
        for alpha, gone in zip(alphas, eliminated(levels, len(z), alphas)):
            left = z - gone + alpha * np.diag([0.0, *[1.0] * len(names), 0.0])
            # Without a penalty a full set of levels leaves nothing for the intercept.
            inverse = np.linalg.pinv(left[:-1, :-1], rcond=1e-12, hermitian=True)
            solved.append((alpha, inverse @ left[:-1, -1], inverse))
        if kind == "ridge_cv":
            errors = leave_one_out(df, names, label, level, levels, solved)
            solved = [solved[int(np.argmin(errors))]]
        alpha, theta, _ = solved[0]
        return LevelFitModel(inputCols=names, levelCol=level, intercept=float(theta[0]), coefficients=theta[1:].tolist(), alpha=float(alpha))._with(level_coefficients(levels, theta, alpha))


def level_coefficients(levels: DataFrame, theta: np.ndarray, alpha: float) -> DataFrame:
    """(level, effect): what the others leave of the level's label sum, over its rows and the penalty."""
    weights = F.array(*[F.lit(float(-t)) for t in theta], F.lit(1.0))
    left = F.aggregate(F.zip_with("u", weights, lambda a, b: a * b), F.lit(0.0), lambda s, x: s + x)
    return stage_table(levels.select("level", (left / (F.get("u", F.lit(0)) + alpha)).alias("effect")))


def leave_one_out(df: DataFrame, names: Sequence[str], label: str, level: str, levels: DataFrame, solved: Sequence[tuple[float, np.ndarray, np.ndarray]]) -> np.ndarray:
    """Mean squared leave-one-out error per penalty, in one pass: each row with its level's sums gives its residual and its leverage."""
    rows = df.select(col(level).alias("level"), F.array(F.lit(1.0), *[col(c).cast("double") for c in names], col(label).cast("double")).alias("z"))
    both = lookup_join(rows, levels, ["level"], "left")
    size = len(names) + 2

    def reduce_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums, n = np.zeros(len(solved)), 0
        for batch in batches:
            z = batch.column(0).flatten().to_numpy().reshape(-1, size)
            known = batch.column(1).is_valid().to_numpy(zero_copy_only=False)
            u = np.zeros_like(z)
            u[known] = batch.column(1).drop_null().flatten().to_numpy().reshape(-1, size)
            n += len(z)
            for a, (alpha, theta, inverse) in enumerate(solved):
                weight = np.where(known, u[:, 0] + alpha, 1.0)
                part = z - u / weight[:, None]
                residual = part[:, -1] - part[:, :-1] @ theta
                leverage = np.einsum("ij,jk,ik->i", part[:, :-1], inverse, part[:, :-1]) + np.where(known, 1.0 / weight, 0.0)
                sums[a] += ((residual / (1.0 - leverage)) ** 2).sum()
        yield pa.RecordBatch.from_arrays([pa.array([n], pa.int64()), pa.array([sums.tolist()], pa.list_(pa.float64()))], names=["n", "v"])

    done = both.select("z", "u").mapInArrow(reduce_task, "n long, v array<double>").agg(F.sum("n").alias("n"), vector_to_array(Summarizer.sum(array_to_vector("v"))).alias("v")).first()
    return np.array(done["v"]) / max(done["n"], 1)


class _Writer(MLWriter):
    def __init__(self, model: LevelFitModel):
        super().__init__()
        self.model = model

    def saveImpl(self, path: str) -> None:
        DefaultParamsWriter.saveMetadata(self.model, path, self.sparkSession)
        self.model.effects.write.parquet(f"{path}/effects")


class _Reader(MLReader):
    def load(self, path: str) -> LevelFitModel:
        spark = SparkSession.active()
        metadata = DefaultParamsReader.loadMetadata(path, spark)
        model = LevelFitModel()
        model._resetUid(metadata["uid"])
        DefaultParamsReader.getAndSetParams(model, metadata)
        return model._with(spark.read.parquet(f"{path}/effects"))


class LevelFitModel(Model, HasInputCols, MLWritable, MLReadable):
    """``effects(level, effect)`` is a table; the rest are parameters."""

    levelCol = Param(Params._dummy(), "levelCol", "column of levels", TypeConverters.toString)
    coefficients = Param(Params._dummy(), "coefficients", "coefficients of the features", TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "intercept", TypeConverters.toFloat)
    alpha = Param(Params._dummy(), "alpha", "penalty used", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, levelCol=None, coefficients=None, intercept=0.0, alpha=0.0):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})
        self.effects: DataFrame | None = None

    def _with(self, effects: DataFrame) -> LevelFitModel:
        self.effects = effects
        return self

    def write(self) -> MLWriter:
        return _Writer(self)

    @classmethod
    def read(cls) -> MLReader:
        return _Reader()

    def _transform(self, df: DataFrame) -> DataFrame:
        level = self.getOrDefault("levelCol")
        effects = self.effects.select(F.col("level").alias(level), F.col("effect").alias("_effect"))
        line = dot(self.getOrDefault("intercept"), self.getInputCols(), self.getOrDefault("coefficients"))
        joined = lookup_join(df, effects, [level], "left").withColumn("prediction", line + F.coalesce("_effect", F.lit(0.0)))
        return joined.select(*[col(c) for c in df.columns if c != "prediction"], "prediction")
