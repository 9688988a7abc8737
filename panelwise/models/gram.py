"""One distributed pass turns a training window into a small cross-product matrix per fold.

Every linear model here depends on the data only through these matrices, so five models share one
pass instead of taking many passes each.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence
from dataclasses import dataclass
from decimal import Decimal

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from panelwise.operators.order_stats import GUIDE_ROWS, order_statistics
from panelwise.runtime import col, fewer_tasks


# Cross products that tasks and the driver hold per fold, at most.
MAX_MATRIX_BYTES = 128 * 1024 * 1024


@dataclass(frozen=True)
class Moments:
    """Cross products of (1, features, label) over some rows."""

    z: np.ndarray

    def __add__(self, other: Moments) -> Moments:
        return Moments(self.z + other.z)

    def __sub__(self, other: Moments) -> Moments:
        return Moments(self.z - other.z)

    @property
    def n(self) -> float:
        return float(self.z[0, 0])

    @property
    def mean_x(self) -> np.ndarray:
        return self.z[0, 1:-1] / self.n

    @property
    def mean_y(self) -> float:
        return float(self.z[0, -1] / self.n)

    @property
    def xx(self) -> np.ndarray:
        """Centred feature products."""
        return self.z[1:-1, 1:-1] - self.n * np.outer(self.mean_x, self.mean_x)

    @property
    def xy(self) -> np.ndarray:
        return self.z[1:-1, -1] - self.n * self.mean_x * self.mean_y

    @property
    def yy(self) -> float:
        return float(self.z[-1, -1] - self.n * self.mean_y**2)

    def intercept(self, coef: np.ndarray) -> float:
        return float(self.mean_y - self.mean_x @ coef)

    def squared_error(self, coef: np.ndarray, intercept: float) -> float:
        """Sum of squared residuals of a fit over these rows."""
        w = np.concatenate([[-intercept], -np.asarray(coef), [1.0]])
        return float(max(w @ self.z @ w, 0.0))


def too_wide(features: int) -> bool:
    """Are there more features than a matrix of their cross products may have?"""
    return (features + 2) ** 2 * 8 > MAX_MATRIX_BYTES


def matrix_of(batch: pa.RecordBatch) -> np.ndarray:
    return np.column_stack([c.to_numpy(zero_copy_only=False) for c in batch.columns]).astype(float)


def moments_by_fold(df: DataFrame, features: Sequence[str], label: str, fold: Column | None = None) -> dict[int, Moments]:
    """Cross products per fold. Each task reduces its rows to one matrix per fold; matrix rows are added up in parallel."""
    features = list(features)
    size = len(features) + 2
    if too_wide(len(features)):
        raise ValueError(f"{len(features)} features: their cross products exceed {MAX_MATRIX_BYTES} bytes")
    rows = df.select(
        (F.lit(0) if fold is None else fold).cast("int").alias("fold"),
        *[col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(features)],
        col(label).cast("double").alias("_y"),
    )

    def reduce_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        sums: dict[int, np.ndarray] = {}
        for batch in batches:
            table = matrix_of(batch)
            folds, z = table[:, 0].astype(int), table.copy()
            z[:, 0] = 1.0
            for f in np.unique(folds):
                part = z[folds == f]
                sums[f] = sums.get(f, 0.0) + part.T @ part
        for f, z in sums.items():
            yield pa.RecordBatch.from_pydict(
                {"fold": pa.array([f] * size, pa.int32()), "i": pa.array(range(size), pa.int32()), "v": pa.array(list(z), pa.list_(pa.float64()))}
            )

    partial = fewer_tasks(rows, size * size * 8).mapInArrow(reduce_task, "fold int, i int, v array<double>")
    added = partial.groupBy("fold", "i").agg(Summarizer.sum(array_to_vector("v")).alias("v"))
    out: dict[int, np.ndarray] = {}
    for r in added.select("fold", "i", vector_to_array("v").alias("v")).collect():
        out.setdefault(r["fold"], np.zeros((size, size)))[r["i"]] = r["v"]
    return {f: Moments(z) for f, z in out.items()}


def row_order_key(entity: str = "permno", date: str = "date") -> Column:
    """A whole number that orders rows by (entity, date). Entities are whole numbers of any size."""
    key = F.col(entity).cast("decimal(38,0)") * F.lit(Decimal(100_000)).cast("decimal(6,0)") + (F.year(date) * 12 + F.month(date)).cast("decimal(6,0)")
    return key.cast("decimal(38,0)")


def fold_ends(n: Column, k: int) -> list[Column]:
    """Ranks of the last rows of all blocks but the last, when ``n`` rows are cut into ``k`` blocks; the first ``n mod k`` have one row more."""
    return [F.floor(n / F.lit(k)) * i + F.least(F.lit(i), F.pmod(n, F.lit(k))) for i in range(1, k)]


def row_order_folds(df: DataFrame, k: int, entity: str = "permno", date: str = "date") -> Column:
    """Fold of each row when the rows, ordered by (entity, date), are cut into ``k`` contiguous blocks."""
    key = row_order_key(entity, date)
    keys, n = df.select(F.lit(0).alias("_all"), key.alias("_key")), df.count()
    sizes = df.sparkSession.createDataFrame([(0, n, n)], "_all int, n long, m long"), True
    share = GUIDE_ROWS / max(n, 1)
    guide = keys.sample(share, seed=1) if share < 0.5 else None
    found = order_statistics(keys, ["_all"], "_key", lambda n, m: fold_ends(n, k), sizes=sizes, guide=guide).first()
    fold = F.lit(0)
    for last in found["stats"]:
        if last is not None:
            fold = fold + (key > F.lit(last).cast("decimal(38,0)")).cast("int")
    return fold


def entity_folds(k: int, entity: str = "permno") -> Column:
    """Fold by a hash of the entity, for entities that are not numbers."""
    return F.pmod(F.xxhash64(entity), F.lit(k)).cast("int")
