"""The lasso on more features than a cross-product matrix can hold.

Few features have a coefficient. A round takes one scan for the slope of every feature at the fit so far, adds
those whose slope exceeds the penalty, the steepest first, and solves exactly on the features in use from their cross products. When no
feature outside exceeds the penalty, the conditions of the optimum hold for all, so the fit is the one on all features.
Tasks and the driver hold one number per feature, and the matrix of the features in use.
"""

from __future__ import annotations

from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.ml.functions import array_to_vector, vector_to_array
from pyspark.ml.stat import Summarizer
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwise.models import gram
from panelwise.models.gram import matrix_of, moments_by_fold
from panelwise.runtime import col

#: Features that one round takes in, at most.
ROUND = 300
#: A slope this much above the penalty, in shares of it, does not count as above.
SLACK = 1e-7


def slopes(df: DataFrame, features: Sequence[str], label: str, used: Sequence[int], coef: np.ndarray, intercept: float) -> tuple[np.ndarray, float]:
    """Per feature the sum of its values times the residuals, and the sum of the residuals, over the rows' number; one scan."""
    width = len(features)

    def reduce_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(width + 2)
        for batch in batches:
            table = matrix_of(batch)
            x, y = table[:, :-1], table[:, -1]
            left = y - intercept - x[:, used] @ coef
            total += np.concatenate([x.T @ left, [left.sum(), len(left)]])
        yield pa.RecordBatch.from_arrays([pa.array([total.tolist()], pa.list_(pa.float64()))], names=["v"])

    rows = df.select(*[col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(features)], col(label).cast("double").alias("_y"))
    summed = rows.mapInArrow(reduce_task, "v array<double>").agg(vector_to_array(Summarizer.sum(array_to_vector(F.col("v")))).alias("v")).first()["v"]
    v = np.array(summed)
    return v[:-2] / max(v[-1], 1.0), v[-2] / max(v[-1], 1.0)


def solve_screened(df: DataFrame, features: Sequence[str], label: str, alpha: float, solve) -> tuple[np.ndarray, float]:
    """Coefficients and intercept; ``solve(moments, alpha)`` is the exact solver for the features in use."""
    features = list(features)
    intercept = df.agg(F.avg(col(label).cast("double"))).first()[0] or 0.0
    used: list[int] = []
    coef = np.zeros(0)
    while True:
        slope, _ = slopes(df, features, label, used, coef, intercept)
        slope[used] = 0.0
        more = np.flatnonzero(np.abs(slope) > alpha * (1 + SLACK))
        if not len(more):
            out = np.zeros(len(features))
            out[used] = coef
            return out, intercept
        # Features that dropped out again make room.
        used = [j for j, w in zip(used, coef) if w] + more[np.argsort(-np.abs(slope[more]), kind="stable")][:ROUND].tolist()
        if (len(used) + 2) ** 2 * 8 > gram.MAX_MATRIX_BYTES:
            raise ValueError(f"more than {len(used)} features have a coefficient: their cross products exceed {gram.MAX_MATRIX_BYTES} bytes")
        m = moments_by_fold(df, [features[j] for j in used], label)[0]
        coef = solve(m, alpha)
        intercept = m.intercept(coef)
