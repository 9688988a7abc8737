"""Linear models solved from cross products; scoring is a plain column expression."""

from __future__ import annotations

from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark import keyword_only
from pyspark.ml import Estimator, Model
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwise.models.gram import Moments, entity_folds, matrix_of, moments_by_fold, row_order_folds, too_wide
from panelwise.models.screened import solve_screened
from panelwise.runtime import col

KINDS = ("ols", "ridge", "lasso", "ridge_cv", "lasso_cv")
# The penalties ridge_cv chooses from, and the shape of the lasso_cv grid.
RIDGE_ALPHAS = (0.1, 1.0, 10.0)
LASSO_GRID_RATIO = 1e-3
LASSO_FOLDS = 5


def solve_ols(m: Moments) -> np.ndarray:
    """Least squares of smallest norm: with a full set of one-hot columns only the predictions are unique."""
    return np.linalg.pinv(m.xx, rcond=1e-12, hermitian=True) @ m.xy


def solve_ridge(m: Moments, alpha: float) -> np.ndarray:
    """Minimises the residual sum of squares plus alpha times the squared norm; the intercept is free."""
    return np.linalg.solve(m.xx + alpha * np.eye(len(m.xy)), m.xy)


def solve_lasso(m: Moments, alpha: float, start: np.ndarray | None = None, sweeps: int = 10_000, tol: float = 1e-10) -> np.ndarray:
    """Minimises the residual sum of squares / 2n plus alpha times the absolute norm, one coefficient at a time."""
    xx, xy = m.xx / m.n, m.xy / m.n
    coef = np.zeros(len(xy)) if start is None else start.copy()
    slope = xy - xx @ coef
    movable = np.flatnonzero(np.diag(xx) > 0)
    among, everything = movable, True
    for _ in range(sweeps):
        largest = 0.0
        for j in among:
            pull = slope[j] + xx[j, j] * coef[j]
            moved = np.sign(pull) * max(abs(pull) - alpha, 0.0) / xx[j, j] - coef[j]
            if moved:
                coef[j] += moved
                slope -= moved * xx[:, j]
                largest = max(largest, abs(moved))
        settled = largest <= tol * max(1.0, np.abs(coef).max(initial=0.0))
        if settled and everything:
            break
        # Only the coefficients in use are moved until they settle; then all are looked at again.
        everything = settled
        among = movable if everything else np.flatnonzero(coef)
    return coef


def lasso_alphas(m: Moments, n_alphas: int) -> np.ndarray:
    """From the smallest penalty that zeroes everything down to a thousandth of it, evenly in logs."""
    top = float(np.abs(m.xy).max(initial=0.0) / m.n)
    if top <= 0:
        return np.full(n_alphas, np.finfo(float).resolution)
    return np.geomspace(top, top * LASSO_GRID_RATIO, n_alphas)


def fold_errors(folds: Mapping[int, Moments], grid: np.ndarray, held: int) -> np.ndarray:
    """Mean squared error on one fold of the fits to all others, along the penalties."""
    train, coef, errors = sum_moments(folds) - folds[held], None, np.zeros(len(grid))
    for i, alpha in enumerate(grid):
        coef = solve_lasso(train, alpha, coef)
        errors[i] = folds[held].squared_error(coef, train.intercept(coef)) / folds[held].n
    return errors


def choose_lasso(folds: Mapping[int, Moments], n_alphas: int, spark: SparkSession) -> float:
    """The penalty with the smallest mean over folds of the held-out mean squared error; each fold's path is one task."""
    every = sum_moments(folds)
    if any((every - held).n < 1 or held.n < 1 for held in folds.values()):
        raise ValueError("a fold leaves no rows to train on")
    grid, names = lasso_alphas(every, n_alphas), sorted(folds)
    shared = spark.sparkContext.broadcast({f: folds[f].z for f in names})

    def path(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        known = {f: Moments(z) for f, z in shared.value.items()}
        for batch in batches:
            for n in batch.column("id").to_pylist():
                yield pa.RecordBatch.from_pydict({"n": pa.array([n], pa.int64()), "errors": pa.array([fold_errors(known, grid, names[n]).tolist()], pa.list_(pa.float64()))})

    found = spark.range(0, len(names), 1, len(names)).mapInArrow(path, "n long, errors array<double>").collect()
    shared.destroy()
    errors = np.array([r["errors"] for r in sorted(found, key=lambda r: r["n"])]).sum(axis=0)
    return float(grid[int(np.argmin(errors))])


def sum_moments(folds: Mapping[int, Moments]) -> Moments:
    parts = [folds[f] for f in sorted(folds)]
    total = parts[0]
    for p in parts[1:]:
        total = total + p
    return total


@dataclass(frozen=True)
class LooTerms:
    """What the leave-one-out errors of ridge need besides the rows."""

    alphas: list[float]
    n: float
    centre: np.ndarray
    vectors: np.ndarray
    weights: np.ndarray
    coefs: np.ndarray
    intercepts: np.ndarray


def loo_terms(m: Moments, alphas: Sequence[float]) -> LooTerms:
    values, vectors = np.linalg.eigh(m.xx)
    values = np.clip(values, 0.0, None)
    fits = [solve_ridge(m, a) for a in alphas]
    return LooTerms(list(alphas), m.n, m.mean_x, vectors, np.array([1.0 / (values + a) for a in alphas]), np.array(fits), np.array([m.intercept(c) for c in fits]))


def loo_sums(terms: LooTerms, x: np.ndarray, y: np.ndarray) -> np.ndarray:
    """Sums over some rows of the squared leave-one-out errors, per penalty."""
    turned = ((x - terms.centre) @ terms.vectors) ** 2
    leverage = 1.0 / terms.n + turned @ terms.weights.T
    residual = y[:, None] - x @ terms.coefs.T - terms.intercepts
    return ((residual / (1.0 - leverage)) ** 2).sum(axis=0)


def leave_one_out_errors(df: DataFrame, features: Sequence[str], label: str, m: Moments, alphas: Sequence[float]) -> list[float]:
    """Mean squared leave-one-out error of ridge for each penalty, in one pass and without refits."""
    terms = loo_terms(m, alphas)

    def reduce_task(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = np.zeros(len(alphas))
        for batch in batches:
            table = matrix_of(batch)
            total += loo_sums(terms, table[:, :-1], table[:, -1])
        yield pa.RecordBatch.from_pydict({"a": pa.array(range(len(alphas)), pa.int32()), "sse": pa.array(total)})

    rows = df.select(*[col(c).cast("double").alias(f"_x{i}") for i, c in enumerate(features)], col(label).cast("double").alias("_y"))
    summed = rows.mapInArrow(reduce_task, "a int, sse double").groupBy("a").agg(F.sum("sse").alias("sse")).collect()
    found = {r["a"]: r["sse"] for r in summed}
    return [found.get(i, 0.0) / m.n for i in range(len(alphas))]


class LinearFit(Estimator, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """OLS, ridge or lasso, the penalised ones with a given or a cross-validated penalty.

    kind ``ols``; ``ridge`` and ``lasso`` with ``alpha``; ``ridge_cv`` by leave-one-out over ``alphas``;
    ``lasso_cv`` over ``nAlphas`` penalties and five folds, contiguous in (entity, date) order or, with
    ``foldBy='entity'``, by a hash of the entity.
    """

    kind = Param(Params._dummy(), "kind", "which model", TypeConverters.toString)
    alpha = Param(Params._dummy(), "alpha", "penalty", TypeConverters.toFloat)
    alphas = Param(Params._dummy(), "alphas", "penalties to choose from", TypeConverters.toListFloat)
    nAlphas = Param(Params._dummy(), "nAlphas", "length of the lasso grid", TypeConverters.toInt)
    foldBy = Param(Params._dummy(), "foldBy", "'row_order' or 'entity'", TypeConverters.toString)
    labelCol = Param(Params._dummy(), "labelCol", "label", TypeConverters.toString)
    entityCol = Param(Params._dummy(), "entityCol", "entity", TypeConverters.toString)
    dateCol = Param(Params._dummy(), "dateCol", "date", TypeConverters.toString)

    @keyword_only
    def __init__(
        self, *, inputCols=None, kind="ols", alpha=1.0, alphas=RIDGE_ALPHAS, nAlphas=50, foldBy="row_order", labelCol="ret", entityCol="permno", dateCol="date"
    ):
        super().__init__()
        given = {k: v for k, v in self._input_kwargs.items() if v is not None}
        self._setDefault(kind="ols", alpha=1.0, alphas=list(RIDGE_ALPHAS), nAlphas=50, foldBy="row_order", labelCol="ret", entityCol="permno", dateCol="date")
        self._set(**given)
        if self.getOrDefault("kind") not in KINDS:
            raise ValueError(f"kind must be one of {KINDS}")

    def fold_column(self, df: DataFrame) -> Column:
        if self.getOrDefault("foldBy") == "entity":
            return entity_folds(LASSO_FOLDS, self.getOrDefault("entityCol"))
        return row_order_folds(df, LASSO_FOLDS, self.getOrDefault("entityCol"), self.getOrDefault("dateCol"))

    def moments(self, df: DataFrame, folds: bool | None = None) -> dict[int, Moments]:
        need = self.getOrDefault("kind") == "lasso_cv" if folds is None else folds
        fold = self.fold_column(df) if need else None
        return moments_by_fold(df, self.getInputCols(), self.getOrDefault("labelCol"), fold)

    def _fit(self, df: DataFrame) -> LinearFitModel:
        names, alpha = self.getInputCols(), self.getOrDefault("alpha")
        if self.getOrDefault("kind") == "lasso" and too_wide(len(names)):
            coef, intercept = solve_screened(df, names, self.getOrDefault("labelCol"), alpha, solve_lasso)
            return LinearFitModel(inputCols=names, coefficients=coef.tolist(), intercept=float(intercept), alpha=float(alpha))
        return self.fit_moments(df, self.moments(df))

    def fit_moments(self, df: DataFrame, folds: Mapping[int, Moments], loo: Mapping[tuple[float, ...], list[float]] | None = None) -> LinearFitModel:
        """Solve from cross products already at hand; ``df`` is read again only by ``ridge_cv``, unless its errors are given by penalties."""
        kind, m = self.getOrDefault("kind"), sum_moments(folds)
        alpha = self.getOrDefault("alpha")
        if kind == "ols":
            alpha, coef = 0.0, solve_ols(m)
        elif kind == "ridge":
            coef = solve_ridge(m, alpha)
        elif kind == "lasso":
            coef = solve_lasso(m, alpha)
        elif kind == "ridge_cv":
            choices = self.getOrDefault("alphas")
            known = (loo or {}).get(tuple(choices))
            errors = known or leave_one_out_errors(df, self.getInputCols(), self.getOrDefault("labelCol"), m, choices)
            alpha = choices[int(np.argmin(errors))]
            coef = solve_ridge(m, alpha)
        else:
            alpha = choose_lasso(folds, self.getOrDefault("nAlphas"), df.sparkSession)
            coef = solve_lasso(m, alpha)
        return LinearFitModel(inputCols=self.getInputCols(), coefficients=coef.tolist(), intercept=m.intercept(coef), alpha=float(alpha))


def dot(intercept: float, names: Sequence[str], weights: Sequence[float]) -> Column:
    """The intercept and the weighted columns, added up in pairs, so that the expression is as deep as the logarithm of their number."""
    terms = [F.lit(intercept), *[col(c) * F.lit(w) for c, w in zip(names, weights) if w != 0.0]]
    while len(terms) > 1:
        terms = [a + b for a, b in zip(terms[::2], terms[1::2])] + ([terms[-1]] if len(terms) % 2 else [])
    return terms[0]


class LinearFitModel(Model, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    coefficients = Param(Params._dummy(), "coefficients", "coefficients", TypeConverters.toListFloat)
    intercept = Param(Params._dummy(), "intercept", "intercept", TypeConverters.toFloat)
    alpha = Param(Params._dummy(), "alpha", "penalty used", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, inputCols=None, coefficients=None, intercept=0.0, alpha=0.0):
        super().__init__()
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def score(self) -> Column:
        return dot(self.getOrDefault("intercept"), self.getInputCols(), self.getOrDefault("coefficients"))

    def _transform(self, df: DataFrame) -> DataFrame:
        return df.withColumn("prediction", self.score())
