"""What a fitted pipeline relies on."""

from __future__ import annotations

from pyspark.ml import PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwise.models.linear import LinearFitModel
from panelwise.models.trees import LeafwiseModel


def _table(pairs: list[tuple[str, float]], value: str) -> DataFrame:
    return SparkSession.active().createDataFrame(pairs, f"feature string, {value} double")


def coefficients(model: PipelineModel | LinearFitModel, n: int | None = 20) -> DataFrame:
    """``(feature, coefficient)`` of a linear model, the largest in absolute value first."""
    last = model.stages[-1] if isinstance(model, PipelineModel) else model
    if not isinstance(last, LinearFitModel):
        raise ValueError(f"{type(last).__name__} has no coefficients")
    pairs = list(zip(last.getInputCols(), last.getOrDefault("coefficients")))
    ranked = _table(pairs, "coefficient").orderBy(F.abs("coefficient").desc(), "feature")
    return ranked if n is None else ranked.limit(n)


def importances(model: PipelineModel, n: int | None = 20) -> DataFrame:
    """``(feature, importance)`` of a tree model, the most important first."""
    last = model.stages[-1]
    if not hasattr(last, "featureImportances"):
        raise ValueError(f"{type(last).__name__} has no feature importances")
    names = (last if isinstance(last, LeafwiseModel) else model.stages[-2]).getInputCols()
    ranked = _table(list(zip(names, [float(v) for v in last.featureImportances.toArray()])), "importance")
    ranked = ranked.orderBy(F.col("importance").desc(), "feature")
    return ranked if n is None else ranked.limit(n)
