"""Choosing the columns and putting the preprocessing stages together."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.ml import Estimator, Pipeline, PipelineModel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from panelwise.prep.stages import CrossSectionalImputer, ModeImputer, OneHot, OneHotModel, PopScaler, PopScalerModel, Winsorizer
from panelwise.runtime import col

# Columns that are never features, and the factors that always are.
EXCLUDED = ("ret", "yyyymm_signals", "permno", "_merge", "sinAlgo")
FACTOR_FEATURES = ("mkt_excess", "SMB", "HML", "RMW", "CMA", "Mom")


def route_columns(
    df: DataFrame, doc: DataFrame, extra_continuous: Sequence[str] = FACTOR_FEATURES, exclude: Sequence[str] = EXCLUDED
) -> tuple[list[str], list[str]]:
    """The continuous and the discrete feature columns of ``df`` according to the signal documentation."""
    described = doc.select("Acronym", col("Cat.Form").alias("form")).distinct()
    wanted = described.join(
        df.sparkSession.createDataFrame([(c,) for c in df.columns], "Acronym string"), "Acronym", "left_semi"
    ).filter(F.col("form").isin("continuous", "discrete"))
    form = {r["Acronym"]: r["form"] for r in wanted.collect()}
    usable = [c for c in df.columns if c not in exclude]
    continuous = [c for c in usable if form.get(c) == "continuous"] + [c for c in extra_continuous if c in usable and form.get(c) != "continuous"]
    return continuous, [c for c in usable if form.get(c) == "discrete"]


def build_preprocessor(
    continuous: Sequence[str],
    discrete: Sequence[str] = (),
    lower: float = 0.0025,
    upper: float = 0.9975,
    by: str = "year",
    date: str = "date",
    exact: bool = True,
    impute: bool = True,
) -> Pipeline:
    """Impute, winsorize and scale continuous columns; impute and one-hot encode discrete ones.

    ``impute=False`` leaves out the continuous imputation, for frames that were filled before.
    """
    stages = []
    if continuous:
        numbers = list(continuous)
        stages += [CrossSectionalImputer(inputCols=numbers, dateCol=date, by=by)] if impute else []
        stages += [
            Winsorizer(inputCols=numbers, lower=lower, upper=upper, exact=exact),
            PopScaler(inputCols=numbers),
        ]
    if discrete:
        stages += [ModeImputer(inputCols=list(discrete)), OneHot(inputCols=list(discrete))]
    return Pipeline(stages=stages)


def fit_prepare(pipeline: Pipeline, train: DataFrame) -> tuple[PipelineModel, DataFrame]:
    """Fit the stages and prepare the training frame in one go, so that no stage reads it twice."""
    fitted = []
    for stage in pipeline.getStages():
        fitted.append(stage.fit(train) if isinstance(stage, Estimator) else stage)
        train = fitted[-1].transform(train)
    return PipelineModel(stages=fitted), train


def feature_names(fitted: PipelineModel) -> list[str]:
    """The feature columns a fitted preprocessor produces, numbers first."""
    names = []
    for stage in fitted.stages:
        if isinstance(stage, PopScalerModel):
            names += stage.getInputCols()
    for stage in fitted.stages:
        if isinstance(stage, OneHotModel):
            names += stage.output_columns()
    return names


def column_routes(fitted: PipelineModel) -> DataFrame:
    """``(transformer, column)``: which column goes through which group of stages."""
    rows = []
    for stage in fitted.stages:
        if isinstance(stage, PopScalerModel):
            rows += [("numbers", c) for c in stage.getInputCols()]
        elif isinstance(stage, OneHotModel):
            rows += [("categoricals", c) for c in dict.fromkeys(stage.getInputCols())]
    return SparkSession.active().createDataFrame(rows, "transformer string, column string")
