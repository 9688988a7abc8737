"""Boosted trees, with an optional share of rows that only decides when to stop."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark import keyword_only
from pyspark.ml import Estimator, Pipeline, Transformer
from pyspark.ml.feature import VectorAssembler
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasInputCols
from pyspark.ml.regression import GBTRegressor
from pyspark.ml.util import DefaultParamsReadable, DefaultParamsWritable
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from panelwise.runtime import col

HELD = "_held"
# The default settings of the boosted trees.
DEFAULTS = {"maxIter": 100, "stepSize": 0.1, "maxDepth": 5, "maxBins": 255, "minInstancesPerNode": 20, "seed": 42}


class HoldOutFlag(Transformer, HasInputCols, DefaultParamsReadable, DefaultParamsWritable):
    """Marks a share of the rows by a hash of their content, so a repeated task marks the same rows."""

    share = Param(Params._dummy(), "share", "share of marked rows", TypeConverters.toFloat)
    seed = Param(Params._dummy(), "seed", "seed", TypeConverters.toInt)

    @keyword_only
    def __init__(self, *, inputCols=None, share=0.1, seed=42):
        super().__init__()
        self._setDefault(share=0.1, seed=42)
        self._set(**{k: v for k, v in self._input_kwargs.items() if v is not None})

    def _transform(self, df: DataFrame) -> DataFrame:
        draw = F.pmod(F.xxhash64(F.lit(self.getOrDefault("seed")), *[col(c) for c in self.getInputCols()]), F.lit(1_000_000))
        return df.withColumn(HELD, draw < F.lit(int(self.getOrDefault("share") * 1_000_000)))


def boosted_trees(features: Sequence[str], label: str = "ret", validation: float = 0.1, validation_tol: float = 1e-7, **params) -> Estimator:
    """Gradient-boosted trees; growing stops once the held-out share of rows no longer gains. ``validation=0`` grows all rounds."""
    settings = {**DEFAULTS, **params}
    stages = [VectorAssembler(inputCols=list(features), outputCol="features", handleInvalid="keep")]
    if validation:
        stages.append(HoldOutFlag(inputCols=list(features), share=validation, seed=settings["seed"]))
        settings.update(validationIndicatorCol=HELD, validationTol=validation_tol)
    return Pipeline(stages=[*stages, GBTRegressor(featuresCol="features", labelCol=label, **settings)])
