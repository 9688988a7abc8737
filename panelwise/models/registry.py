"""Model names and how to build them; add an entry to add a model."""

from __future__ import annotations

from collections.abc import Callable, Mapping, Sequence
from itertools import product

from pyspark.ml import Estimator, Pipeline

from panelwise.models.boosting import boosted_trees
from panelwise.models.levels import LevelFit
from panelwise.models.linear import LinearFit
from panelwise.models.network import NetworkRegressor
from panelwise.models.trees import LeafwiseTrees

Factory = Callable[..., Estimator]


def _linear(kind: str) -> Factory:
    def build(features: Sequence[str], label: str = "ret", **params) -> Estimator:
        return LinearFit(inputCols=list(features), kind=kind, labelCol=label, **params)

    return build


def _network(features: Sequence[str], label: str = "ret", **params) -> Estimator:
    return NetworkRegressor(inputCols=list(features), labelCol=label, **params)


def _trees(features: Sequence[str], label: str = "ret", **params) -> Estimator:
    return Pipeline(stages=[LeafwiseTrees(inputCols=list(features), labelCol=label, **params)])


# Model names and the layer sizes tried for the network.
MODEL_REGISTRY: dict[str, Factory] = {
    "OLS": _linear("ols"),
    "Lasso": _linear("lasso"),
    "Ridge": _linear("ridge"),
    "LassoCV": _linear("lasso_cv"),
    "RidgeCV": _linear("ridge_cv"),
    "hgbr": _trees,
    "mlp": _network,
}
def _levels(features: Sequence[str], label: str = "ret", **params) -> Estimator:
    return LevelFit(inputCols=list(features), labelCol=label, **params)


#: Models that can be asked for by name, but are no default variants: trees grown level by level, linear models with a column of any number of levels.
OTHER_MODELS: dict[str, Factory] = {"gbt": boosted_trees, "levels": _levels}
PARAM_GRIDS: dict[str, dict[str, list]] = {"mlp": {"hidden": [(64, 32), (32, 16, 8), (128, 64, 32)]}}


def expand_grid(name: str, grid: Mapping[str, Sequence] | None = None) -> list[tuple[str, dict]]:
    """``(variant name, parameters)`` for every point of a grid; no grid means one variant.

    Only a sequence-valued parameter is spelled out in the name, as in ``mlp-64-32``; other settings keep
    the model's own name, so they must not vary.
    """
    grid = PARAM_GRIDS.get(name, {}) if grid is None else grid
    variants = []
    for values in product(*grid.values()):
        setting = dict(zip(grid, values))
        layers = [str(x) for v in values if isinstance(v, (tuple, list)) for x in v]
        variants.append(("-".join([name, *layers]), {k: list(v) if isinstance(v, tuple) else v for k, v in setting.items()}))
    if len({v for v, _ in variants}) < len(variants):
        raise ValueError(f"the grid of {name} gives two variants the same name")
    return variants


def build_model(name: str, features: Sequence[str], label: str = "ret", **params) -> Estimator:
    return (MODEL_REGISTRY.get(name) or OTHER_MODELS[name])(features, label, **params)


def with_levels(variants: Sequence[tuple[str, str, dict]], level: str) -> list[tuple[str, str, dict]]:
    """The variants with their linear models given the levels of a column, too. The lasso cannot do without a column per level."""
    kinds = {"OLS": "ols", "Ridge": "ridge", "RidgeCV": "ridge_cv"}
    refused = [v for v, name, _ in variants if name in ("Lasso", "LassoCV")]
    if refused:
        raise ValueError(f"{refused}: the lasso takes discrete columns one-hot encoded only")
    return [(v, "levels", {"kind": kinds[name], "levelCol": level, **params}) if name in kinds else (v, name, params) for v, name, params in variants]


def default_variants() -> list[tuple[str, str, dict]]:
    """``(variant, model, parameters)`` of all nine default variants."""
    return [(variant, name, params) for name in MODEL_REGISTRY for variant, params in expand_grid(name)]
