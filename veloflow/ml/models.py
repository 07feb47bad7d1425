"""Regressors by name, with their defaults and search grids."""

from __future__ import annotations

from typing import Any

from pyspark.ml.base import Estimator
from pyspark.ml.regression import (
    GBTRegressor,
    GeneralizedLinearRegression,
    LinearRegression,
    RandomForestRegressor,
)
from pyspark.ml.tuning import ParamGridBuilder

from .trees import AdaBoostR2, CriterionForest, StoppedBoosting

# Model name -> (estimator, parameters).
MODELS: dict[str, tuple[type[Estimator], dict[str, Any]]] = {
    "Linear Regression": (LinearRegression, {}),
    "Poisson": (GeneralizedLinearRegression, {"family": "poisson", "link": "log", "maxIter": 100, "regParam": 1.0, "tol": 0.01}),
    "Poisson Regression": (GeneralizedLinearRegression, {"family": "poisson", "link": "log", "maxIter": 1000, "regParam": 1.0}),
    "Lasso Regression": (LinearRegression, {"regParam": 1.0, "elasticNetParam": 1.0, "standardization": False}),
    "ElasticNet Regression": (LinearRegression, {"regParam": 1.0, "elasticNetParam": 0.5, "standardization": False}),
    "Random Forest": (RandomForestRegressor, {"numTrees": 128, "minInstancesPerNode": 16, "maxDepth": 30, "seed": 42}),
    "Gradient Boosting": (GBTRegressor, {"maxIter": 128, "minInstancesPerNode": 16, "maxDepth": 3, "stepSize": 0.1, "seed": 42}),
    "AdaBoost Regression": (AdaBoostR2, {"maxIter": 50, "seed": 42}),
}

# Parameters that the solver above does not have -> the one that does, with its defaults.
SPECIAL: dict[str, tuple[set[str], type[Estimator], dict[str, Any]]] = {
    "Random Forest": ({"criterion", "minSamplesSplit"}, CriterionForest, {"numTrees": 128, "minSamplesSplit": 32, "seed": 42}),
    "Gradient Boosting": ({"nIterNoChange", "validationFraction", "tol", "alpha"}, StoppedBoosting, {"maxIter": 128, "nIterNoChange": 10, "minInstancesPerNode": 16, "maxDepth": 3, "stepSize": 0.1, "seed": 42}),
}

# Model name -> parameter -> values to try.
GRIDS: dict[str, dict[str, list[Any]]] = {
    "Random Forest": {"featureSubsetStrategy": ["sqrt", "log2"], "minInstancesPerNode": [8, 16, 32], "numTrees": [128]},
    "Gradient Boosting": {
        "maxIter": [128],
        "stepSize": [0.3, 0.25, 0.2, 0.15, 0.1],
        "lossType": ["squared", "absolute"],
        "featureSubsetStrategy": ["sqrt", "log2"],
        "minInstancesPerNode": [16, 32, 64],
    },
    "Poisson": {"regParam": [0.1, 1.0, 10.0], "tol": [0.1, 0.01, 0.001], "maxIter": [100]},
}


def list_models() -> list[str]:
    return list(MODELS)


def get_model(name: str, **overrides: Any) -> Estimator:
    if name not in MODELS:
        raise KeyError(f"Unknown model {name!r}; available: {list_models()}")
    kind, defaults = MODELS[name]
    if name in SPECIAL and (SPECIAL[name][0] & set(overrides) or overrides.get("lossType") == "huber"):
        _, kind, defaults = SPECIAL[name]
    return kind(**{**defaults, **overrides})


def get_grid(name: str, estimator: Estimator, grid: dict[str, list[Any]] | None = None) -> list[dict] | None:
    """Parameter maps of a model for a search, or None without a grid."""
    values = grid if grid is not None else GRIDS.get(name)
    if not values:
        return None
    builder = ParamGridBuilder()
    for param, options in values.items():
        builder = builder.addGrid(estimator.getParam(param), options)
    return builder.build()
