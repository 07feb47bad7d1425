"""Fit, search, cross-validate, compare and combine regressors."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from multiprocessing.pool import ThreadPool
from typing import Any

from pyspark import inheritable_thread_target
from pyspark.ml.base import Estimator, Model
from pyspark.ml.evaluation import Evaluator
from pyspark.ml.regression import GeneralizedLinearRegression, LinearRegression
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import DataFrame, functions as F

from ..functions.numeric import finite
from ..operators.metrics import METRICS, metric_columns, regression_metrics
from ..session import reuse
from .models import get_grid, get_model
from .preprocessing import FeaturePrep, TargetTransform, hash_bucket

LABEL = "_label"


@dataclass
class TrainedModel:
    """A fitted regressor with everything needed to score raw feature columns."""

    name: str
    model: Model
    prep: FeaturePrep
    target: TargetTransform
    features: list[str]
    best_params: dict[str, Any] = field(default_factory=dict)
    training_time_s: float = 0.0

    def predict(self, df: DataFrame, output: str = "predicted_dtv") -> DataFrame:
        """Add the prediction; rows with missing features get NULL."""
        scored = self.model.transform(self.prep.transform(df))
        value = finite(self.target.inverse(F.col("prediction")))
        extra = [c for c in scored.columns if c not in df.columns]
        return scored.withColumn("_value", value).drop(*extra).withColumnRenamed("_value", output)


class MetricEvaluator(Evaluator):
    """Any of the regression metrics on the original scale, for a Spark ML search.

    Subclass or pass another ``metric`` to score a search differently.
    """

    def __init__(self, target: TargetTransform, label: str = LABEL, metric: str = "r2") -> None:
        super().__init__()
        self.target, self.label, self.metric = target, label, metric

    def _evaluate(self, dataset: DataFrame) -> float:
        y, p = (self.target.inverse(F.col(c)) for c in (self.label, "prediction"))
        columns = dict(zip((*METRICS, "n_samples"), metric_columns(y, p)))
        return float(dataset.agg(columns[self.metric]).first()[0])

    def isLargerBetter(self) -> bool:
        return self.metric in ("r2", "sqv")


def fit_model(
    df: DataFrame,
    name: str,
    features: Sequence[str],
    target: str = "dtv",
    *,
    transform: str = "log1p",
    tune: bool = False,
    grid: Mapping[str, list[Any]] | None = None,
    folds: int = 5,
    seed: int = 42,
    key: Sequence[str] = ("id",),
    parallelism: int = 4,
    cache: bool = True,
    **params: Any,
) -> TrainedModel:
    """Fit one regressor; with ``tune`` its grid is searched by cross-validated R².

    Scalers and solver pass over the rows several times, so the needed columns are kept.
    """
    started = time.perf_counter()
    columns = list(dict.fromkeys([*features, target, *[k for k in key if k in df.columns]]))
    df = reuse(df.select(*columns)) if cache else df
    prep = FeaturePrep(list(features)).fit(df)
    tt = TargetTransform.fitted(df, target, transform)
    estimator = get_model(name, labelCol=LABEL, featuresCol="features", **params)
    kept = [k for k in key if k in df.columns]
    ready = prep.transform(df).withColumn(LABEL, tt.forward(F.col(target))).select("features", LABEL, *kept)
    iterated = cache and isinstance(estimator, GeneralizedLinearRegression)  # it reads its rows in every iteration and keeps none
    ready = reuse(ready) if iterated else ready
    best: dict[str, Any] = {}
    maps = get_grid(name, estimator, dict(grid) if grid is not None else None) if tune else None
    if maps:
        scores = _search(df, list(features), target, transform, estimator, maps, folds, seed, kept, parallelism)
        winner = max(range(len(maps)), key=lambda i: scores[i])
        best = {p.name: v for p, v in maps[winner].items()}
        model = estimator.fit(ready, maps[winner])
    else:
        model = estimator.fit(ready)
    if iterated:
        ready.unpersist()
    if cache:
        df.unpersist()
    return TrainedModel(name, model, prep, tt, list(features), best, time.perf_counter() - started)


def _search(
    df: DataFrame,
    features: list[str],
    target: str,
    transform: str,
    estimator: Estimator,
    maps: list[dict],
    folds: int,
    seed: int,
    key: Sequence[str],
    parallelism: int,
) -> list[float]:
    """Mean held-out score of each parameter map. Scalers and target transform see the other folds only."""
    spark = df.sparkSession
    folded = reuse(df.withColumn("_fold", hash_bucket(key, seed, folds).cast("int")))
    total = [0.0] * len(maps)
    for k in range(folds):
        rest, held = folded.where(F.col("_fold") != k), folded.where(F.col("_fold") == k)
        prep, tt = FeaturePrep(features).fit(rest), TargetTransform.fitted(rest, target, transform)
        fit_on, score_on = (reuse(prep.transform(part).withColumn(LABEL, tt.forward(F.col(target))).select("features", LABEL)) for part in (rest, held))
        evaluator = MetricEvaluator(tt)

        def score(params: dict) -> float:
            return evaluator.evaluate(estimator.fit(fit_on, params).transform(score_on))

        with ThreadPool(parallelism) as pool:
            found = pool.map(inheritable_thread_target(spark)(score), maps)
        total = [t + s for t, s in zip(total, found, strict=True)]
        fit_on.unpersist()
        score_on.unpersist()
    folded.unpersist()
    return [t / folds for t in total]


def out_of_fold(
    df: DataFrame,
    name: str,
    features: Sequence[str],
    target: str = "dtv",
    *,
    folds: int = 5,
    seed: int = 42,
    key: Sequence[str] = ("id",),
    output: str = "y_pred",
    **params: Any,
) -> DataFrame:
    """Each row predicted by a model that did not see its fold (column ``fold``)."""
    folded = reuse(df.withColumn("fold", hash_bucket(key, seed, folds).cast("int")))
    parts = None
    for k in range(folds):
        trained = fit_model(folded.where(F.col("fold") != k), name, features, target, seed=seed, key=key, cache=False, **params)
        part = trained.predict(folded.where(F.col("fold") == k), output)
        parts = part if parts is None else parts.unionByName(part)
    return parts


def fold_scores(oof: DataFrame, target: str = "dtv", predicted: str = "y_pred") -> DataFrame:
    """Metrics averaged over folds, with the deviation of R²."""
    per_fold = regression_metrics(oof, target, predicted, by=["fold"])
    return per_fold.agg(
        F.avg("r2").alias("r2_cv"), F.stddev_pop("r2").alias("r2_std"), *[F.avg(m).alias(m) for m in METRICS if m != "r2"]
    )


def overfitting_risk(gap):
    """low below 0.05, moderate below 0.10, else high."""
    return F.when(gap < 0.05, "low").when(gap < 0.10, "moderate").otherwise("high")


def cross_validate(
    df: DataFrame,
    name: str,
    features: Sequence[str],
    target: str = "dtv",
    *,
    trained: TrainedModel | None = None,
    folds: int = 5,
    seed: int = 42,
    key: Sequence[str] = ("id",),
    **params: Any,
) -> DataFrame:
    """One row: fold metrics, in-sample R², gap and risk."""
    trained = trained or fit_model(df, name, features, target, seed=seed, key=key, **params)
    params = {**trained.best_params, **params}
    scores = fold_scores(out_of_fold(df, name, features, target, folds=folds, seed=seed, key=key, **params), target)
    in_sample = regression_metrics(trained.predict(df, "y_pred"), target, "y_pred").select("r2").scalar()
    gap = F.col("r2_no_cv") - F.col("r2_cv")
    return (
        scores.withColumns({"model": F.lit(name), "r2_no_cv": in_sample, "training_time_s": F.lit(trained.training_time_s)})
        .withColumn("r2_gap", gap)
        .withColumn("risk", overfitting_risk(F.col("r2_gap")))
    )


BASELINE_FEATURES = ("stadtradeln_volume",)


def compare_models(
    df: DataFrame, names: Sequence[str], variants: Mapping[str, Sequence[str]], target: str = "dtv", **options: Any
) -> DataFrame:
    """Scores of every model and variant; ``is_best`` marks the highest cross-validated R²."""
    table = None
    for variant, features in variants.items():
        for name in names:
            row = cross_validate(df, name, features, target, **options).withColumn("variant", F.lit(variant))
            table = row if table is None else table.unionByName(row)
    table = reuse(table)
    best = table.agg(F.max_by(F.concat_ws("/", "variant", "model"), "r2_cv")).scalar()
    return table.withColumn("is_best", F.concat_ws("/", "variant", "model") == best)


def feature_importance(trained: TrainedModel, spark) -> DataFrame | None:
    """``(feature, importance, kind)``; NULL-less rows, or None for models without either."""
    names = [f for f, _ in trained.prep.plan()]
    if hasattr(trained.model, "featureImportances"):
        values, kind = trained.model.featureImportances.toArray(), "gini_importance"
    elif hasattr(trained.model, "coefficients"):
        values, kind = abs(trained.model.coefficients.toArray()), "coefficient_magnitude"
    else:
        return None
    rows = [(n, float(v), kind) for n, v in zip(names, values)]  # one per feature
    return spark.createDataFrame(rows, "feature string, importance double, kind string")


def voting(models: Sequence[TrainedModel], df: DataFrame, output: str = "y_pred") -> DataFrame:
    """Mean of the predictions of several models."""
    out = df
    for i, m in enumerate(models):
        out = m.predict(out, f"_p{i}")
    mean = sum((F.col(f"_p{i}") for i in range(1, len(models))), F.col("_p0")) / len(models)
    return out.withColumn(output, mean).drop(*[f"_p{i}" for i in range(len(models))])


@dataclass
class Stacking:
    """Linear model on the out-of-fold predictions of base models."""

    names: Sequence[str]
    features: Sequence[str]
    target: str = "dtv"
    key: Sequence[str] = ("id",)
    options: dict[str, dict[str, Any]] = field(default_factory=dict)
    bases: list[TrainedModel] = field(default_factory=list)
    final: Model | None = None

    def _stacked(self, df: DataFrame) -> DataFrame:
        cols = [f"_p{i}" for i in range(len(self.names))]
        return VectorAssembler(inputCols=cols, outputCol="_stack", handleInvalid="keep").transform(df)

    def fit(self, df: DataFrame, folds: int = 5) -> "Stacking":
        joined = None
        for i, name in enumerate(self.names):
            oof = out_of_fold(
                df, name, self.features, self.target, folds=folds, key=self.key, output=f"_p{i}", **self.options.get(name, {})
            )
            part = oof.select(*self.key, f"_p{i}")
            joined = oof.select(*self.key, self.target, f"_p{i}") if joined is None else joined.join(part, list(self.key))
            self.bases.append(fit_model(df, name, self.features, self.target, key=self.key, **self.options.get(name, {})))
        final = LinearRegression(featuresCol="_stack", labelCol=self.target)
        self.final = final.fit(self._stacked(joined))
        return self

    def predict(self, df: DataFrame, output: str = "y_pred") -> DataFrame:
        out = df
        for i, m in enumerate(self.bases):
            out = m.predict(out, f"_p{i}")
        scored = self.final.transform(self._stacked(out))
        return scored.withColumnRenamed("prediction", output).drop("_stack", *[f"_p{i}" for i in range(len(self.bases))])


def create_ensemble(
    df: DataFrame,
    names: Sequence[str],
    features: Sequence[str],
    kind: str = "voting",
    target: str = "dtv",
    key: Sequence[str] = ("id",),
    options: Mapping[str, dict[str, Any]] | None = None,
):
    """Predict function of a voting or stacking ensemble fitted on ``df``."""
    options = dict(options or {})
    if kind == "stacking":
        return Stacking(names, features, target, key, options).fit(df).predict
    models = [fit_model(df, n, features, target, key=key, **options.get(n, {})) for n in names]
    return lambda frame, output="y_pred": voting(models, frame, output)


def temporal_stability(
    df: DataFrame, name: str, features: Sequence[str], train_year: int, test_year: int, target: str = "dtv", year: str = "year", **params: Any
) -> DataFrame:
    """Metrics of a model fitted on one year and scored on another."""
    trained = fit_model(df.where(F.col(year) == train_year), name, features, target, **params)
    scored = trained.predict(df.where(F.col(year) == test_year), "y_pred")
    return regression_metrics(scored, target, "y_pred").withColumns(
        {"model": F.lit(name), "train_year": F.lit(train_year), "test_year": F.lit(test_year)}
    )


def report_predictions(trained: Sequence[TrainedModel], train: DataFrame, test: DataFrame, target: str = "dtv", volume: str = "stadtradeln_volume") -> DataFrame:
    """Long table of actual and predicted values per model and split."""
    out = None
    for m in trained:
        for split, part in (("train", train), ("test", test)):
            rows = m.predict(part, "y_pred").select(
                F.lit(m.name).alias("model"),
                F.lit(split).alias("split"),
                F.col(target).cast("double").alias("y_true"),
                F.col(volume).cast("double").alias("volume"),
                "y_pred",
            )
            out = rows if out is None else out.unionByName(rows)
    return out
