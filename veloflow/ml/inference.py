"""Imputation and prediction for every edge."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F
from pyspark.sql.types import NumericType

from ..functions.numeric import finite
from ..functions.order_stats import quantiles
from ..operators.spatial import match_nearest_edge
from ..session import reuse
from .training import TrainedModel

EMPTY_CATEGORY = "unknown"


def fill_values(df: DataFrame, columns: Sequence[str]) -> tuple[dict[str, float | str], dict[str, int]]:
    """Fill value and number of gaps per column with gaps: median, or most frequent value.

    The most frequent value comes from counts per value (the smallest wins a tie), so no task
    holds all values.
    """
    kinds = {f.name: f.dataType for f in df.schema.fields}
    numeric = {c for c in columns if isinstance(kinds[c], NumericType)}
    value = {c: finite(F.col(c)) if c in numeric else F.col(c) for c in columns}
    gaps = df.agg(*[F.count_if(value[c].isNull()).alias(c) for c in columns]).first().asDict()
    fills: dict[str, float | str] = {}
    for c in columns:
        if not gaps[c]:
            continue
        if c in numeric:
            median = quantiles(df, c, {"median": 0.5})["median"]
            fills[c] = 0.0 if median is None else median
        else:
            counts = df.where(F.col(c).isNotNull()).groupBy(c).agg(F.count("*").alias("n"))
            top = counts.agg(F.min_by(c, F.struct(-F.col("n"), c))).first()[0]
            fills[c] = EMPTY_CATEGORY if top is None else top
    return fills, gaps


def impute(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Gaps of the named columns filled; infinite numbers count as gaps."""
    return filled(df, fill_values(df, columns)[0])


def filled(df: DataFrame, fills: Mapping[str, float | str]) -> DataFrame:
    kinds = {f.name: f.dataType for f in df.schema.fields}
    new = {}
    for c, fill in fills.items():
        v = finite(F.col(c)) if isinstance(kinds[c], NumericType) else F.col(c)
        new[c] = F.coalesce(v, F.lit(fill))
    return df.withColumns(new) if new else df


def imputation_report(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column: gaps and the value that fills them."""
    fills, gaps = fill_values(df, columns)
    rows = [(c, gaps[c], None if c not in fills else str(fills[c])) for c in columns]
    return df.sparkSession.createDataFrame(rows, "column string, n_missing long, fill_value string")


def predict_volumes(trained: TrainedModel, df: DataFrame, output: str = "predicted_dtv") -> DataFrame:
    """Impute the features, score every row, keep the original columns."""
    features = [f for f, _ in trained.prep.plan()]
    staged = df.withColumns({f"_o_{f}": F.col(f) for f in features})
    fills, _ = fill_values(reuse(df.select(*features)), features)
    scored = trained.predict(filled(staged, fills), output)
    return scored.withColumns({f: F.col(f"_o_{f}") for f in features}).drop(*[f"_o_{f}" for f in features])


def prediction_counts(df: DataFrame, output: str = "predicted_dtv") -> DataFrame:
    """Edges, edges with a prediction and edges without one."""
    return df.agg(F.count("*").alias("n_edges"), F.count(output).alias("n_predictions"), F.count_if(F.col(output).isNull()).alias("n_failures"))


def predict_at_locations(
    locations: DataFrame, edges: DataFrame, max_distance_m: float = 100.0, prediction: str = "predicted_dtv", **kwargs
) -> DataFrame:
    """Prediction of the nearest edge within the limit, in zone 32 metres."""
    return match_nearest_edge(
        locations, edges, max_distance_m, [prediction], crs="utm32", distance_column="edge_dist_m", **kwargs
    )
