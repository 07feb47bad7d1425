"""Score every edge of a network, calibrate the scores, prepare a review."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..ml.inference import predict_at_locations, predict_volumes
from ..ml.training import TrainedModel
from ..operators.calibration import Calibrator, apply_to_edges, calibrate_and_evaluate
from ..operators.columns import model_features
from ..operators.dedupe import keep_first
from ..operators.features import feature_pipeline
from ..operators.joins import join_infrastructure
from ..operators.spatial import edges_near_counters
from ..session import reuse
from .etl import EtlInputs, EtlResult, Structure, add_structure_simple, run_etl


def edge_features(edges: DataFrame, structure: Structure, infrastructure: DataFrame | None = None, edge_key: str = "edge_id") -> DataFrame:
    """One feature row per edge. The joins keep the number of rows, their right sides are unique."""
    if infrastructure is not None:
        edges = join_infrastructure(edges, infrastructure, dedupe_right=True)
    placed = add_structure_simple(edges, structure, lines=True).drop("line")  # features need no geometry, the dedupe carries none
    return feature_pipeline(keep_first(placed, [edge_key], [F.col("ars")]))


def run_prediction(
    trained: TrainedModel,
    edges: DataFrame,
    structure: Structure,
    infrastructure: DataFrame | None = None,
    edge_key: str = "edge_id",
) -> DataFrame:
    """``edge_id, base_id, predicted_dtv`` with volume, infrastructure class and line.

    Every row of ``edges`` comes back once: equal ids share a prediction, and an edge without an id or without a usable
    feature row has none. A table without the key column gets one from the hash of its rows.
    """
    if edge_key not in edges.columns:
        edges = edges.withColumn(edge_key, F.xxhash64(*edges.columns))
    table = edge_features(edges, structure, infrastructure, edge_key)
    # filling gaps reads the features once per column, the joins behind them should run once
    features = reuse(model_features(table, [f for f, _ in trained.prep.plan()], keep=[edge_key]))
    scored = predict_volumes(trained, features).select(edge_key, "predicted_dtv")
    kept = [edge_key, "base_id", "line", F.col("count").alias("campaign_count")]
    if "bicycle_infrastructure" in edges.columns:
        kept.append("bicycle_infrastructure")
    scored = scored.where(F.col(edge_key).isNotNull()).dropDuplicates([edge_key])
    return edges.select(*kept).join(scored, edge_key, "left")


def run_calibration(
    calibrator: Calibrator, stations: DataFrame, predicted_edges: DataFrame, max_distance_m: float = 100.0
) -> tuple[DataFrame, DataFrame]:
    """Calibrated edges and the evaluation row. Stations without an edge nearby are left out and counted."""
    at_stations = predict_at_locations(stations, predicted_edges, max_distance_m)
    pairs = at_stations.withColumns({"y_pred": F.col("predicted_dtv"), "y_true": F.col("dtv").cast("double")})
    pairs = reuse(pairs)  # the fit, both evaluations and the count read the matches
    usable = pairs.where("y_pred is not null and y_true is not null")
    fitted, evaluation = calibrate_and_evaluate(calibrator, usable)
    unmatched = pairs.agg(F.count_if(F.col("y_pred").isNull())).scalar()
    return apply_to_edges(fitted, predicted_edges), evaluation.withColumn("n_without_edge", unmatched)


def prepare_review(inputs: EtlInputs, buffer_m: float = 250.0) -> tuple[EtlResult, DataFrame]:
    """Flagged counters and the edges a reviewer needs to see around them."""
    result = run_etl(inputs, mode="verification")
    return result, edges_near_counters(inputs.edges, result.review, buffer_m)
