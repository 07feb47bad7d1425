"""Training tables: cleaning, feature choice and split."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, functions as F

from ..functions.numeric import finite_columns
from ..ml.preprocessing import train_test_split
from ..operators.columns import rename
from ..operators.dedupe import keep_highest
from ..operators.features import curated_features
from ..operators.infrastructure import map_curated_infrastructure
from ..operators.spatial import distance_to_nearest
from ..operators.targets import complete_cases, filter_bounds, filter_curated_bounds, filter_volume_ratio, target_statistics

# Training table name -> internal name, in feature order.
TRAINING_TO_MODEL = {
    "OSM_Radinfra": "infra_category",
    "TN_SR_relativ": "participation_rate",
    "Streckengewicht_SR": "route_intensity",
    "RegioStaR5": "regiostar5",
    "RegioStaR7": "regiostar7",
    "Erh_SR": "stadtradeln_volume",
    "HubDist": "dist_to_center_m",
    "DZS_mean_SR": "dtv",
}
CURATED_TO_MODEL = {
    "DZS_mean_SR": "dtv",
    "Erh_SR": "stadtradeln_volume",
    "OSM_Radinfra_Simple": "infra_category",
    "RegioStaR7": "regiostar7",
    "N_USERS": "n_users",
    "Bev_insg": "population",
    "lat": "latitude",
    "lon": "longitude",
    "Counter_ID": "counter_id",
    "OSM-ID": "base_id",
}
BASELINE = "stadtradeln_volume"
ENHANCED = (
    "stadtradeln_volume",
    "route_intensity",
    "participation_rate",
    "infra_category",
    "regiostar7",
    "dist_to_center_m",
)
NOT_FEATURES = ("id", "base_id", "lat", "lon", "latitude", "longitude", "name", "counter_id", "geometry")
TARGET_NAMES = ("dtv", "DZS_mean_SR")


@dataclass
class TrainingData:
    """Both parts of the split with the chosen columns and one row of target statistics."""

    train: DataFrame
    test: DataFrame
    features: list[str]
    target: str
    stats: DataFrame


def target_column(columns: Sequence[str], configured: str | None = None) -> str:
    hit = next((c for c in (*TARGET_NAMES, configured) if c in columns), None)
    if hit is None:
        raise ValueError("Target column not found. Expected 'dtv' or 'DZS_mean_SR'")
    return hit


def feature_columns(columns: Sequence[str], target: str, variant: str = "enhanced") -> list[str]:
    """Features of a model variant under whichever naming the table uses."""
    delivery = {v: k for k, v in TRAINING_TO_MODEL.items()}

    def spelled(name: str) -> str | None:
        return next((c for c in (name, delivery[name]) if c in columns), None)

    if variant == "baseline":
        found = spelled(BASELINE)
        if found is None:
            raise ValueError(f"Baseline feature not found. Expected {BASELINE!r} or {delivery[BASELINE]!r}")
        return [found]
    if variant != "enhanced":
        raise ValueError(f"Unknown model variant: {variant}")
    picked = [c for c in map(spelled, ENHANCED) if c is not None]
    return picked or [c for c in columns if c != target and c not in NOT_FEATURES]


def prepare_training_data(
    df: DataFrame,
    *,
    rename_columns: bool = True,
    variant: str = "enhanced",
    min_dtv: float = 25,
    max_dtv: float | None = None,
    min_ratio: float | None = None,
    max_ratio: float | None = None,
    deduplicate: bool = True,
    test_size: float = 0.2,
    seed: int = 42,
    key: Sequence[str] = ("id",),
    configured_target: str | None = None,
) -> TrainingData:
    """Bounds, one row per edge, ratio limits, complete features, split, statistics."""
    df = finite_columns(rename(df, TRAINING_TO_MODEL) if rename_columns else df)
    target = target_column(df.columns, configured_target)
    df = filter_bounds(df, target, min_dtv, max_dtv)
    if deduplicate:
        df = keep_highest(df, target, tie="id" if "id" in df.columns else None)
    df = filter_volume_ratio(df, target, min_ratio, max_ratio)
    features = feature_columns(df.columns, target, variant)
    df = complete_cases(df, features)
    return _split(df, features, target, test_size, seed, key)


def _split(df: DataFrame, features: list[str], target: str, test_size: float, seed: int, key: Sequence[str]) -> TrainingData:
    by = [k for k in key if k in df.columns] or features
    train, test = train_test_split(df, test_size, seed, by)
    return TrainingData(train, test, features, target, target_statistics(df, target))


def prepare_curated_data(
    df: DataFrame,
    centroids: DataFrame | None,
    *,
    year: int | None = None,
    min_dtv: float = 25,
    max_dtv: float | None = None,
    test_size: float = 0.2,
    seed: int = 42,
    keep_valid: bool = False,
) -> TrainingData:
    """Curated station table to training data."""
    if year is not None:
        df = df.where(F.col("year") == year)
    df = finite_columns(rename(df, CURATED_TO_MODEL))
    df = curated_features(df)
    if centroids is not None:
        df = distance_to_nearest(df, centroids)
    df = map_curated_infrastructure(df, keep_valid=keep_valid) if "infra_category" in df.columns else df
    df = filter_curated_bounds(df, min_dtv, max_dtv)
    features = [f for f in ENHANCED if f in df.columns]
    return _split(complete_cases(df, features), features, "dtv", test_size, seed, ("counter_id",))
