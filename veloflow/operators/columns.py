"""Renames, pruning and name resolution."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import DataFrame, functions as F

from ..functions.numeric import finite
from ..functions.region_keys import normalize_key, pad_left

# Source column name -> internal name, first alias present wins.
INTERNAL_NAMES = {
    "Einwohnerzahl_EWZ": "population",
    "EWZ": "population",
    "ewz": "population",
    "Bev_insg": "population",
    "count": "stadtradeln_volume",
    "n": "stadtradeln_volume",
    "Erh_SR": "stadtradeln_volume",
    "OSM_Radinfra": "infra_category",
    "Regionalschlüssel_ARS": "ars",
    "ARS": "ars",
    "ags": "ars",
    "GeografischerName_GEN": "municipality_name",
    "GEN": "municipality_name",
    "N_USERS": "n_users",
    "N_TRIPS": "n_trips",
    "TOTAL_KM": "total_km",
    "RegioStaR5": "regiostar5",
    "RegioStaR7": "regiostar7",
    "dist_to_centroid_m": "dist_to_center_m",
    "dtv_value": "dtv",
    "DZS_mean_SR": "dtv",
    "DTV": "dtv",
}

# Internal name -> delivery name.
EXPORT_NAMES = {
    "population": "Bev_insg",
    "stadtradeln_volume": "Erh_SR",
    "infra_category": "OSM_Radinfra",
    "dtv": "DZS_mean_SR",
}

# Internal name -> name in the training table, and its column order.
TRAINING_NAMES = {
    "infra_category": "OSM_Radinfra",
    "participation_rate": "TN_SR_relativ",
    "route_intensity": "Streckengewicht_SR",
    "regiostar5": "RegioStaR5",
    "regiostar7": "RegioStaR7",
    "stadtradeln_volume": "Erh_SR",
    "count": "Erh_SR",
    "dist_to_center_m": "HubDist",
    "latitude": "lat",
    "longitude": "lon",
    "dtv": "DZS_mean_SR",
}
TRAINING_ORDER = (
    "OSM_Radinfra",
    "TN_SR_relativ",
    "Streckengewicht_SR",
    "RegioStaR5",
    "RegioStaR7",
    "Erh_SR",
    "HubDist",
    "id",
    "base_id",
    "lat",
    "lon",
    "DZS_mean_SR",
)


def rename(df: DataFrame, mapping: Mapping[str, str]) -> DataFrame:
    """Rename what is present; several sources of one target are coalesced in map order."""
    targets: dict[str, list[str]] = {}
    for source, target in mapping.items():
        if source in df.columns:
            targets.setdefault(target, []).append(source)
    for target, sources in targets.items():
        if target in df.columns and target not in sources:
            sources.insert(0, target)
    used = {s for sources in targets.values() for s in sources}
    first_use = {sources[0]: target for target, sources in targets.items()}
    out = []
    for c in df.columns:
        if c in first_use:
            sources = targets[first_use[c]]
            value = F.coalesce(*[F.col(f"`{s}`") for s in sources]) if len(sources) > 1 else F.col(f"`{c}`")
            out.append(value.alias(first_use[c]))
        elif c not in used:
            out.append(F.col(f"`{c}`"))
    return df.select(*out)


def to_internal_names(df: DataFrame, mapping: Mapping[str, str] | None = None) -> DataFrame:
    return rename(df, INTERNAL_NAMES if mapping is None else mapping)


def to_export_names(df: DataFrame, mapping: Mapping[str, str] | None = None) -> DataFrame:
    return df.withColumnsRenamed(dict(EXPORT_NAMES if mapping is None else mapping))


def keep_columns(df: DataFrame, names: Sequence[str]) -> DataFrame:
    """The named columns that exist, in the given order."""
    return df.select(*[n for n in names if n in df.columns])


def missing_columns(df: DataFrame, required: Sequence[str], raise_on_missing: bool = False) -> list[str]:
    missing = [c for c in required if c not in df.columns]
    if missing and raise_on_missing:
        raise ValueError(f"Missing required columns: {missing}")
    return missing


def pad_region_key(df: DataFrame, column: str = "ars") -> DataFrame:
    return df.withColumn(column, pad_left(F.col(column))) if column in df.columns else df


def normalize_region_keys(df: DataFrame) -> DataFrame:
    """Shape ``ars``/``ARS`` to 12 digits and fill a missing ``ars`` from ``ags`` or ``gemrs_22``."""
    for column in ("ars", "ARS"):
        if column in df.columns:
            df = df.withColumn(column, normalize_key(F.col(column)))
    for source in ("ags", "gemrs_22"):
        if source in df.columns and not {"ars", "ARS"} & set(df.columns):
            df = df.withColumn("ars", normalize_key(F.col(source)))
    return df


# Feature name -> other names of the same column.
FEATURE_ALIASES = {
    "stadtradeln_volume": ("count", "Erh_SR"),
    "infra_category": ("bicycle_infrastructure", "OSM_Radinfra"),
    "dist_to_center_m": ("dist_to_centroid_m", "HubDist"),
    "regiostar5": ("RegioStaR5",),
    "regiostar7": ("RegioStaR7",),
    "participation_rate": ("TN_SR_relativ",),
    "route_intensity": ("Streckengewicht_SR",),
}
# The two regional typologies stand in for each other in lenient mode.
LENIENT_ALIASES = {
    "regiostar5": ("RegioStaR5", "regiostar7"),
    "regiostar7": ("RegioStaR7", "regiostar5"),
}
DEFAULT_FEATURES = (
    "infra_category",
    "participation_rate",
    "route_intensity",
    "regiostar7",
    "stadtradeln_volume",
    "dist_to_center_m",
)


def resolve_features(columns: Sequence[str], features: Sequence[str], lenient: bool = False) -> dict[str, str]:
    """Wanted feature -> column that carries it; features nobody carries are left out."""
    groups = {**FEATURE_ALIASES, **(LENIENT_ALIASES if lenient else {})}
    found: dict[str, str] = {}
    for feature in features:
        as_alias = [main for main, others in groups.items() if feature in others]
        options = [feature, *as_alias, *groups.get(feature, ())]
        hit = next((o for o in options if o in columns), None)
        if hit is not None:
            found[feature] = hit
    return found


def model_features(
    df: DataFrame, features: Sequence[str] = DEFAULT_FEATURES, keep: Sequence[str] = (), lenient: bool = False
) -> DataFrame:
    """Columns a model expects, under its names, with non-finite numbers as NULL."""
    found = resolve_features(df.columns, features, lenient)
    if not found:
        raise ValueError("No features available for prediction")
    floating = {f.name for f in df.schema.fields if f.dataType.typeName() in ("double", "float")}

    def pick(source: str) -> F.Column:
        return finite(F.col(source)) if source in floating else F.col(source)

    return df.select(*keep, *[pick(src).alias(name) for name, src in found.items()])


# Candidate names of calibration station columns, first hit wins.
STATION_CANDIDATES = {
    "dtv": ("dtv", "DTV", "DZS_mean_SR", "dtv_value"),
    "id": ("id", "counter_id", "station_id", "DZS_id", "Zaehlst_id"),
    "longitude": ("longitude", "lon"),
    "latitude": ("latitude", "lat"),
    "name": ("name", "Name", "DZS_name", "Zaehlstellenname"),
}


def detect_station_columns(columns: Sequence[str]) -> dict[str, str | None]:
    return {
        role: next((c for c in options if c in columns), None) for role, options in STATION_CANDIDATES.items()
    }
