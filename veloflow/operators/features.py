"""Derived features as a registry of column builders (the extension point for new ones)."""

from __future__ import annotations

from collections.abc import Callable, Iterable, Mapping, Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import ratio
from .columns import TRAINING_NAMES, TRAINING_ORDER, keep_columns, to_internal_names
from .infrastructure import map_infrastructure, map_output_infrastructure


@dataclass(frozen=True)
class Feature:
    """A named column builder with the columns it needs and an optional fill for NULL."""

    name: str
    build: Callable[[], Column]
    needs: tuple[str, ...]
    description: str = ""
    fill: float | None = None


def _c(name: str) -> Column:
    return F.col(name).cast("double")


CAMPAIGN_FEATURES = (
    Feature("participation_rate", lambda: ratio(_c("n_users"), _c("population")), ("n_users", "population"), "participants per inhabitant"),
    Feature(
        "route_intensity",
        lambda: ratio(_c("n_users") * _c("stadtradeln_volume"), _c("population")),
        ("n_users", "stadtradeln_volume", "population"),
        "volume weighted by participation",
    ),
    Feature(
        "volume_per_trip",
        lambda: ratio(_c("stadtradeln_volume"), _c("n_trips")) * _c("n_users"),
        ("stadtradeln_volume", "n_trips", "n_users"),
        "volume per trip, scaled by participants",
    ),
    Feature("trips_per_user", lambda: ratio(_c("n_trips"), _c("n_users")), ("n_trips", "n_users"), "trips per participant"),
    Feature("km_per_user", lambda: ratio(_c("total_km"), _c("n_users")), ("total_km", "n_users"), "kilometres per participant"),
    Feature(
        "volume_density",
        lambda: ratio(_c("stadtradeln_volume"), _c("population")),
        ("stadtradeln_volume", "population"),
        "volume per inhabitant",
    ),
)


class FeatureRegistry:
    """Features by name; registering a known name replaces it."""

    def __init__(self, features: Iterable[Feature] = CAMPAIGN_FEATURES) -> None:
        self._features: dict[str, Feature] = {f.name: f for f in features}

    def register(self, feature: Feature) -> None:
        self._features[feature.name] = feature

    def get(self, name: str) -> Feature:
        try:
            return self._features[name]
        except KeyError:
            raise KeyError(f"Unknown feature {name!r}; known: {self.names()}") from None

    def names(self) -> list[str]:
        return list(self._features)

    def needs(self, names: Sequence[str]) -> set[str]:
        return {c for n in names for c in self.get(n).needs}

    def missing_needs(self, names: Sequence[str], columns: Sequence[str]) -> dict[str, list[str]]:
        gaps = {n: [c for c in self.get(n).needs if c not in columns] for n in names}
        return {n: g for n, g in gaps.items() if g}


REGISTRY = FeatureRegistry()


def register_feature(feature: Feature) -> None:
    """Add a feature to the shared registry."""
    REGISTRY.register(feature)


def derive_features(
    df: DataFrame, names: Sequence[str] | None = None, registry: FeatureRegistry | None = None
) -> DataFrame:
    """Add features in order; unknown names and features with absent inputs are skipped."""
    reg = registry or REGISTRY
    for name in names if names is not None else reg.names():
        if name not in reg.names():
            continue
        feature = reg.get(name)
        if any(c not in df.columns for c in feature.needs):
            continue
        value = feature.build()
        df = df.withColumn(name, value if feature.fill is None else F.coalesce(value, F.lit(feature.fill)))
    return df


def feature_pipeline(
    df: DataFrame,
    names: Sequence[str] | None = None,
    registry: FeatureRegistry | None = None,
    patterns: Mapping[str, str] | None = None,
) -> DataFrame:
    """Internal names, infrastructure categories, derived features."""
    return df.transform(to_internal_names).transform(map_infrastructure, patterns=patterns).transform(
        derive_features, names, registry
    )


def select_model_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    return keep_columns(df, features)


def usable_features(df: DataFrame, features: Sequence[str]) -> DataFrame:
    """One row per feature: present with at least one value?"""
    present = [f for f in features if f in df.columns]
    flags = df.agg(*[F.coalesce(F.max(F.col(f).isNotNull()), F.lit(False)).alias(f) for f in present], F.lit(1).alias("_one"))
    pairs = F.array(
        *[
            F.struct(F.lit(f).alias("feature"), (F.col(f) if f in present else F.lit(False)).alias("is_valid"))
            for f in features
        ]
    )
    return flags.select(F.inline(pairs))


def curated_features(df: DataFrame) -> DataFrame:
    """The two ratios of curated tables."""
    return derive_features(df, ["participation_rate", "route_intensity"], FeatureRegistry())


def training_table(df: DataFrame) -> DataFrame:
    """The 12-column training table; columns that cannot be filled are left out."""
    df = to_internal_names(df)
    if "infra_category" in df.columns:
        df = map_output_infrastructure(df).drop("bicycle_infrastructure")
    key = next((k for k in ("name", "counter_id") if k in df.columns), None)
    if key is not None:
        df = df.withColumn("id", F.col(key).cast("string"))
    picks: dict[str, str] = {}
    for source, target in TRAINING_NAMES.items():
        if source in df.columns and target not in picks:
            picks[target] = source
    for name in TRAINING_ORDER:
        if name in df.columns and name not in picks:
            picks[name] = name
    return df.select(*[F.col(picks[t]).alias(t) for t in TRAINING_ORDER if t in picks])
