"""From source tables to the training table, or to the table of counters under review."""

from __future__ import annotations

from dataclasses import dataclass
from datetime import date

from pyspark.sql import DataFrame, functions as F

from ..functions.region_keys import level_digits
from ..operators.admin_units import rollup_population, rollup_statistics, units_at_level
from ..operators.features import feature_pipeline, training_table
from ..operators.joins import (
    join_demographics,
    join_infrastructure,
    join_population,
    join_regiostar,
    join_statistics,
    join_targets_to_locations,
    join_verified,
    merge_verifications,
)
from ..operators.outliers import Fences, detect_all
from ..operators.spatial import (
    distance_to_nearest,
    find_candidate_edges,
    join_lines_to_units,
    join_units,
    line_distance_to_nearest,
    match_nearest_edge,
    nearest_pairs,
)
from ..operators.targets import daily_traffic, drop_uninhabited, filter_quality, matched_only, targets_from_locations
from ..session import reuse


@dataclass
class Structure:
    """Regional tables. ``units`` carries an ``admin_level``; polygons are in ``rings``."""

    municipalities: DataFrame
    regiostar: DataFrame
    centroids: DataFrame
    demographics: DataFrame | None = None
    units: DataFrame | None = None
    level: str = "Verwaltungsgemeinschaft"
    land_code: str = "00"


@dataclass
class EtlInputs:
    locations: DataFrame
    edges: DataFrame
    structure: Structure
    start: date | str
    end: date | str
    measurements: DataFrame | None = None
    infrastructure: DataFrame | None = None
    verified: DataFrame | None = None


@dataclass
class EtlResult:
    training: DataFrame
    counters: DataFrame
    counts: DataFrame
    review: DataFrame | None = None
    fences: Fences | None = None


MATCH_LIMIT_M = 50.0


def targets(inputs: EtlInputs, min_quality: float = 0.5, min_observations: int = 7) -> DataFrame:
    if inputs.measurements is None:
        return targets_from_locations(inputs.locations)
    return filter_quality(daily_traffic(inputs.measurements, inputs.start, inputs.end), min_quality, min_observations)


def add_structure_simple(df: DataFrame, s: Structure, lines: bool = False) -> DataFrame:
    """Municipality by position, regional type, distance to a centre, participation.

    Works for counters (points) and for edges (``lines``: by the centroid of the line).
    """
    columns = [c for c in ("name", "population") if c in s.municipalities.columns]
    units = s.municipalities.withColumnRenamed("name", "municipality_name") if "name" in columns else s.municipalities
    columns = ["municipality_name" if c == "name" else c for c in columns]
    if lines:
        df = join_lines_to_units(df, units, output_key="ars", columns=columns)
        df = join_regiostar(df, s.regiostar)
        df = line_distance_to_nearest(df, s.centroids)
    else:
        df = join_units(df.drop("ars"), units, output_key="ars", columns=columns, boundary=False)
        df = join_regiostar(df, s.regiostar)
        df = distance_to_nearest(df, s.centroids)
    return join_demographics(df, s.demographics)


def add_structure_units(df: DataFrame, s: Structure) -> DataFrame:
    """Administrative unit at the chosen level with its summed statistics and population."""
    level_digits(s.level)
    picked = units_at_level(s.units, s.level, s.land_code)
    df = join_units(df, picked.withColumnRenamed("name", "admin_name"), output_key="admin_ars", columns=["admin_name"])
    if s.demographics is not None:
        df = join_statistics(df, rollup_statistics(s.demographics, s.level, s.units, s.land_code))
    df = join_population(df, rollup_population(s.municipalities, s.level)).transform(drop_uninhabited)
    df = join_units(df, s.municipalities.select("ars", "rings"), output_key="municipality_ars")
    df = join_regiostar(df, s.regiostar, key="municipality_ars")
    df = distance_to_nearest(df, s.centroids)
    return df if "ars" in df.columns else df.withColumn("ars", F.col("admin_ars"))


def add_structure(df: DataFrame, s: Structure) -> DataFrame:
    return add_structure_simple(df, s) if s.units is None else add_structure_units(df, s)


def run_etl(inputs: EtlInputs, mode: str = "production", drop_discarded: bool = False, ambiguity_from_pairs: bool = True) -> EtlResult:
    """Training table in ``production`` mode; ``verification`` mode also flags every match."""
    if mode not in ("production", "verification"):
        raise ValueError(f"Unknown mode: {mode}")
    dtv = targets(inputs)
    counters = join_targets_to_locations(dtv, inputs.locations)
    edges = inputs.edges if inputs.infrastructure is None else join_infrastructure(inputs.edges, inputs.infrastructure)
    review, fences = None, None
    if mode == "production" and inputs.verified is not None:
        matched = join_verified(counters, inputs.verified, drop_discarded)
    else:
        # matching, candidates and counts all start from the counters and the edges
        counters, edges = reuse(counters), reuse(edges)
        matched = match_nearest_edge(counters, edges, MATCH_LIMIT_M)
        if mode == "verification":
            # the detector looks at the two nearest only
            pairs = reuse(nearest_pairs(counters, edges, MATCH_LIMIT_M, 2)) if ambiguity_from_pairs else None
            merged = merge_verifications(matched, inputs.verified)
            # the detectors read the matches several times to fit their limits
            merged = reuse(merged if ambiguity_from_pairs else find_candidate_edges(merged, edges, MATCH_LIMIT_M))
            review, fences = detect_all(merged, pairs=pairs)
            review = reuse(review)
            matched = review
    kept = matched_only(matched).transform(add_structure, inputs.structure)
    features = feature_pipeline(kept)
    training = training_table(features)
    counts = (
        dtv.agg(F.count("*").alias("n_targets"))
        .withColumn("n_counters", counters.agg(F.count("*")).scalar())
        .withColumn("n_matched", matched.agg(F.count("base_id")).scalar())
        .withColumn("n_training", training.agg(F.count("*")).scalar())
    )
    return EtlResult(training, features, counts, review, fences)
