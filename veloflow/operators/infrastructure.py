"""Cycling infrastructure categories by ordered patterns."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, functions as F

# The six output categories in ordinal order.
CATEGORIES = ("no", "mixed_way", "mit_road", "bicycle_lane", "bicycle_road", "bicycle_way")

# Raw class pattern -> category, first match wins.
RAW_PATTERNS = {
    r"^bicycle_lane_.*$": "bicycle_lane",
    r"^bus_lane_.*$": "bicycle_lane",
    r"^bicycle_way_.*$": "bicycle_way",
    r"^mit_road.*$": "mit_road",
    r"^mixed_way.*$": "mixed_way",
    r"^path_not_forbidden$|^pedestrian_both$|^service_misc$": "no",
}

# Patterns of the output step, which also knows bicycle roads.
OUTPUT_PATTERNS = {
    r"^bicycle_lane_.*$": "bicycle_lane",
    r"^bus_lane_.*$": "bicycle_lane",
    r"^bicycle_way_.*$": "bicycle_way",
    r"^bicycle_road.*$": "bicycle_road",
    r"^mit_road.*$": "mit_road",
    r"^mixed_way.*$": "mixed_way",
    r"^path_not_forbidden$|^pedestrian_both$|^service_misc$": "no",
}


def categorize(
    c: Column, patterns: Mapping[str, str] | None = None, *, keep_valid: bool = True, ignore_case: bool = False
) -> Column:
    """Category of a raw class. Unknown and missing classes become ``no``."""
    value = F.lower(c.cast("string")) if ignore_case else c.cast("string")
    flag = "(?i)" if ignore_case else ""
    result: Column | None = None
    for pattern, category in (patterns or RAW_PATTERNS).items():
        # anchor like a match at the start of the text
        test = value.rlike(f"{flag}^(?:{pattern})")
        result = F.when(test, category) if result is None else result.when(test, category)
    if keep_valid:
        result = result.when(value.isin(*CATEGORIES), value)
    return result.otherwise("no")


def map_infrastructure(
    df: DataFrame,
    column: str = "bicycle_infrastructure",
    output: str = "infra_category",
    patterns: Mapping[str, str] | None = None,
) -> DataFrame:
    """Raw classes to categories; a class that already is a category is kept."""
    return df.withColumn(output, categorize(F.col(column), patterns)) if column in df.columns else df


def map_output_infrastructure(df: DataFrame, column: str = "infra_category") -> DataFrame:
    return df.withColumn(column, categorize(F.col(column), OUTPUT_PATTERNS))


def map_curated_infrastructure(
    df: DataFrame,
    column: str = "infra_category",
    patterns: Mapping[str, str] | None = None,
    keep_valid: bool = False,
) -> DataFrame:
    """Case-blind mapping of curated tables; plain category names are not kept by default."""
    return df.withColumn(column, categorize(F.col(column), patterns, keep_valid=keep_valid, ignore_case=True))


def infrastructure_distribution(df: DataFrame, column: str = "infra_category") -> DataFrame:
    return df.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
