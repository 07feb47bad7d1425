"""Daily traffic targets, their quality, and the filters of the training table."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import finite, half_even, ratio
from ..functions.order_stats import QUARTILES, quantiles
from .periods import filter_period, period_days

MIN_QUALITY = 0.5
MIN_OBSERVATIONS = 7
FENCE_FACTOR = 3.0


def daily_traffic(
    measurements: DataFrame,
    start: date | str,
    end: date | str,
    counter_column: str = "counter_id",
    count_column: str = "count",
    date_column: str = "timestamp",
) -> DataFrame:
    """Mean daily count per counter in a period, with completeness and zero-day quality."""
    expected = period_days(start, end)
    count = finite(F.col(count_column))
    inside = filter_period(measurements, start, end, date_column).where(F.col(counter_column).isNotNull())
    sums = inside.groupBy(F.col(counter_column).cast("string").alias("counter_id")).agg(
        F.count(count).alias("observation_count"),
        F.count_if(count == 0).alias("zero_days"),
        F.avg(count).alias("_mean"),
    )
    n, zeros = F.col("observation_count"), F.col("zero_days")
    quality = n / F.lit(float(expected)) * (1 - zeros / F.greatest(n, F.lit(1)) * 0.5)
    return sums.select(
        "counter_id",
        F.coalesce(half_even(F.col("_mean")), F.lit(0.0)).alias("dtv"),
        "observation_count",
        (F.lit(expected) - n).alias("missing_days"),
        "zero_days",
        quality.alias("quality_score"),
        ((quality >= MIN_QUALITY) & (n >= MIN_OBSERVATIONS)).alias("is_valid"),
    )


def filter_quality(df: DataFrame, min_quality: float = MIN_QUALITY, min_observations: int = MIN_OBSERVATIONS) -> DataFrame:
    return df.where((F.col("quality_score") >= min_quality) & (F.col("observation_count") >= min_observations))


def targets_from_locations(locations: DataFrame, key: str = "name", dtv_column: str = "dtv") -> DataFrame:
    """Ready-made targets for networks without measurements: full quality, always valid."""
    return (
        locations.select(
            F.trim(F.col(key).cast("string")).alias("counter_id"),
            finite(F.col(dtv_column).cast("string").try_cast("double")).alias("dtv"),
        )
        .dropna(subset=["dtv"])
        .withColumns({"quality_score": F.lit(1.0), "is_valid": F.lit(True)})
    )


def _fence(df: DataFrame, column: str) -> tuple[float | None, float | None]:
    q = quantiles(df, column, QUARTILES)
    if not q["n"]:
        return None, None
    spread = q["q75"] - q["q25"]
    return q["q25"] - FENCE_FACTOR * spread, q["q75"] + FENCE_FACTOR * spread


def assess_target(df: DataFrame, column: str, min_dtv: float, max_dtv: float | None = None) -> DataFrame:
    """One row of counts: missing, out of bounds, outside the 3-IQR fence, valid."""
    if column not in df.columns:
        v: Column = F.lit(None).cast("double")
        lower = upper = None
    else:
        v = finite(F.col(column))
        lower, upper = _fence(df, column)
    valid = v.isNotNull() & (v >= min_dtv)
    above = F.lit(False)
    if max_dtv:
        valid, above = valid & (v <= max_dtv), v > max_dtv
    outlier = F.lit(False) if lower is None else (v < lower) | (v > upper)
    counts = df.agg(
        F.count("*").alias("total_samples"),
        F.count_if(valid).alias("valid_samples"),
        F.count_if(v.isNull()).alias("missing_target_count"),
        F.count_if(v < min_dtv).alias("below_min_count"),
        F.count_if(above).alias("above_max_count"),
        F.count_if(outlier).alias("outlier_count"),
    )
    share = F.when(F.col("total_samples") > 0, F.col("valid_samples") / F.col("total_samples")).otherwise(0.0)
    return counts.withColumn("valid_ratio", share)


def filter_target(
    df: DataFrame, column: str, min_dtv: float, max_dtv: float | None = None, remove_outliers: bool = False
) -> DataFrame:
    """Bounds, then optionally the fence of the rows that are left."""
    if column not in df.columns:
        return df.where(F.lit(False))
    kept = filter_bounds(df, column, min_dtv, max_dtv or None)
    if remove_outliers:
        lower, upper = _fence(kept, column)
        if lower is not None:
            kept = kept.where(finite(F.col(column)).between(lower, upper))
    return kept


def filter_bounds(df: DataFrame, column: str, min_dtv: float, max_dtv: float | None = None) -> DataFrame:
    v = finite(F.col(column))
    kept = df.where(v.isNotNull() & (v >= min_dtv))
    return kept if max_dtv is None else kept.where(v <= max_dtv)


def filter_curated_bounds(df: DataFrame, min_dtv: float, max_dtv: float | None = None) -> DataFrame:
    kept = filter_bounds(df, "dtv", min_dtv, max_dtv)
    return kept.where(finite(F.col("stadtradeln_volume")) > 0) if "stadtradeln_volume" in df.columns else kept


def filter_volume_ratio(
    df: DataFrame,
    target: str,
    min_ratio: float | None = None,
    max_ratio: float | None = None,
    volume: str | None = None,
) -> DataFrame:
    """Drop extreme target/volume ratios; rows without a ratio stay."""
    volume = volume or next((c for c in ("stadtradeln_volume", "Erh_SR") if c in df.columns), None)
    if volume is None or (min_ratio is None and max_ratio is None):
        return df
    r = ratio(F.col(target), F.col(volume))
    inside = F.lit(True)
    if min_ratio is not None:
        inside = inside & (r >= min_ratio)
    if max_ratio is not None:
        inside = inside & (r <= max_ratio)
    return df.where(r.isNull() | inside)


def matched_only(df: DataFrame, column: str = "base_id") -> DataFrame:
    return df.where(F.col(column).isNotNull())


def drop_uninhabited(df: DataFrame, column: str = "population") -> DataFrame:
    """Remove rows with population 0; unknown population stays."""
    return df.where(F.col(column).isNull() | (F.col(column) != 0))


def complete_cases(df: DataFrame, columns: list[str]) -> DataFrame:
    return df.dropna(subset=columns)


def target_statistics(df: DataFrame, column: str) -> DataFrame:
    """Mean, sample deviation, range and quartiles in one row."""
    v = finite(F.col(column))
    q = quantiles(df, column, QUARTILES)
    return df.agg(
        F.avg(v).alias("mean"), F.stddev_samp(v).alias("std"), F.min(v).alias("min"), F.max(v).alias("max")
    ).withColumns({k: F.lit(q[k]).cast("double") for k in QUARTILES})


