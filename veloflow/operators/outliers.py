"""Suspicious counter assignments: ratios, flags and one final severity."""

from __future__ import annotations

import math
from dataclasses import asdict, dataclass

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import finite, ratio
from ..functions.order_stats import QUARTILES, quantiles

IQR_FACTOR = 1.5
CRITICAL_FACTOR = 2.0
METHODS = ("iqr", "zscore")


@dataclass(frozen=True)
class Fences:
    """Fitted limits of a ratio column; all zero without a valid ratio."""

    n_valid: int = 0
    lower: float = 0.0
    upper: float = 0.0
    median: float = 0.0
    q25: float = 0.0
    q75: float = 0.0

    @property
    def critical(self) -> float:
        """Limit of the final severity, which always uses the standard factor."""
        return (self.q75 + IQR_FACTOR * (self.q75 - self.q25)) * CRITICAL_FACTOR

    def as_dict(self) -> dict[str, float]:
        return asdict(self)


def with_ratio(df: DataFrame, dtv: str = "dtv", volume: str = "count", output: str = "dtv_volume_ratio") -> DataFrame:
    return df.withColumn(output, ratio(F.col(dtv), F.col(volume)))


def fit_fences(df: DataFrame, column: str = "dtv_volume_ratio", method: str = "iqr", factor: float = IQR_FACTOR) -> Fences:
    """Limits of a ratio column, exact at any size."""
    if method not in METHODS:
        raise ValueError(f"Unknown outlier detection method: {method}")
    q = quantiles(df, column, QUARTILES)
    if not q["n"]:
        return Fences()
    spread = q["q75"] - q["q25"]
    lower, upper = q["q25"] - factor * spread, q["q75"] + factor * spread
    if method == "zscore":
        v = finite(F.col(column))
        row = df.agg(F.avg(v).alias("m"), F.stddev_samp(v).alias("s")).first()
        deviation = math.nan if row["s"] is None else row["s"]  # undefined for a single value
        lower, upper = row["m"] - 3 * deviation, row["m"] + 3 * deviation
    return Fences(q["n"], lower, upper, q["median"], q["q25"], q["q75"])


def _is_verified(df: DataFrame, skip_verified: bool) -> Column:
    if not skip_verified or "verification_status" not in df.columns:
        return F.lit(False)
    return F.coalesce(F.col("verification_status") == "verified", F.lit(False))


def _flag(test: Column) -> Column:
    return F.coalesce(test, F.lit(False))


def flag_outliers(
    df: DataFrame,
    column: str = "dtv_volume_ratio",
    method: str = "iqr",
    factor: float = IQR_FACTOR,
    skip_verified: bool = True,
    fences: Fences | None = None,
) -> DataFrame:
    """``is_outlier`` and a first severity; an extreme ratio is critical even when verified."""
    f = fences or fit_fences(df, column, method, factor)
    if not f.n_valid or math.isnan(f.upper):
        return df.withColumns({"is_outlier": F.lit(False), "flag_severity": F.lit("ok")})
    r = finite(F.col(column))
    outside = _flag((r < f.lower) | (r > f.upper)) & ~_is_verified(df, skip_verified)
    severity = F.when(r > f.upper * CRITICAL_FACTOR, "critical").when(F.col("is_outlier"), "warning").otherwise("ok")
    return df.withColumn("is_outlier", outside).withColumn("flag_severity", severity)


def flag_no_volume(df: DataFrame, volume: str = "count") -> DataFrame:
    v = finite(F.col(volume))
    return df.withColumn("has_no_volume", v.isNull() | (v == 0))


def flag_campaign_bias(
    df: DataFrame,
    dtv: str = "dtv",
    volume: str = "count",
    factor: float = IQR_FACTOR,
    skip_verified: bool = True,
    fences: Fences | None = None,
) -> DataFrame:
    """High volume for the traffic: the inverse ratio lies above its upper fence."""
    df = df.withColumn("inverse_ratio", ratio(F.col(volume), F.col(dtv)))
    f = fences or fit_fences(df, "inverse_ratio", "iqr", factor)
    if not f.n_valid:
        return df.withColumn("has_campaign_bias", F.lit(False))
    above = _flag(F.col("inverse_ratio") > f.upper)
    return df.withColumn("has_campaign_bias", above & ~_is_verified(df, skip_verified))


def _is_ambiguous(d1: Column, d2: Column, threshold: float) -> Column:
    return _flag((d1 > 0) & (F.try_divide(d2, d1) < threshold))


def flag_ambiguous(df: DataFrame, threshold: float = 2.0) -> DataFrame:
    """The second nearest candidate is about as near as the nearest."""
    if "candidate_edges" not in df.columns:
        return df.withColumn("is_ambiguous", F.lit(False))
    nearest = F.array_sort(F.transform("candidate_edges", lambda c: c["distance"]))
    d1, d2 = F.get(nearest, F.lit(0)), F.get(nearest, F.lit(1))
    return df.withColumn("is_ambiguous", _is_ambiguous(d1, d2, threshold))


def flag_ambiguous_from_pairs(
    df: DataFrame, pairs: DataFrame, threshold: float = 2.0, counter_key: str = "counter_id", edge_key: str = "edge_id"
) -> DataFrame:
    """Same flag from candidate rows: only the two smallest distances of a counter are kept.

    ``min`` and ``min_by`` style aggregates combine before the shuffle, so a counter with very
    many candidates never becomes one long list.
    """
    first = pairs.groupBy(counter_key).agg(F.min(F.struct("distance", edge_key)).alias("_first"))
    rest = pairs.join(first, counter_key).where(
        (F.col("distance") != F.col("_first.distance")) | (F.col(edge_key) != F.col(f"_first.{edge_key}"))
    )
    second = rest.groupBy(counter_key).agg(F.min("distance").alias("_d2"))
    joined = df.join(first, counter_key, "left").join(second, counter_key, "left")
    return joined.withColumn("is_ambiguous", _is_ambiguous(F.col("_first.distance"), F.col("_d2"), threshold)).drop("_first", "_d2")


def assign_severity(df: DataFrame, skip_verified: bool = True, fences: Fences | None = None) -> DataFrame:
    """One severity per counter: verified, critical, ambiguous, no_volume, warning, campaign_bias, carryover, ok."""
    steps: list[tuple[str, Column]] = []
    if skip_verified and "verification_status" in df.columns:
        steps.append(("verified", _is_verified(df, True)))
    if "dtv_volume_ratio" in df.columns:
        f = fences or fit_fences(df)
        if f.n_valid:
            steps.append(("critical", finite(F.col("dtv_volume_ratio")) > f.critical))
    for name, column in (
        ("ambiguous", "is_ambiguous"),
        ("no_volume", "has_no_volume"),
        ("warning", "is_outlier"),
        ("campaign_bias", "has_campaign_bias"),
    ):
        if column in df.columns:
            steps.append((name, F.col(column)))
    if "verification_status" in df.columns:
        steps.append(("carryover", F.col("verification_status") == "carryover"))
    result: Column | None = None
    for name, test in steps:
        result = F.when(test, name) if result is None else result.when(test, name)
    return df.withColumn("flag_severity", F.lit("ok") if result is None else result.otherwise("ok"))


def detect_all(
    df: DataFrame, factor: float = IQR_FACTOR, ambiguity: float = 2.0, skip_verified: bool = True, pairs: DataFrame | None = None
) -> tuple[DataFrame, Fences]:
    """All detectors in order; the ratio quartiles are fitted once and shared."""
    df = with_ratio(df)
    fences = fit_fences(df, factor=factor)
    df = flag_outliers(df, factor=factor, skip_verified=skip_verified, fences=fences)
    df = df.transform(flag_no_volume).transform(flag_campaign_bias, factor=factor, skip_verified=skip_verified)
    df = flag_ambiguous(df, ambiguity) if pairs is None else flag_ambiguous_from_pairs(df, pairs, ambiguity)
    return assign_severity(df, skip_verified, fences), fences


def severity_breakdown(df: DataFrame, column: str = "flag_severity") -> DataFrame:
    return df.groupBy(column).agg(F.count("*").alias("n"))


def detection_summary(df: DataFrame, fences: Fences) -> DataFrame:
    """One row: size, flagged counters and the fitted limits."""
    return df.agg(
        F.count("*").alias("n_counters"),
        F.count_if(~F.col("flag_severity").isin("ok", "verified")).alias("n_flagged"),
    ).withColumns(
        {
            "threshold_lower": F.lit(float(fences.lower)),
            "threshold_upper": F.lit(float(fences.upper)),
            "median_ratio": F.lit(float(fences.median)),
        }
    )


# Limits of the station check.
LOW_DTV = 25
HIGH_DTV = 10000
RATIO_LIMITS = (0.33, 3.0)


def flag_stations(df: DataFrame, dtv: str = "dtv", predicted: str | None = None) -> DataFrame:
    """Severity and reason per calibration station."""
    v = finite(F.col(dtv))
    missing, low, high = v.isNull(), v < LOW_DTV, v > HIGH_DTV
    severity = F.when(missing, "critical").when(low | high, "warning")
    reason = (
        F.when(missing, "Missing DTV value")
        .when(high, f"Very high DTV (> {HIGH_DTV})")
        .when(low, f"Very low DTV (< {LOW_DTV})")
    )
    if predicted is not None:
        r = ratio(v, F.col(predicted))
        df = df.withColumns({"predicted_dtv": F.col(predicted), "dtv_pred_ratio": r})
        far = (r > RATIO_LIMITS[1]) | (r < RATIO_LIMITS[0])
        severity = severity.when(far, "warning")
        reason = reason.when(far, "Large prediction discrepancy (ratio > 3x or < 0.33x)")
    return df.withColumns({"flag_severity": severity.otherwise("ok"), "flag_reason": reason.otherwise("")})
