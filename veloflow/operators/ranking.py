"""Sorts, top rows, seeded samples and key set operations."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F

from ..session import cut_lineage

# Display order of severities.
SEVERITY_RANK = {
    "critical": 0,
    "ambiguous": 1,
    "no_volume": 2,
    "warning": 3,
    "campaign_bias": 4,
    "carryover": 5,
    "ok": 6,
    "verified": 7,
}
STATION_SEVERITY_RANK = {"critical": 0, "warning": 1, "ok": 2, "verified": 3}


def severity_rank(c: Column, ranks: Mapping[str, int] | None = None) -> Column:
    out: Column | None = None
    for name, rank in (ranks or SEVERITY_RANK).items():
        out = F.when(c == name, rank) if out is None else out.when(c == name, rank)
    return out.otherwise(99)


def sort_by_severity(
    df: DataFrame,
    value: str = "dtv_volume_ratio",
    severity: str = "flag_severity",
    ranks: Mapping[str, int] | None = None,
    tie: Sequence[str] = (),
) -> DataFrame:
    """Most urgent first, then the largest value."""
    return df.orderBy(severity_rank(F.col(severity), ranks), F.col(value).desc_nulls_last(), *tie)


def number_by_severity(
    df: DataFrame,
    value: str = "dtv_volume_ratio",
    severity: str = "flag_severity",
    ranks: Mapping[str, int] | None = None,
    tie: Sequence[str] = (),
) -> DataFrame:
    """All rows with ``position``, from 1, in the order of :func:`sort_by_severity`.

    Rows are sorted by ranges. Each range is numbered by itself from what the ranges before it hold, so no task sees more
    than its range. The sorted rows are checkpointed, because ranges drawn anew could differ.
    """
    placed = cut_lineage(sort_by_severity(df, value, severity, ranks, tie).withColumn("_range", F.spark_partition_id()))
    before = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)  # one row per range
    counts = placed.groupBy("_range").agg(F.count("*").alias("_n"))
    starts = counts.select("_range", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    order = [severity_rank(F.col(severity), ranks), F.col(value).desc_nulls_last(), *tie]
    own = F.row_number().over(Window.partitionBy("_range").orderBy(*order))
    numbered = placed.withColumn("_own", own).join(starts, "_range")
    return numbered.withColumn("position", (F.col("_start") + F.col("_own")).cast("bigint")).drop("_range", "_own", "_start")


def sample_failures(df: DataFrame, order: Sequence[Column | str], n: int = 10) -> DataFrame:
    """First rows of a failure table in a stated order."""
    return df.orderBy(*order).limit(n)


def top_importances(df: DataFrame, n: int = 10, name: str = "feature", value: str = "importance") -> DataFrame:
    """Largest importances as percent of the total of all."""
    total = df.agg(F.sum(value).alias("t")).first()["t"]
    share = F.try_divide(F.col(value) * 100, F.lit(total))
    return df.select(name, value, share.alias("percent")).orderBy(F.col(value).desc(), name).limit(n)


def seeded_sample(df: DataFrame, n: int, seed: int, key: Sequence[str]) -> DataFrame:
    """At most ``n`` rows, the same ones for a seed whatever the partitioning."""
    return df.orderBy(F.xxhash64(F.lit(seed), *key), *key).limit(n)


def key_overlap(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    """Keys with the side that has them: both, left_only or right_only."""
    l = left.select(F.col(key).alias("key")).where("key is not null").distinct().withColumn("_l", F.lit(True))
    r = right.select(F.col(key).alias("key")).where("key is not null").distinct().withColumn("_r", F.lit(True))
    side = F.when(F.col("_r").isNull(), "left_only").when(F.col("_l").isNull(), "right_only").otherwise("both")
    return l.join(r, "key", "full_outer").select("key", side.alias("side"))


def common_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.select(key).intersect(right.select(key))


def only_left_keys(left: DataFrame, right: DataFrame, key: str) -> DataFrame:
    return left.select(key).subtract(right.select(key))
