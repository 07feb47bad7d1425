"""Keep-one-row rules with a stated order.

A window ranks a whole key group in one task. These rules need a single row per key, so they are
aggregates instead: each task first keeps its own best row per key, and a key that holds a third
of the table is down to one row per task before the shuffle.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F


def _rank(order: Sequence[Column]) -> Column:
    return F.struct(*[c.alias(f"o{i}") for i, c in enumerate(order)])


def keep_first(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The row with the smallest order value of each key; NULL keys count as one key."""
    row = F.struct(*[F.col(f"`{c}`") for c in df.columns])
    best = df.groupBy(*[F.col(f"`{k}`").alias(f"_k{i}") for i, k in enumerate(keys)]).agg(
        F.min_by(row, F.struct(_rank(order).alias("o"), F.xxhash64(*df.columns).alias("h"))).alias("_row")
    )
    return best.select("_row.*")


def keep_highest(
    df: DataFrame, target: str, key: str = "base_id", unmatched: int = -1, tie: str | None = None
) -> DataFrame:
    """One row per edge, the one with the highest target; rows marked unmatched all stay."""
    if key not in df.columns:
        return df
    is_open = F.col(key) == unmatched
    matched = df.where(~is_open | F.col(key).isNull())
    v = F.col(target).cast("double")
    # missing targets come last
    order = [v.isNull(), -v, *([F.col(tie)] if tie else [])]
    return keep_first(matched, [key], order).unionByName(df.where(is_open))


def restore_rows(df: DataFrame, original: DataFrame, key: str, order: Sequence[Column]) -> DataFrame:
    """Undo row multiplication after joins and check that each original row is back."""
    single = keep_first(df, [key], order)
    counts = single.agg(F.count("*").alias("n")).unionByName(original.agg(F.count("*").alias("n"))).collect()
    if counts[0]["n"] != counts[1]["n"]:
        raise ValueError(f"Row count changed: {counts[1]['n']} before, {counts[0]['n']} after")
    return single
