"""Attribute joins of counters, edges, regions and statistics.

No side is broadcast by hint: the tables here can all grow, and adaptive execution broadcasts a
side once its measured size is below ``spark.sql.autoBroadcastJoinThreshold`` and splits hot
keys of a sort-merge join otherwise.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.region_keys import KEY_LENGTH, pad_left
from .dedupe import keep_first

VERIFIED_STATES = ("verified", "carryover")


def text_key(c: Column) -> Column:
    """Numeric id as text without a fraction; a missing id stays NULL."""
    return c.cast("bigint").cast("string")


def join_targets_to_locations(dtv: DataFrame, locations: DataFrame, location_key: str = "name") -> DataFrame:
    """Valid targets with the position of their counter; target columns win over equal names."""
    right = locations.withColumn("_key", F.trim(F.col(location_key).cast("string")))
    right = right.drop(*[c for c in dtv.columns if c in locations.columns])
    left = dtv.withColumn("_key", F.trim(F.col("counter_id").cast("string")))
    joined = left.join(right, "_key").drop("_key")
    return joined.where("is_valid") if "is_valid" in dtv.columns else joined


def join_infrastructure(edges: DataFrame, infrastructure: DataFrame, dedupe_right: bool = False) -> DataFrame:
    """Edges with the class of their way; untouched when they already carry one."""
    if "bicycle_infrastructure" in edges.columns:
        return edges
    right = infrastructure.withColumn("_way", F.trim(F.col("osm_id").cast("string")))
    if dedupe_right:
        order = [F.col(c) for c in right.columns if c not in ("osm_id", "_way")]
        right = keep_first(right, ["_way"], order)
    right = right.select("_way", *[c for c in infrastructure.columns if c != "osm_id" and c not in edges.columns])
    return edges.withColumn("_way", text_key(F.col("base_id"))).join(right, "_way", "left").drop("_way")


def join_verified(counters: DataFrame, verified: DataFrame, drop_discarded: bool = False) -> DataFrame:
    """Counters with their checked edge assignment; counters without one fall out."""
    if drop_discarded and "is_discarded" in verified.columns:
        verified = verified.where(~F.coalesce(F.col("is_discarded"), F.lit(False)))
    taken = ["base_id", "count", "bicycle_infrastructure"]
    right = verified.select("counter_id", *taken)
    return counters.drop(*taken).join(right, "counter_id")


def merge_verifications(matched: DataFrame, verified: DataFrame | None) -> DataFrame:
    """Earlier checks override the automatic match; everything else starts unverified."""
    state = {
        "verification_status": ("string", F.lit("unverified")),
        "verified_at": ("timestamp_ntz", None),
        "verification_metadata": ("string", F.lit("")),
        "is_discarded": ("boolean", F.lit(False)),
    }
    wanted = ["base_id", "count", *state]
    if verified is None:
        verified = matched.select("counter_id").where(F.lit(False))
    present = [c for c in wanted if c in verified.columns]
    right = verified.select("counter_id", *[F.col(c).alias(f"_{c}") for c in present])
    out = matched.join(right, "counter_id", "left")
    status = F.col("_verification_status") if "verification_status" in present else F.lit(None).cast("string")
    checked = F.coalesce(status.isin(*VERIFIED_STATES), F.lit(False))
    new: dict[str, Column] = {}
    if "base_id" in present and "base_id" in matched.columns:
        new["base_id"] = F.when(checked, F.col("_base_id")).otherwise(F.col("base_id"))
    if "count" in present and "count" in matched.columns:
        new["count"] = F.when(checked & F.col("_count").isNotNull(), F.col("_count")).otherwise(F.col("count"))
    for column, (kind, default) in state.items():
        value = F.col(f"_{column}") if column in present else F.lit(None).cast(kind)
        new[column] = value if default is None else F.coalesce(value, default)
    return out.withColumns(new).drop(*[f"_{c}" for c in present])


def join_edges(counters: DataFrame, edges: DataFrame, key: str = "edge_id", columns: Sequence[str] | None = None) -> DataFrame:
    """Counters with the attributes of the edge they name."""
    taken = columns if columns is not None else [c for c in edges.columns if c != key and c not in counters.columns]
    return counters.join(edges.select(key, *taken), key, "left")


def join_regiostar(df: DataFrame, regiostar: DataFrame, key: str = "ars", dedupe_right: bool = True) -> DataFrame:
    """Regional type by the first 12 characters of the key."""
    cols = [c for c in ("regiostar5", "regiostar7") if c in regiostar.columns]
    right = regiostar.select(F.substring(F.col("ars").cast("string"), 1, KEY_LENGTH).alias("_r"), *cols)
    if dedupe_right:
        right = keep_first(right, ["_r"], [F.col(c) for c in cols])
    left = df.drop(*cols).withColumn("_r", F.substring(F.col(key).cast("string"), 1, KEY_LENGTH))
    return left.join(right, "_r", "left").drop("_r")


STATISTICS = ("n_users", "n_trips", "total_km")


def join_demographics(df: DataFrame, demographics: DataFrame | None, key: str = "ars", digits: int = 9) -> DataFrame:
    """Campaign statistics by the leading digits; skipped without a table."""
    if demographics is None:
        return df
    cols = [c for c in STATISTICS if c in demographics.columns]
    right = demographics.select(F.substring(F.col("ars").cast("string"), 1, digits).alias("_d"), *cols)
    right = keep_first(right, ["_d"], [F.col(c) for c in cols])
    left = df.drop(*cols).withColumn("_d", F.substring(F.col(key).cast("string"), 1, digits))
    return left.join(right, "_d", "left").drop("_d")


def join_statistics(df: DataFrame, statistics: DataFrame, key: str = "admin_ars") -> DataFrame:
    right = statistics.select(F.col("ars").alias(key), *STATISTICS)
    return df.drop(*STATISTICS).join(right, key, "left")


def join_population(df: DataFrame, population: DataFrame, key: str = "admin_ars") -> DataFrame:
    right = population.select(F.col("ars").alias(key), "population")
    return df.drop("population").join(right, key, "left")


def carry_over(previous: DataFrame, volumes: DataFrame, previous_year: int, verified_at: str | None = None) -> DataFrame:
    """Last year's assignments with this year's volumes, all due for review."""
    kept = ("counter_id", "name", "latitude", "longitude", "ars", "base_id", "bicycle_infrastructure")
    new = keep_first(volumes.select("base_id", "count"), ["base_id"], [F.col("count")])
    discarded = F.coalesce(F.col("is_discarded"), F.lit(False)) if "is_discarded" in previous.columns else F.lit(False)
    source = F.col("osm_source") if "osm_source" in previous.columns else F.lit(None).cast("string")
    base = previous.select(*kept, source.alias("osm_source"), discarded.alias("is_discarded"))
    stamp = F.current_timestamp() if verified_at is None else F.lit(verified_at)
    return base.join(new, "base_id", "left").select(
        *kept,
        "count",
        "osm_source",
        F.lit("carryover").alias("verification_status"),
        stamp.cast("timestamp_ntz").alias("verified_at"),
        F.lit(f"Inherited from {previous_year}, needs review").alias("verification_metadata"),
        "is_discarded",
    )


def lookup_padded(df: DataFrame, lookup: DataFrame, key: str, lookup_key: str, value: str, width: int = 3) -> DataFrame:
    """Value by exact id, else by the id zero-filled to ``width``; NULL when neither is known."""
    exact = F.trim(F.col(key).cast("string"))
    right = lookup.select(F.trim(F.col(lookup_key).cast("string")).alias("_k"), F.col(value).alias("_value"))
    one = right.groupBy("_k").agg(F.max("_value").alias("_value"))
    padded = one.select(F.col("_k").alias("_p"), F.col("_value").alias("_padded_value"))
    left = df.withColumns({"_k": exact, "_p": pad_left(exact, width)})
    joined = left.join(one, "_k", "left").join(padded, "_p", "left")
    return joined.withColumn(value, F.coalesce("_value", "_padded_value")).drop("_k", "_p", "_value", "_padded_value")


def apply_changes(table: DataFrame, changes: DataFrame, now: str | None = None, with_target: bool = False) -> DataFrame:
    """Apply a change list by counter; the last row per counter decides, unknown ids do nothing."""
    order = [-F.col("position")] if "position" in changes.columns else [F.col("base_id")]
    fields = ["base_id", "count", "metadata", "is_discarded", *(["dtv"] if with_target else [])]
    present = [c for c in fields if c in changes.columns]
    last = keep_first(changes, ["counter_id"], order).select(
        "counter_id", *[F.col(c).alias(f"_{c}") for c in present], F.lit(True).alias("_hit")
    )
    hit = F.coalesce(F.col("_hit"), F.lit(False))
    stamp = (F.current_timestamp() if now is None else F.lit(now)).cast("timestamp_ntz")

    def changed(name: str, value: Column) -> Column:
        return F.when(hit, value).otherwise(F.col(name)) if name in table.columns else F.when(hit, value)

    new = {
        "verification_status": changed("verification_status", F.lit("verified")),
        "verified_at": changed("verified_at", stamp),
        "verification_metadata": changed(
            "verification_metadata", F.coalesce(F.col("_metadata"), F.lit("")) if "metadata" in present else F.lit("")
        ),
        "is_discarded": changed(
            "is_discarded", F.coalesce(F.col("_is_discarded"), F.lit(False)) if "is_discarded" in present else F.lit(False)
        ),
    }
    if "base_id" in present:
        new["base_id"] = changed("base_id", F.col("_base_id"))
    for c in ("count", "dtv"):
        if c in present and c in table.columns:
            new[c] = F.when(hit & F.col(f"_{c}").isNotNull(), F.col(f"_{c}")).otherwise(F.col(c))
    return table.join(last, "counter_id", "left").withColumns(new).drop(*[f"_{c}" for c in present], "_hit")
