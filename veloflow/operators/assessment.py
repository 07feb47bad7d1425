"""Checks of a training table against its sources. Each check is one row of counts and a status."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql.types import NumericType

from ..functions.numeric import finite, is_close, ratio
from ..functions.order_stats import quantiles
from .dedupe import keep_first
from .infrastructure import CATEGORIES
from .joins import lookup_padded

PASS_RATE = 0.95
WARN_RATE = 0.80
RTOL = 1e-5
ATOL = 1e-8
COORDINATE_ATOL = 1e-6
MAX_HUB_DISTANCE = 100_000
SCHEMA = "check_name string, n_checked long, n_passed long, n_failed long, match_rate double, status string"

# Column -> smallest and largest plausible value.
VALUE_RANGES = {
    "DZS_mean_SR": (0, 50_000),
    "Erh_SR": (0, 1e9),
    "TN_SR_relativ": (0, 1),
    "RegioStaR5": (1, 99),
    "lat": (47, 56),
    "lon": (5, 16),
}


def status_of(rate: Column) -> Column:
    return F.when(rate >= PASS_RATE, "pass").when(rate >= WARN_RATE, "warn").otherwise("fail")


def _result(name: str, counts: DataFrame, when_empty: str = "warn") -> DataFrame:
    """Check row from ``n_checked`` and ``n_passed``."""
    checked, passed = F.col("n_checked"), F.col("n_passed")
    rate = F.when(checked > 0, passed / checked)
    return counts.select(
        F.lit(name).alias("check_name"),
        checked.cast("bigint").alias("n_checked"),
        passed.cast("bigint").alias("n_passed"),
        (checked - passed).cast("bigint").alias("n_failed"),
        rate.alias("match_rate"),
        F.when(checked > 0, status_of(rate)).otherwise(when_empty).alias("status"),
    )


def skipped(spark: SparkSession, name: str) -> DataFrame:
    return spark.createDataFrame([(name, 0, 0, 0, None, "skip")], SCHEMA)


def _count(df: DataFrame, ok: Column, checked: Column | None = None) -> DataFrame:
    known = F.lit(True) if checked is None else checked
    return df.agg(F.count_if(known).alias("n_checked"), F.count_if(known & F.coalesce(ok, F.lit(False))).alias("n_passed"))


def _has(df: DataFrame, *columns: str) -> bool:
    return all(c in df.columns for c in columns)


def dtv_mismatches(table: DataFrame, dtv: DataFrame) -> DataFrame:
    """Rows whose target was found in the source, with ``ok``."""
    found = lookup_padded(table, dtv.withColumnRenamed("dtv", "expected"), "id", "counter_id", "expected")
    known = found.where(finite(F.col("DZS_mean_SR")).isNotNull() & F.col("expected").isNotNull())
    return known.withColumn("ok", is_close(F.col("DZS_mean_SR"), F.col("expected"), RTOL, ATOL))


def check_dtv(table: DataFrame, dtv: DataFrame) -> DataFrame:
    """Targets equal the recomputed ones."""
    if not _has(table, "id", "DZS_mean_SR"):
        return skipped(table.sparkSession, "dtv_values")
    return _result("dtv_values", _count(dtv_mismatches(table, dtv), F.col("ok")))


def check_locations(table: DataFrame, locations: DataFrame, key: str = "name", rtol: float = RTOL) -> DataFrame:
    """Positions equal the source. ``rtol=0`` leaves the absolute tolerance alone."""
    if not _has(table, "id", "lat", "lon"):
        return skipped(table.sparkSession, "counter_locations")
    spots = locations.select(key, F.struct(F.col("latitude").alias("lat"), F.col("longitude").alias("lon")).alias("spot"))
    found = lookup_padded(table, spots, "id", key, "spot")
    known = F.col("lat").isNotNull() & F.col("lon").isNotNull() & F.col("spot").isNotNull()
    ok = is_close(F.col("lat"), F.col("spot.lat"), rtol, COORDINATE_ATOL) & is_close(F.col("lon"), F.col("spot.lon"), rtol, COORDINATE_ATOL)
    return _result("counter_locations", _count(found, ok, known))


def check_infrastructure(table: DataFrame) -> DataFrame:
    if not _has(table, "OSM_Radinfra"):
        return skipped(table.sparkSession, "infrastructure_values")
    c = F.col("OSM_Radinfra")
    return _result("infrastructure_values", _count(table, c.isin(*CATEGORIES), c.isNotNull()))


def check_regiostar(table: DataFrame) -> DataFrame:
    if not _has(table, "RegioStaR5"):
        return skipped(table.sparkSession, "regiostar_values")
    c = F.col("RegioStaR5")
    return _result("regiostar_values", _count(table, c.between(10, 60), c.isNotNull()))


def regiostar_distribution(table: DataFrame, column: str = "RegioStaR5", n: int = 10) -> DataFrame:
    counts = table.where(F.col(column).isNotNull()).groupBy(column).agg(F.count("*").alias("n"))
    return counts.orderBy(F.col("n").desc(), column).limit(n)


def check_volumes(table: DataFrame, edges: DataFrame, order: str = "edge_id") -> DataFrame:
    """Volumes equal those of the edge's way; of several edges the last one counts."""
    if not _has(table, "base_id", "Erh_SR"):
        return skipped(table.sparkSession, "traffic_volume_values")
    last = keep_first(edges.select("base_id", "count", order), ["base_id"], [-F.col(order)])
    found = table.join(last.select("base_id", F.col("count").alias("_expected")), "base_id")
    known = finite(F.col("Erh_SR")).isNotNull() & F.col("_expected").isNotNull()
    return _result("traffic_volume_values", _count(found, is_close(F.col("Erh_SR"), F.col("_expected"), RTOL, ATOL), known))


def check_derived(table: DataFrame) -> DataFrame:
    """Ratios equal their formula; missing values count as 0 on both sides."""
    tests = []
    if _has(table, "TN_SR_relativ", "n_users", "population"):
        tests.append(("TN_SR_relativ", ratio(F.col("n_users"), F.col("population"))))
    if _has(table, "Streckengewicht_SR", "n_users", "Erh_SR", "population"):
        tests.append(("Streckengewicht_SR", ratio(F.col("n_users") * F.col("Erh_SR"), F.col("population"))))
    if not tests:
        return skipped(table.sparkSession, "derived_features")

    def same(column: str, expected: Column) -> Column:
        zero = F.lit(0.0)
        return F.count_if(is_close(F.coalesce(finite(F.col(column)), zero), F.coalesce(expected, zero), RTOL, ATOL))

    counts = table.agg(
        (F.count("*") * len(tests)).alias("n_checked"), sum((same(*t) for t in tests[1:]), same(*tests[0])).alias("n_passed")
    )
    return _result("derived_features", counts, "skip")


def check_hub_distances(table: DataFrame) -> DataFrame:
    if not _has(table, "HubDist"):
        return skipped(table.sparkSession, "hub_distances")
    c = finite(F.col("HubDist"))
    return _result("hub_distances", _count(table, (c >= 0) & (c < MAX_HUB_DISTANCE), F.col("HubDist").isNotNull()))


def hub_distance_stats(table: DataFrame, column: str = "HubDist") -> DataFrame:
    c = finite(F.col(column))
    median = quantiles(table, column, {"median": 0.5})["median"]
    return table.agg(F.min(c).alias("min"), F.max(c).alias("max"), F.avg(c).alias("mean")).withColumn("median", F.lit(median).cast("double"))


def check_ranges(table: DataFrame) -> DataFrame:
    """Share of plausible values over all checked columns together."""
    present = [c for c in VALUE_RANGES if c in table.columns]
    if not present:
        return skipped(table.sparkSession, "value_ranges")
    value = {c: finite(F.col(c)) for c in present}
    checked = [F.count(value[c]) for c in present]
    passed = [F.count_if(value[c].between(*VALUE_RANGES[c])) for c in present]
    counts = table.agg(sum(checked[1:], checked[0]).alias("n_checked"), sum(passed[1:], passed[0]).alias("n_passed"))
    return _result("value_ranges", counts, "skip")


def comparison_key(left: Sequence[str], right: Sequence[str]) -> str | None:
    return next((k for k in ("id", "base_id") if k in left and k in right), None)


def _cell_equal(left: DataFrame, right: DataFrame, column: str) -> Column:
    a, b = F.col(f"l.`{column}`"), F.col(f"r.`{column}`")
    numeric = all(isinstance(d.schema[column].dataType, NumericType) for d in (left, right))
    if numeric:
        a, b = finite(a), finite(b)
        same = is_close(a, b, RTOL, ATOL)
    else:
        same = F.trim(a.cast("string")) == F.trim(b.cast("string"))
    return F.when(a.isNull() & b.isNull(), True).when(a.isNull() | b.isNull(), False).otherwise(same)


def column_agreement(table: DataFrame, reference: DataFrame, key: str) -> DataFrame:
    """Equal and unequal cells per shared column, over the rows both tables have."""
    shared = sorted((set(table.columns) & set(reference.columns)) - {key})
    joined = table.alias("l").join(reference.alias("r"), F.col(f"l.{key}") == F.col(f"r.{key}"))
    cells = [
        F.struct(F.lit(c).alias("column"), F.count_if(_cell_equal(table, reference, c)).alias("n_equal"), F.count("*").alias("n_rows"))
        for c in shared
    ]
    none = F.array().cast("array<struct<column:string,n_equal:bigint,n_rows:bigint>>")
    return joined.agg(F.concat(none, F.array(*cells)).alias("c") if cells else F.any_value(none).alias("c")).select(F.inline("c"))


def cell_mismatches(table: DataFrame, reference: DataFrame, key: str, n: int = 15) -> DataFrame:
    """First differing cells in key order."""
    shared = sorted((set(table.columns) & set(reference.columns)) - {key})
    joined = table.alias("l").join(reference.alias("r"), F.col(f"l.{key}") == F.col(f"r.{key}"))
    cells = [
        F.when(
            ~_cell_equal(table, reference, c),
            F.struct(
                F.lit(c).alias("column"),
                F.col(f"l.`{c}`").cast("string").alias("table_value"),
                F.col(f"r.`{c}`").cast("string").alias("reference_value"),
            ),
        )
        for c in shared
    ]
    none = F.array().cast("array<struct<column:string,table_value:string,reference_value:string>>")
    rows = joined.select(F.col(f"l.{key}").cast("string").alias("key"), F.inline(F.array_compact(F.array(*cells)) if cells else none))
    return rows.orderBy("key", "column").limit(n)


def compare_with_reference(table: DataFrame, reference: DataFrame) -> DataFrame:
    """All shared cells of the rows both tables have; no shared row at all is a failure."""
    name = "reference_comparison"
    key = comparison_key(table.columns, reference.columns)
    if key is None:
        return skipped(table.sparkSession, name)
    cells = column_agreement(table, reference, key)
    counts = cells.agg(
        F.coalesce(F.sum("n_rows"), F.lit(0)).alias("n_checked"), F.coalesce(F.sum("n_equal"), F.lit(0)).alias("n_passed")
    )
    return _result(name, counts, "fail")


def overall_status(checks: DataFrame) -> DataFrame:
    """fail before warn; skip only when every check was skipped."""
    status = F.col("status")
    return checks.agg(
        F.when(F.max(status == "fail"), "fail")
        .when(F.max(status == "warn"), "warn")
        .when(F.coalesce(F.min(status == "skip"), F.lit(True)), "skip")
        .otherwise("pass")
        .alias("overall_status"),
        F.count_if(status == "pass").alias("n_passed"),
        F.count_if(status == "warn").alias("n_warned"),
        F.count_if(status == "fail").alias("n_failed"),
    )


def assess(
    table: DataFrame,
    *,
    dtv: DataFrame | None = None,
    locations: DataFrame | None = None,
    edges: DataFrame | None = None,
    reference: DataFrame | None = None,
) -> DataFrame:
    """All checks as rows. A reference table replaces the recomputation."""
    spark = table.sparkSession
    if reference is not None:
        return compare_with_reference(table, reference)
    parts = [
        check_dtv(table, dtv) if dtv is not None else skipped(spark, "dtv_values"),
        check_locations(table, locations) if locations is not None else skipped(spark, "counter_locations"),
        check_infrastructure(table),
        check_regiostar(table),
        check_volumes(table, edges) if edges is not None else skipped(spark, "traffic_volume_values"),
        check_derived(table),
        check_hub_distances(table),
        check_ranges(table),
    ]
    out = parts[0]
    for p in parts[1:]:
        out = out.unionByName(p)
    return out
