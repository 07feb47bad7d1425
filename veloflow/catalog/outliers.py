"""Ratios, flags, severities and their ordering."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import outliers as out
from ..operators.columns import detect_station_columns
from ..operators.ranking import number_by_severity, sample_failures, top_importances
from ..sources.writers import counter_records, export_metadata, geojson_features, station_records
from . import stand_ins as t
from .registry import query, rounded, table

RATIO_DIGITS = 9  # ratios of whole numbers often end in a 5 at the seventh place
RATIO = "dtv / nullif(count, 0)"
BASE = f""", r AS (SELECT *, {RATIO} AS ratio, CAST(count AS DOUBLE) / nullif(dtv, 0) AS inverse FROM matched),
  f AS (SELECT quantile_cont(ratio, 0.25) AS q1, quantile_cont(ratio, 0.75) AS q3, quantile_cont(ratio, 0.5) AS med,
               avg(ratio) AS m, stddev_samp(ratio) AS s, quantile_cont(inverse, 0.25) AS i1, quantile_cont(inverse, 0.75) AS i3 FROM r)"""
NOT_VERIFIED = "verification_status <> 'verified'"
IQR_OUT = f"coalesce(ratio < q1 - 1.5 * (q3 - q1) OR ratio > q3 + 1.5 * (q3 - q1), FALSE) AND {NOT_VERIFIED}"
Z_OUT = f"coalesce(ratio < m - 3 * s OR ratio > m + 3 * s, FALSE) AND {NOT_VERIFIED}"
CRITICAL = "coalesce(ratio > 2 * (q3 + 1.5 * (q3 - q1)), FALSE)"
BIAS = f"coalesce(inverse > i3 + 1.5 * (i3 - i1), FALSE) AND {NOT_VERIFIED}"
NO_VOLUME = "(count IS NULL OR count = 0)"
AMBIGUOUS = "coalesce(d1 > 0 AND d2 / nullif(d1, 0) < 2, FALSE)"
SEVERITY = f"""CASE WHEN verification_status = 'verified' THEN 'verified' WHEN {CRITICAL} THEN 'critical' WHEN {AMBIGUOUS} THEN 'ambiguous'
   WHEN {NO_VOLUME} THEN 'no_volume' WHEN {IQR_OUT} THEN 'warning' WHEN {BIAS} THEN 'campaign_bias'
   WHEN verification_status = 'carryover' THEN 'carryover' ELSE 'ok' END"""


def _sql(body: str) -> str:
    return t.with_tables("matched") + BASE + " " + body


@query("ratios", _sql("SELECT counter_id, round(ratio, 9) AS dtv_volume_ratio FROM r"))
def ratios(spark, sf):
    return rounded(out.with_ratio(t.matched(spark, sf)).select("counter_id", "dtv_volume_ratio"), RATIO_DIGITS)


@query(
    "outliers_iqr",
    _sql(f"SELECT counter_id, {IQR_OUT} AS is_outlier, CASE WHEN {CRITICAL} THEN 'critical' WHEN {IQR_OUT} THEN 'warning' ELSE 'ok' END AS flag_severity FROM r, f"),
)
def outliers_iqr(spark, sf):
    return out.flag_outliers(out.with_ratio(t.matched(spark, sf))).select("counter_id", "is_outlier", "flag_severity")


@query(
    "outliers_zscore",
    _sql(
        f"""SELECT counter_id, {Z_OUT} AS is_outlier, CASE WHEN coalesce(ratio > 2 * (m + 3 * s), FALSE) THEN 'critical' WHEN {Z_OUT} THEN 'warning'
            ELSE 'ok' END AS flag_severity FROM r, f"""
    ),
)
def outliers_zscore(spark, sf):
    return out.flag_outliers(out.with_ratio(t.matched(spark, sf)), method="zscore").select("counter_id", "is_outlier", "flag_severity")


@query("no_volume", _sql(f"SELECT counter_id, {NO_VOLUME} AS has_no_volume FROM r"))
def no_volume(spark, sf):
    return out.flag_no_volume(t.matched(spark, sf)).select("counter_id", "has_no_volume")


@query("campaign_bias", _sql(f"SELECT counter_id, {BIAS} AS has_campaign_bias FROM r, f"))
def campaign_bias(spark, sf):
    return out.flag_campaign_bias(t.matched(spark, sf)).select("counter_id", "has_campaign_bias")


@query("ambiguous", _sql(f"SELECT counter_id, {AMBIGUOUS} AS is_ambiguous FROM r"))
def ambiguous(spark, sf):
    return out.flag_ambiguous(t.matched(spark, sf)).select("counter_id", "is_ambiguous")


@query("ambiguous_from_pairs", _sql(f"SELECT counter_id, {AMBIGUOUS} AS is_ambiguous FROM r"))
def ambiguous_from_pairs(spark, sf):
    m = t.matched(spark, sf)
    pairs = m.select("counter_id", F.posexplode("candidate_edges").alias("edge_id", "c")).select("counter_id", "edge_id", "c.distance")
    return out.flag_ambiguous_from_pairs(m, pairs).select("counter_id", "is_ambiguous")


def _all_flags(spark, sf):
    return out.detect_all(t.matched(spark, sf))


@query("severity", _sql(f"SELECT counter_id, {SEVERITY} AS flag_severity FROM r, f"))
def severity(spark, sf):
    return _all_flags(spark, sf)[0].select("counter_id", "flag_severity")


@query(
    "detect_all",
    _sql(
        f"""SELECT counter_id, round(ratio, 9) AS dtv_volume_ratio, {IQR_OUT} AS is_outlier, {NO_VOLUME} AS has_no_volume,
                   {BIAS} AS has_campaign_bias, {AMBIGUOUS} AS is_ambiguous, {SEVERITY} AS flag_severity FROM r, f"""
    ),
)
def detect_all(spark, sf):
    flagged, _ = _all_flags(spark, sf)
    cols = ("counter_id", "dtv_volume_ratio", "is_outlier", "has_no_volume", "has_campaign_bias", "is_ambiguous", "flag_severity")
    return rounded(flagged.select(*cols), RATIO_DIGITS)


@query("severity_breakdown", _sql(f"SELECT {SEVERITY} AS flag_severity, CAST(count(*) AS BIGINT) AS n FROM r, f GROUP BY 1"))
def severity_breakdown(spark, sf):
    return out.severity_breakdown(_all_flags(spark, sf)[0])


@query(
    "detection_summary",
    _sql(
        f"""SELECT CAST(count(*) AS BIGINT) AS n_counters, CAST(count(*) FILTER (WHERE {SEVERITY} NOT IN ('ok', 'verified')) AS BIGINT) AS n_flagged,
                   round(max(q1 - 1.5 * (q3 - q1)), 6) AS threshold_lower, round(max(q3 + 1.5 * (q3 - q1)), 6) AS threshold_upper,
                   round(max(med), 6) AS median_ratio FROM r, f"""
    ),
)
def detection_summary(spark, sf):
    flagged, fences = _all_flags(spark, sf)
    return rounded(out.detection_summary(flagged, fences))


@query(
    "severity_sort",
    _sql(
        f"""SELECT counter_id, flag_severity, round(ratio, 9) AS dtv_volume_ratio, CAST(row_number() OVER (ORDER BY pr, ratio DESC NULLS LAST, counter_id) AS BIGINT) AS position
            FROM (SELECT *, CASE flag_severity WHEN 'critical' THEN 0 WHEN 'ambiguous' THEN 1 WHEN 'no_volume' THEN 2 WHEN 'warning' THEN 3
                         WHEN 'campaign_bias' THEN 4 WHEN 'carryover' THEN 5 WHEN 'ok' THEN 6 ELSE 7 END AS pr
                  FROM (SELECT *, {SEVERITY} AS flag_severity FROM r, f))"""
    ),
)
def severity_sort(spark, sf):
    flags = _all_flags(spark, sf)[0].select("counter_id", "flag_severity", "dtv_volume_ratio")
    return rounded(number_by_severity(flags, tie=["counter_id"]), RATIO_DIGITS)


@query(
    "verification_records",
    _sql(
        f"""SELECT counter_id, dtv, count, round(ratio, 9) AS ratio, {SEVERITY} AS flag_severity, verification_status, {IQR_OUT} AS is_outlier,
                   {NO_VOLUME} AS has_no_volume, CAST(CASE WHEN d2 IS NULL THEN 1 ELSE 2 END AS INTEGER) AS n_candidates FROM r, f"""
    ),
)
def verification_records(spark, sf):
    records = counter_records(_all_flags(spark, sf)[0])
    return rounded(
        records.select(
            "counter_id", "dtv", "count", "ratio", "flag_severity", "verification_status", "is_outlier", "has_no_volume",
            F.size("candidate_edges").alias("n_candidates"),
        ),
        RATIO_DIGITS,
    )


@query(
    "verification_metadata",
    _sql(
        f"""SELECT CAST(2024 AS INTEGER) AS year, CAST(count(*) AS BIGINT) AS n_counters,
                   CAST(count(*) FILTER (WHERE {SEVERITY} NOT IN ('ok', 'verified')) AS BIGINT) AS n_flagged,
                   CAST(count(*) FILTER (WHERE {SEVERITY} = 'critical') AS BIGINT) AS n_critical, round(max(med), 6) AS median_ratio FROM r, f"""
    ),
)
def verification_metadata(spark, sf):
    flagged, fences = _all_flags(spark, sf)
    meta = export_metadata(flagged, 2024, fences)
    return rounded(
        meta.select("year", "n_counters", "n_flagged", F.coalesce(F.col("n_by_severity.critical"), F.lit(0)).alias("n_critical"), "median_ratio")
    )


@query(
    "counter_geojson",
    t.sql(
        """SELECT '{"type":"Feature","geometry":{"type":"Point","coordinates":[' || CAST(longitude AS VARCHAR) || ',' || CAST(latitude AS VARCHAR)
                  || ']},"properties":{"counter_id":"' || counter_id || '","longitude":' || CAST(longitude AS VARCHAR) || ',"is_outlier":'
                  || CASE WHEN k % 2 = 0 THEN 'true' ELSE 'false' END || '}}' AS value FROM counter""",
        "counter",
    ),
)
def counter_geojson(spark, sf):
    c = t.counter(spark, sf).withColumn("is_outlier", F.col("k") % 2 == 0)
    # the latitude is named differently here and so stays out of the properties
    c = c.withColumnRenamed("latitude", "lat").select("counter_id", "longitude", "lat", "is_outlier")
    return geojson_features(c, lat="lat")


STATION_CASE = """CASE WHEN y_true < 25 THEN 'warning' WHEN y_true > 10000 THEN 'warning' WHEN y_true / nullif(y_pred, 0) > 3 OR y_true / nullif(y_pred, 0) < 0.33 THEN 'warning' ELSE 'ok' END"""
REASON_CASE = """CASE WHEN y_true > 10000 THEN 'Very high DTV (> 10000)' WHEN y_true < 25 THEN 'Very low DTV (< 25)'
   WHEN y_true / nullif(y_pred, 0) > 3 OR y_true / nullif(y_pred, 0) < 0.33 THEN 'Large prediction discrepancy (ratio > 3x or < 0.33x)' ELSE '' END"""


@query(
    "station_flags",
    t.sql(f"SELECT id, {STATION_CASE} AS flag_severity, {REASON_CASE} AS flag_reason, round(y_true / nullif(y_pred, 0), 6) AS dtv_pred_ratio FROM station", "station"),
)
def station_flags(spark, sf):
    flagged = out.flag_stations(t.station(spark, sf), "y_true", "y_pred")
    return rounded(flagged.select("id", "flag_severity", "flag_reason", "dtv_pred_ratio"))


@query(
    "station_records",
    t.sql(f"SELECT CAST(id AS VARCHAR) AS counter_id, y_true AS dtv, {STATION_CASE} AS flag_severity, y_pred AS predicted_dtv FROM station", "station"),
)
def station_records_query(spark, sf):
    flagged = out.flag_stations(t.station(spark, sf).withColumnRenamed("y_true", "dtv"), "dtv", "y_pred")
    assert detect_station_columns(flagged.columns)["id"] == "id"
    return station_records(flagged).select("counter_id", "dtv", "flag_severity", "predicted_dtv")


@query(
    "failure_sample",
    "SELECT o_orderkey, o_totalprice FROM orders WHERE o_totalprice < 3000 ORDER BY o_totalprice, o_orderkey LIMIT 10",
)
def failure_sample(spark, sf):
    failed = table(spark, sf, "orders").where("o_totalprice < 3000").select("o_orderkey", "o_totalprice")
    return sample_failures(failed, ["o_totalprice", "o_orderkey"], 10)


@query(
    "top_importance",
    """SELECT feature, importance, round(importance * 100 / (SELECT sum(i) FROM (SELECT sum(l_quantity) AS i FROM lineitem GROUP BY l_partkey)), 6) AS percent
       FROM (SELECT CAST(l_partkey AS VARCHAR) AS feature, sum(l_quantity) AS importance FROM lineitem GROUP BY 1) ORDER BY importance DESC, feature LIMIT 15""",
)
def top_importance(spark, sf):
    sums = table(spark, sf, "lineitem").groupBy(F.col("l_partkey").cast("string").alias("feature")).agg(F.sum("l_quantity").alias("importance"))
    return rounded(top_importances(sums, 15), 6, "percent")
