"""Measurements, targets, periods, names, infrastructure, features and training filters."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.region_keys import in_region, level_key, normalize_key, pad_left
from ..operators import features as feat
from ..operators import infrastructure as infra
from ..operators import periods, targets
from ..operators.columns import model_features, to_export_names, to_internal_names
from ..operators.contracts import check_stations
from ..operators.dedupe import keep_first, keep_highest
from ..operators.joins import join_targets_to_locations, lookup_padded
from ..sources.readers import image_counts, measurements_to_long
from ..sources.training_data import prepare_training_data
from . import stand_ins as t
from .registry import query, rounded, table

START, END = "2024-01-03", "2024-01-25"
DAYS = 23

DTV_SQL = f"""
    SELECT counter_id, round_even(avg(n), 0) AS dtv, CAST(count(n) AS BIGINT) AS observation_count,
           CAST({DAYS} - count(n) AS BIGINT) AS missing_days, CAST(count(*) FILTER (WHERE n = 0) AS BIGINT) AS zero_days,
           count(n) / CAST({DAYS} AS DOUBLE) * (1 - count(*) FILTER (WHERE n = 0) / CAST(greatest(count(n), 1) AS DOUBLE) * 0.5::DOUBLE) AS q
    FROM daily WHERE day BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}' GROUP BY 1"""


def _daily_traffic(spark, sf):
    return targets.daily_traffic(t.daily(spark, sf), START, END)


@query(
    "dtv_by_counter",
    t.sql(
        f"""SELECT counter_id, dtv, observation_count, missing_days, zero_days, round(q, 6) AS quality_score,
                  q >= 0.5 AND observation_count >= 7 AS is_valid FROM ({DTV_SQL})""",
        "daily",
    ),
)
def dtv_by_counter(spark, sf):
    return rounded(_daily_traffic(spark, sf))


@query("dtv_valid", t.sql(f"SELECT counter_id, dtv, round(q, 6) AS quality_score FROM ({DTV_SQL}) WHERE q >= 0.4 AND observation_count >= 10", "daily"))
def dtv_valid(spark, sf):
    kept = targets.filter_quality(_daily_traffic(spark, sf), 0.4, 10)
    return rounded(kept.select("counter_id", "dtv", "quality_score"))


@query(
    "dtv_from_lineitem",
    """WITH m AS (SELECT l_suppkey, date_trunc('day', l_shipdate) AS day, sum(l_quantity) AS n FROM lineitem GROUP BY 1, 2)
       SELECT CAST(l_suppkey AS VARCHAR) AS counter_id, round_even(avg(n), 0) AS dtv, CAST(count(*) AS BIGINT) AS observation_count,
              CAST(365 - count(*) AS BIGINT) AS missing_days, CAST(count(*) FILTER (WHERE n = 0) AS BIGINT) AS zero_days,
              round(count(*) / 365::DOUBLE * (1 - count(*) FILTER (WHERE n = 0) / count(*)::DOUBLE * 0.5::DOUBLE), 6) AS quality_score
       FROM m WHERE day BETWEEN TIMESTAMP '1997-01-01' AND TIMESTAMP '1997-12-31' GROUP BY 1""",
)
def dtv_from_lineitem(spark, sf):
    day = F.date_trunc("day", "l_shipdate").cast("timestamp_ntz")
    m = table(spark, sf, "lineitem").groupBy(F.col("l_suppkey").alias("counter_id"), day.alias("timestamp")).agg(F.sum("l_quantity").alias("count"))
    out = targets.daily_traffic(m, "1997-01-01", "1997-12-31")
    return rounded(out.select("counter_id", "dtv", "observation_count", "missing_days", "zero_days", "quality_score"))


@query(
    "dtv_precomputed",
    "SELECT trim(s_name) AS counter_id, s_acctbal AS dtv, CAST(1 AS DOUBLE) AS quality_score, TRUE AS is_valid FROM supplier WHERE s_acctbal IS NOT NULL",
)
def dtv_precomputed(spark, sf):
    return targets.targets_from_locations(table(spark, sf, "supplier"), "s_name", "s_acctbal")


@query(
    "campaign_filter",
    f"SELECT event_id, user_id, event_type FROM events WHERE ts BETWEEN TIMESTAMP '{START}' AND TIMESTAMP '{END}'",
)
def campaign_filter(spark, sf):
    return periods.filter_period(table(spark, sf, "events"), START, END, "ts").select("event_id", "user_id", "event_type")


@query(
    "counter_period_filter",
    "SELECT o_orderkey, o_custkey FROM orders WHERE o_orderdate BETWEEN TIMESTAMP '1996-05-01' AND TIMESTAMP '1996-09-30'",
)
def counter_period_filter(spark, sf):
    return periods.filter_period(table(spark, sf, "orders"), "1996-05-01", "1996-09-30", "o_orderdate").select("o_orderkey", "o_custkey")


@query(
    "holiday_flag",
    "SELECT event_id, ts BETWEEN TIMESTAMP '2024-01-10' AND TIMESTAMP '2024-01-14' AS is_holiday FROM events",
)
def holiday_flag(spark, sf):
    return periods.with_holiday_flag(table(spark, sf, "events"), "2024-01-10", "2024-01-14", "ts").select("event_id", "is_holiday")


@query(
    "campaign_days",
    """SELECT o_custkey, CAST(date_diff('day', CAST(min(o_orderdate) AS DATE), CAST(max(o_orderdate) AS DATE)) + 1 AS INTEGER) AS campaign_days
       FROM orders GROUP BY 1""",
)
def campaign_days(spark, sf):
    spans = table(spark, sf, "orders").groupBy("o_custkey").agg(F.min("o_orderdate").alias("s"), F.max("o_orderdate").alias("e"))
    return periods.with_period_days(spans, "s", "e").select("o_custkey", "campaign_days")


@query(
    "measurement_unpivot",
    """WITH w AS (SELECT date_trunc('day', ts) AS day,
                        CAST(sum(value) FILTER (WHERE event_type = 'click') AS DOUBLE) AS a,
                        CAST(sum(value) FILTER (WHERE event_type = 'error') AS DOUBLE) AS b,
                        CAST(sum(value) FILTER (WHERE event_type = 'view') AS DOUBLE) AS c,
                        CAST(sum(CASE WHEN value > 200 THEN value END) FILTER (WHERE event_type = 'signup') AS DOUBLE) AS d,
                        CAST(sum(value) FILTER (WHERE event_type = 'purchase') AS DOUBLE) AS e FROM events GROUP BY 1)
       SELECT day AS timestamp, counter_id, CAST(trunc(n) AS BIGINT) AS count
       FROM (SELECT day, 'click' AS counter_id, a AS n FROM w UNION ALL SELECT day, 'error', b FROM w UNION ALL SELECT day, 'view', c FROM w
             UNION ALL SELECT day, 'signup', d FROM w UNION ALL SELECT day, 'purchase', e FROM w)
       WHERE n IS NOT NULL""",
)
def measurement_unpivot(spark, sf):
    e = table(spark, sf, "events")
    day = F.date_trunc("day", "ts").cast("timestamp_ntz").alias("timestamp")
    # small sign-ups count as cells without a number
    number = F.when((F.col("event_type") != "signup") | (F.col("value") > 200), F.col("value"))
    wide = e.groupBy(day).pivot("event_type", ["click", "error", "view", "signup", "purchase"]).agg(F.sum(number))
    return measurements_to_long(wide, "timestamp")


# --- names and keys --------------------------------------------------------------------------

PAD = "CASE WHEN length(s) < 12 THEN lpad(s, 12, '0') ELSE s END"


@query("ars_pad", f"SELECT c_custkey, {PAD} AS ars FROM (SELECT c_custkey, CAST(c_custkey * 1000003 AS VARCHAR) AS s FROM customer)")
def ars_pad(spark, sf):
    return table(spark, sf, "customer").select("c_custkey", pad_left(F.col("c_custkey") * 1000003).alias("ars"))


@query(
    "ars_normalize",
    f"""SELECT c_custkey, CASE WHEN length(s) >= 12 THEN substr(s, 1, 12) WHEN length(s) = 0 THEN '000000000000'
              WHEN TRY_CAST(substr(s, 1, 2) AS INTEGER) BETWEEN 1 AND 16 THEN rpad(s, 12, '0') ELSE {PAD} END AS ars
       FROM (SELECT c_custkey, trim(CASE c_custkey % 3 WHEN 0 THEN CAST(c_custkey AS VARCHAR) WHEN 1 THEN c_name
                    ELSE CAST(c_custkey * 1000000007 AS VARCHAR) END) AS s FROM customer)""",
)
def ars_normalize(spark, sf):
    k = F.col("c_custkey")
    code = F.when(k % 3 == 0, k.cast("string")).when(k % 3 == 1, F.col("c_name")).otherwise((k * 1000000007).cast("string"))
    return table(spark, sf, "customer").select("c_custkey", normalize_key(code).alias("ars"))


@query(
    "ars_level_key",
    t.sql(
        """SELECT k, rpad(substr(ars, 1, 2), 12, '0') AS land, rpad(substr(ars, 1, 5), 12, '0') AS kreis,
                  rpad(substr(ars, 1, 9), 12, '0') AS vg FROM commune""",
        "commune",
    ),
)
def ars_level_key(spark, sf):
    ars = F.col("ars")
    return t.commune(spark, sf).select("k", level_key(ars, 2).alias("land"), level_key(ars, 5).alias("kreis"), level_key(ars, 9).alias("vg"))


@query("region_prefix", t.sql("SELECT k, ars FROM commune WHERE starts_with(ars, '03')", "commune"))
def region_prefix(spark, sf):
    return t.commune(spark, sf).where(in_region(F.col("ars"), "030000000000")).select("k", "ars")


@query(
    "column_names",
    """SELECT c_custkey AS "id", c_acctbal AS "DZS_mean_SR", coalesce(CAST(NULL AS BIGINT), c_custkey) AS "Erh_SR" FROM customer""",
)
def column_names(spark, sf):
    df = table(spark, sf, "customer").select(
        F.col("c_custkey").alias("id"), F.col("c_acctbal").alias("DTV"), F.lit(None).cast("bigint").alias("n"), F.col("c_custkey").alias("Erh_SR")
    )
    return df.transform(to_internal_names).transform(to_export_names)


# --- infrastructure --------------------------------------------------------------------------

RAW_CASE = """CASE WHEN regexp_matches(raw, '^bicycle_lane_.*$') THEN 'bicycle_lane' WHEN regexp_matches(raw, '^bus_lane_.*$') THEN 'bicycle_lane'
     WHEN regexp_matches(raw, '^bicycle_way_.*$') THEN 'bicycle_way' {extra}
     WHEN regexp_matches(raw, '^mit_road.*$') THEN 'mit_road' WHEN regexp_matches(raw, '^mixed_way.*$') THEN 'mixed_way'
     WHEN raw IN ('path_not_forbidden', 'pedestrian_both', 'service_misc') THEN 'no' {valid} ELSE 'no' END"""
VALID = "WHEN raw IN ('no','mixed_way','mit_road','bicycle_lane','bicycle_road','bicycle_way') THEN raw"
INFRA_SQL = RAW_CASE.format(extra="", valid=VALID)
OUTPUT_SQL = RAW_CASE.format(extra="WHEN regexp_matches(raw, '^bicycle_road.*$') THEN 'bicycle_road'", valid=VALID)
CURATED_SQL = RAW_CASE.format(extra="", valid="")


@query("infra_map", t.sql(f"SELECT edge_id, {INFRA_SQL} AS infra_category FROM edge_class", "edge_class"))
def infra_map(spark, sf):
    return infra.map_infrastructure(t.edge_class(spark, sf), "raw").select("edge_id", "infra_category")


@query("infra_output_map", t.sql(f"SELECT edge_id, {OUTPUT_SQL} AS infra_category FROM edge_class", "edge_class"))
def infra_output_map(spark, sf):
    named = t.edge_class(spark, sf).withColumnRenamed("raw", "infra_category")
    return infra.map_output_infrastructure(named).select("edge_id", "infra_category")


@query("infra_curated_map", t.sql(f"SELECT edge_id, {CURATED_SQL} AS infra_category FROM edge_class", "edge_class"))
def infra_curated_map(spark, sf):
    shouted = t.edge_class(spark, sf).withColumn("infra_category", F.upper("raw"))
    return infra.map_curated_infrastructure(shouted).select("edge_id", "infra_category")


@query("infra_distribution", t.sql(f"SELECT {INFRA_SQL} AS infra_category, CAST(count(*) AS BIGINT) AS n FROM edge_class GROUP BY 1", "edge_class"))
def infra_distribution(spark, sf):
    return infra.infrastructure_distribution(infra.map_infrastructure(t.edge_class(spark, sf), "raw"))


# --- features --------------------------------------------------------------------------------

FEATURE_SQL = {
    "participation_rate": "CAST(n_users AS DOUBLE) / nullif(population, 0)",
    "route_intensity": "CAST(n_users AS DOUBLE) * stadtradeln_volume / nullif(population, 0)",
    "volume_per_trip": "CAST(stadtradeln_volume AS DOUBLE) / nullif(n_trips, 0) * n_users",
    "trips_per_user": "CAST(n_trips AS DOUBLE) / nullif(n_users, 0)",
    "km_per_user": "total_km / nullif(n_users, 0)",
    "volume_density": "CAST(stadtradeln_volume AS DOUBLE) / nullif(population, 0)",
}


def _feature_list(names):
    return ", ".join(f"round({FEATURE_SQL[n]}, 6) AS {n}" for n in names)


@query("features_all", t.sql(f"SELECT k, {_feature_list(FEATURE_SQL)} FROM commune", "commune"))
def features_all(spark, sf):
    return rounded(feat.derive_features(t.commune(spark, sf)).select("k", *FEATURE_SQL))


@query("feature_subset", t.sql(f"SELECT k, {_feature_list(['trips_per_user', 'km_per_user'])} FROM commune", "commune"))
def feature_subset(spark, sf):
    # no volume here: the unknown name and the features that need it are skipped
    df = t.commune(spark, sf).drop("stadtradeln_volume")
    return rounded(feat.derive_features(df, ["trips_per_user", "unknown", "volume_density", "km_per_user"]).select("k", "trips_per_user", "km_per_user"))


@query("curated_features", t.sql(f"SELECT k, {_feature_list(['participation_rate', 'route_intensity'])} FROM commune", "commune"))
def curated_features(spark, sf):
    return rounded(feat.curated_features(t.commune(spark, sf)).select("k", "participation_rate", "route_intensity"))


@query(
    "feature_validity",
    t.sql(
        """SELECT 'n_users' AS feature, count(n_users) > 0 AS is_valid FROM commune
           UNION ALL SELECT 'participation_rate', count(CASE WHEN population > 0 THEN 1 END) > 0 FROM commune
           UNION ALL SELECT 'absent', FALSE""",
        "commune",
    ),
)
def feature_validity(spark, sf):
    df = feat.derive_features(t.commune(spark, sf))
    return feat.usable_features(df, ["n_users", "participation_rate", "absent"])


@query(
    "prepare_output",
    t.sql(
        f"""SELECT {OUTPUT_SQL} AS "OSM_Radinfra", round({FEATURE_SQL["participation_rate"]}, 6) AS "TN_SR_relativ",
                  round({FEATURE_SQL["route_intensity"]}, 6) AS "Streckengewicht_SR",
                  stadtradeln_volume AS "Erh_SR", CAST(c.k AS VARCHAR) AS id, e.base_id, total_km AS "DZS_mean_SR"
           FROM commune c JOIN edge_class e ON c.k = e.edge_id""",
        "commune",
        "edge_class",
    ),
)
def prepare_output(spark, sf):
    joined = t.commune(spark, sf).join(t.edge_class(spark, sf), F.col("k") == F.col("edge_id"))
    df = joined.select(
        F.col("k").alias("counter_id"),
        F.col("stadtradeln_volume").alias("count"),
        F.col("total_km").alias("dtv"),
        F.col("raw").alias("OSM_Radinfra"),
        "n_users",
        "population",
        "base_id",
    )
    return rounded(feat.training_table(feat.derive_features(to_internal_names(df))))


@query(
    "alias_resolve",
    t.sql(
        """SELECT id, "OSM_Radinfra" AS infra_category, round("TN_SR_relativ", 6) AS participation_rate,
                  "RegioStaR7" AS regiostar7, "Erh_SR" AS stadtradeln_volume, "HubDist" AS dist_to_center_m FROM training""",
        "training",
    ),
)
def alias_resolve(spark, sf):
    df = t.training(spark, sf)
    wanted = ["infra_category", "participation_rate", "regiostar7", "stadtradeln_volume", "dist_to_center_m", "nobody_has_this"]
    return rounded(model_features(df, wanted, keep=["id"]))


# --- training filters ------------------------------------------------------------------------


@query("filter_bounds", t.sql('SELECT id, "DZS_mean_SR" AS dtv FROM training WHERE "DZS_mean_SR" BETWEEN 200 AND 4000', "training"))
def filter_bounds(spark, sf):
    df = t.training(spark, sf).withColumnRenamed("DZS_mean_SR", "dtv")
    return targets.filter_bounds(df, "dtv", 200, 4000).select("id", "dtv")


@query(
    "filter_curated",
    t.sql('SELECT id, "DZS_mean_SR" AS dtv FROM training WHERE "DZS_mean_SR" >= 200 AND "Erh_SR" > 0', "training"),
)
def filter_curated(spark, sf):
    df = t.training(spark, sf).withColumnsRenamed({"DZS_mean_SR": "dtv", "Erh_SR": "stadtradeln_volume"})
    return targets.filter_curated_bounds(df, 200).select("id", "dtv")


RATIO = '"DZS_mean_SR" / nullif("Erh_SR", 0)'


@query("ratio_filter", t.sql(f"SELECT id FROM training WHERE {RATIO} IS NULL OR {RATIO} BETWEEN 5 AND 60", "training"))
def ratio_filter(spark, sf):
    return targets.filter_volume_ratio(t.training(spark, sf), "DZS_mean_SR", 5, 60).select("id")


FENCE = """f AS (SELECT quantile_cont(v, 0.25) AS a, quantile_cont(v, 0.75) AS b FROM {src})"""
SKEWED = 'SELECT id, CASE WHEN CAST(id AS BIGINT) % 200 = 7 THEN "DZS_mean_SR" * 50 ELSE "DZS_mean_SR" END AS v FROM training'


def _skewed(spark, sf):
    return t.training(spark, sf).select(
        "id", F.when(F.col("id").cast("bigint") % 200 == 7, F.col("DZS_mean_SR") * 50).otherwise(F.col("DZS_mean_SR")).alias("v")
    )


@query(
    "target_quality",
    t.with_tables("training")
    + f""", s AS ({SKEWED}), {FENCE.format(src="s")}
        SELECT CAST(count(*) AS BIGINT) AS total_samples, CAST(count(*) FILTER (WHERE v >= 100 AND v <= 20000) AS BIGINT) AS valid_samples,
               CAST(count(*) FILTER (WHERE v IS NULL) AS BIGINT) AS missing_target_count,
               CAST(count(*) FILTER (WHERE v < 100) AS BIGINT) AS below_min_count, CAST(count(*) FILTER (WHERE v > 20000) AS BIGINT) AS above_max_count,
               CAST(count(*) FILTER (WHERE v < a - 3 * (b - a) OR v > b + 3 * (b - a)) AS BIGINT) AS outlier_count,
               round(count(*) FILTER (WHERE v >= 100 AND v <= 20000) / count(*), 6) AS valid_ratio FROM s, f""",
)
def target_quality(spark, sf):
    return rounded(targets.assess_target(_skewed(spark, sf), "v", 100, 20000))


@query(
    "target_filter_outliers",
    t.with_tables("training")
    + f""", s AS (SELECT * FROM ({SKEWED}) WHERE v >= 100), {FENCE.format(src="s")}
        SELECT id, round(v, 6) AS v FROM s, f WHERE v BETWEEN a - 3 * (b - a) AND b + 3 * (b - a)""",
)
def target_filter_outliers(spark, sf):
    return rounded(targets.filter_target(_skewed(spark, sf), "v", 100, remove_outliers=True))


STATS = """round(avg({c}), 6) AS mean, round(stddev_samp({c}), 6) AS std, round(min({c}), 6) AS min, round(max({c}), 6) AS max,
           round(quantile_cont({c}, 0.25), 6) AS q25, round(quantile_cont({c}, 0.5), 6) AS median, round(quantile_cont({c}, 0.75), 6) AS q75"""


@query("target_stats", "SELECT " + STATS.format(c="o_totalprice") + " FROM orders")
def target_stats(spark, sf):
    return rounded(targets.target_statistics(table(spark, sf, "orders"), "o_totalprice"))


@query("matched_inhabited", t.sql("SELECT k, counter_id FROM matched WHERE count IS NOT NULL", "matched"))
def matched_inhabited(spark, sf):
    return targets.matched_only(t.matched(spark, sf), "count").select("k", "counter_id")


@query("drop_uninhabited", t.sql("SELECT k FROM commune WHERE population <> 0", "commune"))
def drop_uninhabited(spark, sf):
    return targets.drop_uninhabited(t.commune(spark, sf)).select("k")


@query("complete_cases", t.sql("SELECT counter_id FROM matched WHERE count IS NOT NULL AND dtv IS NOT NULL", "matched"))
def complete_cases(spark, sf):
    return targets.complete_cases(t.matched(spark, sf), ["count", "dtv"]).select("counter_id")


DEDUPE_SQL = """SELECT id, base_id, "DZS_mean_SR" AS dtv FROM (
      SELECT *, row_number() OVER (PARTITION BY base_id ORDER BY "DZS_mean_SR" DESC NULLS LAST, id) AS rn FROM training) WHERE rn = 1 OR base_id = -1"""


@query("edge_dedupe", t.sql(DEDUPE_SQL, "training"))
def edge_dedupe(spark, sf):
    df = t.training(spark, sf).select("id", "base_id", F.col("DZS_mean_SR").alias("dtv"))
    return keep_highest(df, "dtv", tie="id")


@query(
    "first_per_counter",
    "SELECT l_suppkey, min(l_orderkey) AS l_orderkey FROM lineitem GROUP BY 1",
)
def first_per_counter(spark, sf):
    df = table(spark, sf, "lineitem").select("l_suppkey", "l_orderkey")
    return keep_first(df, ["l_suppkey"], [F.col("l_orderkey")])


@query(
    "training_data",
    t.sql(
        f"""SELECT id, round("DZS_mean_SR", 6) AS dtv, "Erh_SR" AS stadtradeln_volume, "OSM_Radinfra" AS infra_category
           FROM (SELECT *, row_number() OVER (PARTITION BY base_id ORDER BY "DZS_mean_SR" DESC, id) AS rn FROM training
                 WHERE "DZS_mean_SR" BETWEEN 100 AND 4500)
           WHERE (rn = 1 OR base_id = -1) AND ({RATIO} IS NULL OR {RATIO} BETWEEN 5 AND 60)""",
        "training",
    ),
)
def training_data(spark, sf):
    data = prepare_training_data(t.training(spark, sf), min_dtv=100, max_dtv=4500, min_ratio=5, max_ratio=60, test_size=0.2)
    both = data.train.unionByName(data.test)
    return rounded(both.select("id", "dtv", "stadtradeln_volume", "infra_category"))


# --- small joins of counters -----------------------------------------------------------------


@query(
    "join_locations",
    t.sql(
        f"""SELECT d.counter_id, d.dtv, c.longitude, c.latitude FROM (SELECT * FROM ({DTV_SQL}) WHERE q >= 0.5 AND observation_count >= 7) d
           JOIN (SELECT CAST(k AS VARCHAR) AS name, longitude, latitude FROM counter) c ON d.counter_id = c.name""",
        "daily",
        "counter",
    ),
)
def join_locations(spark, sf):
    locations = t.counter(spark, sf).select(F.concat(F.col("k").cast("string"), F.lit(" ")).alias("name"), "longitude", "latitude")
    joined = join_targets_to_locations(_daily_traffic(spark, sf), locations)
    return joined.select("counter_id", "dtv", "longitude", "latitude")


@query(
    "lookup_padded",
    t.sql("SELECT CAST(l_suppkey AS VARCHAR) AS id, c.latitude FROM (SELECT DISTINCT l_suppkey FROM lineitem) l JOIN counter c ON c.k = l.l_suppkey", "counter"),
)
def lookup_padded_query(spark, sf):
    ids = table(spark, sf, "lineitem").select(F.col("l_suppkey").cast("string").alias("id")).distinct()
    return lookup_padded(ids, t.counter(spark, sf), "id", "counter_id", "latitude")


@query(
    "image_counts",
    """SELECT c_custkey AS counter_id, CAST(count(o_orderkey) AS BIGINT) AS image_count
       FROM customer LEFT JOIN orders ON o_custkey * 2 = c_custkey GROUP BY 1""",
)
def image_counts_query(spark, sf):
    images = table(spark, sf, "orders").select((F.col("o_custkey") * 2).alias("counter_id"))
    return image_counts(images, table(spark, sf, "customer").select(F.col("c_custkey").alias("counter_id")))


@query(
    "station_checks",
    t.sql(
        """SELECT CAST(count(*) AS BIGINT) AS n_stations, CAST(0 AS BIGINT) AS n_missing_dtv, CAST(count(*) FILTER (WHERE s_acctbal < 0) AS BIGINT) AS n_negative_dtv,
                  CAST(count(*) FILTER (WHERE NOT (latitude BETWEEN 47 AND 56 AND longitude BETWEEN 5.5 AND 15.5)) AS BIGINT) AS n_outside FROM counter""",
        "counter",
    ),
)
def station_checks(spark, sf):
    return check_stations(t.counter(spark, sf).withColumnsRenamed({"counter_id": "id", "s_acctbal": "dtv"}))
