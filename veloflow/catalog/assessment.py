"""Checks of a table against its sources."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import assessment as q
from . import stand_ins as t
from .registry import query, rounded, table

STATUS = "CASE WHEN n_checked = 0 THEN 'warn' WHEN n_passed / n_checked >= 0.95 THEN 'pass' WHEN n_passed / n_checked >= 0.8 THEN 'warn' ELSE 'fail' END"


def _check(name: str, counts: str) -> str:
    """Check row from a statement with n_checked and n_passed."""
    return f"""SELECT '{name}' AS check_name, CAST(n_checked AS BIGINT) AS n_checked, CAST(n_passed AS BIGINT) AS n_passed,
                      CAST(n_checked - n_passed AS BIGINT) AS n_failed, round(n_passed / n_checked, 6) AS match_rate, {STATUS} AS status FROM ({counts})"""


# the written table has one wrong target in ten
WRONG = "CASE WHEN k % 10 = 3 THEN s_acctbal * 1.5 ELSE s_acctbal END"


def _written(spark, sf):
    k = F.col("k")
    return t.counter(spark, sf).select(
        k.cast("string").alias("id"),
        k,
        F.when(k % 10 == 3, F.col("s_acctbal") * 1.5).otherwise(F.col("s_acctbal")).alias("DZS_mean_SR"),
        (F.col("latitude") + F.when(k % 4 == 1, 0.01).otherwise(0.0)).alias("lat"),
        F.col("longitude").alias("lon"),
        (k * 30 % 100).alias("base_id"),
    )


@query(
    "check_dtv",
    t.sql(
        _check(
            "dtv_values",
            f"SELECT count(*) AS n_checked, count(*) FILTER (WHERE abs(v - s_acctbal) <= 1e-8::DOUBLE + 1e-5::DOUBLE * abs(s_acctbal)) AS n_passed FROM (SELECT *, {WRONG} AS v FROM counter)",
        ),
        "counter",
    ),
)
def check_dtv(spark, sf):
    source = t.counter(spark, sf).select("counter_id", F.col("s_acctbal").alias("dtv"))
    return rounded(q.check_dtv(_written(spark, sf), source))


@query(
    "check_locations",
    t.sql(_check("counter_locations", "SELECT count(*) AS n_checked, count(*) FILTER (WHERE k % 4 <> 1) AS n_passed FROM counter"), "counter"),
)
def check_locations(spark, sf):
    return rounded(q.check_locations(_written(spark, sf), t.counter(spark, sf), "counter_id"))


@query(
    "check_infrastructure",
    t.sql(
        _check(
            "infrastructure_values",
            """SELECT count(raw) AS n_checked, count(*) FILTER (WHERE raw IN ('no','mixed_way','mit_road','bicycle_lane','bicycle_road','bicycle_way')) AS n_passed
               FROM edge_class""",
        ),
        "edge_class",
    ),
)
def check_infrastructure(spark, sf):
    return rounded(q.check_infrastructure(t.edge_class(spark, sf).withColumnRenamed("raw", "OSM_Radinfra")))


@query(
    "check_regiostar",
    _check("regiostar_values", "SELECT count(p_size) AS n_checked, count(*) FILTER (WHERE p_size BETWEEN 10 AND 60) AS n_passed FROM part"),
)
def check_regiostar(spark, sf):
    return rounded(q.check_regiostar(table(spark, sf, "part").withColumnRenamed("p_size", "RegioStaR5")))


@query(
    "regiostar_distribution",
    'SELECT p_size AS "RegioStaR5", CAST(count(*) AS BIGINT) AS n FROM part GROUP BY 1 ORDER BY n DESC, 1 LIMIT 10',
)
def regiostar_distribution(spark, sf):
    return q.regiostar_distribution(table(spark, sf, "part").withColumnRenamed("p_size", "RegioStaR5"))


@query(
    "check_volumes",
    t.sql(
        _check(
            "traffic_volume_values",
            """SELECT count(*) AS n_checked, count(*) FILTER (WHERE abs(w.v - e.count) <= 1e-8::DOUBLE + 1e-5::DOUBLE * abs(e.count)) AS n_passed
               FROM (SELECT edge_id, base_id, CASE WHEN edge_id % 8 = 0 THEN count + 1 ELSE count END AS v FROM edge) w
               JOIN (SELECT base_id, arg_max(count, edge_id) AS count FROM edge GROUP BY 1) e ON w.base_id = e.base_id""",
        ),
        "edge",
    ),
)
def check_volumes(spark, sf):
    edges = t.edge(spark, sf)
    written = edges.select("base_id", (F.col("count") + F.when(F.col("edge_id") % 8 == 0, 1).otherwise(0)).alias("Erh_SR"))
    return rounded(q.check_volumes(written, edges))


@query(
    "check_derived",
    t.sql(
        _check(
            "derived_features",
            """SELECT 2 * count(*) AS n_checked,
                      count(*) FILTER (WHERE abs(coalesce(CAST(n_users AS DOUBLE) / nullif(population, 0), 0) * (CASE WHEN k % 5 = 2 THEN 1.01::DOUBLE ELSE 1 END)
                          - coalesce(CAST(n_users AS DOUBLE) / nullif(population, 0), 0)) <= 1e-8::DOUBLE + 1e-5::DOUBLE * abs(coalesce(CAST(n_users AS DOUBLE) / nullif(population, 0), 0)))
                      + count(*) FILTER (WHERE k % 7 <> 3 OR n_users = 0 OR stadtradeln_volume = 0 OR population = 0) AS n_passed FROM commune""",
        ),
        "commune",
    ),
)
def check_derived(spark, sf):
    from ..functions.numeric import ratio

    share = ratio(F.col("n_users"), F.col("population"))
    weight = ratio(F.col("n_users") * F.col("stadtradeln_volume"), F.col("population"))
    written = t.commune(spark, sf).select(
        "n_users",
        "population",
        F.col("stadtradeln_volume").alias("Erh_SR"),
        (share * F.when(F.col("k") % 5 == 2, 1.01).otherwise(1.0)).alias("TN_SR_relativ"),
        (weight * F.when(F.col("k") % 7 == 3, 1.01).otherwise(1.0)).alias("Streckengewicht_SR"),
    )
    return rounded(q.check_derived(written))


HUB = "o_totalprice * 0.3 - 3000"


@query(
    "check_distances",
    _check("hub_distances", f"SELECT count(*) AS n_checked, count(*) FILTER (WHERE {HUB} >= 0 AND {HUB} < 100000) AS n_passed FROM orders"),
)
def check_distances(spark, sf):
    return rounded(q.check_hub_distances(table(spark, sf, "orders").select((F.col("o_totalprice") * 0.3 - 3000).alias("HubDist"))))


@query(
    "hub_distance_stats",
    "SELECT round(min(o_totalprice), 6) AS min, round(max(o_totalprice), 6) AS max, round(avg(o_totalprice), 6) AS mean, round(median(o_totalprice), 6) AS median FROM orders",
)
def hub_distance_stats(spark, sf):
    return rounded(q.hub_distance_stats(table(spark, sf, "orders"), "o_totalprice"))


@query(
    "check_ranges",
    t.sql(
        _check(
            "value_ranges",
            """SELECT count("DZS_mean_SR") + count("Erh_SR") + count("TN_SR_relativ") AS n_checked,
                      count(*) FILTER (WHERE "DZS_mean_SR" * 15 BETWEEN 0 AND 50000) + count(*) FILTER (WHERE "Erh_SR" BETWEEN 0 AND 1e9)
                      + count(*) FILTER (WHERE "TN_SR_relativ" BETWEEN 0 AND 1) AS n_passed FROM training""",
        ),
        "training",
    ),
)
def check_ranges(spark, sf):
    df = t.training(spark, sf).select((F.col("DZS_mean_SR") * 15).alias("DZS_mean_SR"), "Erh_SR", "TN_SR_relativ")
    return rounded(q.check_ranges(df))


REF = "SELECT o_orderkey AS id, o_totalprice, o_orderstatus FROM orders"


def _reference(spark, sf):
    return table(spark, sf, "orders").select(F.col("o_orderkey").alias("id"), "o_totalprice", "o_orderstatus")


def _edited(spark, sf):
    r = _reference(spark, sf)
    return r.select(
        # every tenth row has a key that the reference lacks
        (F.col("id") + F.when(F.col("id") % 10 == 9, 10**12).otherwise(0)).alias("id"),
        F.when(F.col("id") % 6 == 0, None).when(F.col("id") % 6 == 1, F.col("o_totalprice") * 1.1).otherwise(F.col("o_totalprice")).alias("o_totalprice"),
        F.concat(F.col("o_orderstatus"), F.lit(" ")).alias("o_orderstatus"),
        F.lit(1).alias("only_here"),
    )


@query(
    "reference_compare",
    _check("reference_comparison", f"SELECT 2 * count(*) AS n_checked, count(*) + count(*) FILTER (WHERE id % 6 > 1) AS n_passed FROM ({REF}) WHERE id % 10 <> 9"),
)
def reference_compare(spark, sf):
    return rounded(q.compare_with_reference(_edited(spark, sf), _reference(spark, sf)))


@query(
    "column_agreement",
    f"""SELECT 'o_totalprice' AS "column", CAST(count(*) FILTER (WHERE id % 6 > 1) AS BIGINT) AS n_equal, CAST(count(*) AS BIGINT) AS n_rows FROM ({REF}) WHERE id % 10 <> 9
        UNION ALL SELECT 'o_orderstatus', count(*), count(*) FROM ({REF}) WHERE id % 10 <> 9""",
)
def column_agreement(spark, sf):
    return q.column_agreement(_edited(spark, sf), _reference(spark, sf), "id")


@query(
    "cell_mismatches",
    f"""SELECT CAST(id AS VARCHAR) AS key, 'o_totalprice' AS "column", CAST(o_totalprice AS VARCHAR) AS reference_value
        FROM ({REF}) WHERE id % 10 <> 9 AND id % 6 <= 1 ORDER BY key LIMIT 15""",
)
def cell_mismatches(spark, sf):
    return q.cell_mismatches(_edited(spark, sf), _reference(spark, sf), "id").drop("table_value")


@query(
    "status_rollup",
    """SELECT CASE WHEN bool_or(s = 'fail') THEN 'fail' WHEN bool_or(s = 'warn') THEN 'warn' ELSE 'pass' END AS overall_status, CAST(count(*) FILTER (WHERE s = 'pass') AS BIGINT) AS n_passed, CAST(count(*) FILTER (WHERE s = 'warn') AS BIGINT) AS n_warned,
              CAST(count(*) FILTER (WHERE s = 'fail') AS BIGINT) AS n_failed
       FROM (SELECT CASE WHEN r >= 0.95 THEN 'pass' WHEN r >= 0.8 THEN 'warn' ELSE 'fail' END AS s FROM
              (SELECT o_custkey, avg(CASE WHEN o_orderstatus <> 'P' OR o_orderkey % 4 > 0 THEN 1 ELSE 0 END) AS r FROM orders GROUP BY 1))""",
)
def status_rollup(spark, sf):
    ok = (F.col("o_orderstatus") != "P") | (F.col("o_orderkey") % 4 > 0)
    rates = table(spark, sf, "orders").groupBy("o_custkey").agg(F.avg(ok.cast("int")).alias("r"))
    return q.overall_status(rates.select(q.status_of(F.col("r")).alias("status")))


@query(
    "assess_table",
    t.sql(
        """SELECT check_name, CAST(n AS BIGINT) AS n_checked, status FROM (
             SELECT 'dtv_values' AS check_name, count(*) AS n, 'warn' AS status FROM counter
             UNION ALL SELECT 'counter_locations', count(*), 'fail' FROM counter
             UNION ALL SELECT 'infrastructure_values', 0, 'skip' UNION ALL SELECT 'regiostar_values', 0, 'skip'
             UNION ALL SELECT 'traffic_volume_values', 0, 'skip' UNION ALL SELECT 'derived_features', 0, 'skip' UNION ALL SELECT 'hub_distances', 0, 'skip'
             UNION ALL SELECT 'value_ranges', 3 * count(*), CASE WHEN count(*) FILTER (WHERE v BETWEEN 0 AND 50000) + 2 * count(*) >= 0.95 * 3 * count(*) THEN 'pass' ELSE 'warn' END
               FROM (SELECT CASE WHEN k % 10 = 3 THEN s_acctbal * 1.5 ELSE s_acctbal END AS v FROM counter))""",
        "counter",
    ),
)
def assess_table(spark, sf):
    c = t.counter(spark, sf)
    source = c.select("counter_id", F.col("s_acctbal").alias("dtv"))
    checks = q.assess(_written(spark, sf), dtv=source, locations=c.withColumnRenamed("counter_id", "name"))
    return checks.select("check_name", "n_checked", "status")
