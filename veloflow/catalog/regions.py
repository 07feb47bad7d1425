"""Attribute joins, hierarchy, roll-ups, contracts and dedupe of lookup tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..operators import admin_units as adm
from ..operators import joins
from ..operators.contracts import Contract, Rule, check_contract, validate_datasets, violation_sample
from ..operators.ranking import key_overlap
from . import stand_ins as t
from .registry import query, table

# --- infrastructure and checked assignments --------------------------------------------------

WAYS = "SELECT CAST(p_partkey // 3 AS VARCHAR) AS osm_id, p_type AS cls FROM part WHERE p_partkey % 5 <> 0"


def _ways(spark, sf):
    p = F.col("p_partkey")
    return table(spark, sf, "part").select(
        # every fifth way gets a number that no edge has
        (F.floor(p / 3) + F.when(p % 5 == 0, 10**12).otherwise(0)).cast("string").alias("osm_id"), F.col("p_type").alias("bicycle_infrastructure")
    )


def _float_edges(spark, sf):
    """Edges whose way id came as a float, some missing."""
    e = t.edge(spark, sf).select("edge_id", "base_id")
    return e.withColumn("base_id", F.when(F.col("edge_id") % 10 != 3, F.col("base_id").cast("double")))


FLOAT_EDGES = "SELECT edge_id, CASE WHEN edge_id % 10 <> 3 THEN CAST(base_id AS DOUBLE) END AS base_id FROM edge"


@query(
    "join_infra",
    t.sql(
        f"""SELECT e.edge_id, w.cls AS bicycle_infrastructure FROM ({FLOAT_EDGES}) e
            LEFT JOIN ({WAYS}) w ON CAST(CAST(e.base_id AS BIGINT) AS VARCHAR) = w.osm_id""",
        "edge",
    ),
)
def join_infra(spark, sf):
    return joins.join_infrastructure(_float_edges(spark, sf), _ways(spark, sf)).select("edge_id", "bicycle_infrastructure")


@query(
    "join_infra_dedup",
    t.sql(
        f"""SELECT e.edge_id, w.cls AS bicycle_infrastructure FROM ({FLOAT_EDGES}) e
            LEFT JOIN (SELECT osm_id, min(cls) AS cls FROM ({WAYS}) GROUP BY 1) w ON CAST(CAST(e.base_id AS BIGINT) AS VARCHAR) = w.osm_id""",
        "edge",
    ),
)
def join_infra_dedup(spark, sf):
    return joins.join_infrastructure(_float_edges(spark, sf), _ways(spark, sf), True).select("edge_id", "bicycle_infrastructure")


CHECKED = """SELECT s_suppkey AS k, CAST(s_suppkey * 3 AS BIGINT) AS base_id, CASE WHEN s_suppkey % 4 = 0 THEN NULL ELSE CAST(s_suppkey * 10 AS BIGINT) END AS count,
                    'class' || CAST(s_suppkey % 3 AS VARCHAR) AS cls,
                    CASE s_suppkey % 3 WHEN 0 THEN 'verified' WHEN 1 THEN 'carryover' ELSE 'unverified' END AS status, s_suppkey % 7 = 0 AS gone
             FROM supplier WHERE s_suppkey % 5 <> 0"""


def _checked(spark, sf):
    s = F.col("s_suppkey")
    return (
        table(spark, sf, "supplier")
        .select(
            # every fifth assignment is for a counter that does not exist
            joins.pad_left(s + F.when(s % 5 == 0, 10**9).otherwise(0), 3).alias("counter_id"),
            (s * 3).alias("base_id"),
            F.when(s % 4 != 0, s * 10).alias("count"),
            F.concat(F.lit("class"), (s % 3).cast("string")).alias("bicycle_infrastructure"),
            t.pick(s % 3, ("verified", "carryover", "unverified")).alias("verification_status"),
            (s % 7 == 0).alias("is_discarded"),
        )
    )


@query(
    "verified_override",
    t.sql(
        f"""SELECT c.counter_id, v.base_id, v.count, v.cls AS bicycle_infrastructure FROM counter c JOIN ({CHECKED}) v ON c.k = v.k""",
        "counter",
    ),
)
def verified_override(spark, sf):
    joined = joins.join_verified(t.counter(spark, sf), _checked(spark, sf))
    return joined.select("counter_id", "base_id", "count", "bicycle_infrastructure")


@query(
    "verified_without_discarded",
    t.sql(f"SELECT c.counter_id, v.base_id FROM counter c JOIN ({CHECKED}) v ON c.k = v.k WHERE NOT v.gone", "counter"),
)
def verified_without_discarded(spark, sf):
    return joins.join_verified(t.counter(spark, sf), _checked(spark, sf), drop_discarded=True).select("counter_id", "base_id")


@query(
    "merge_verifications",
    t.sql(
        f"""SELECT c.counter_id,
                   CASE WHEN v.status IN ('verified', 'carryover') THEN v.base_id ELSE CAST(1000 + c.k AS BIGINT) END AS base_id,
                   CASE WHEN v.status IN ('verified', 'carryover') AND v.count IS NOT NULL THEN v.count ELSE CAST(c.k AS BIGINT) END AS count,
                   coalesce(v.status, 'unverified') AS verification_status, coalesce(v.gone, FALSE) AS is_discarded
            FROM counter c LEFT JOIN ({CHECKED}) v ON c.k = v.k""",
        "counter",
    ),
)
def merge_verifications(spark, sf):
    found = t.counter(spark, sf).select("counter_id", (F.col("k") + 1000).alias("base_id"), F.col("k").alias("count"))
    merged = joins.merge_verifications(found, _checked(spark, sf))
    return merged.select("counter_id", "base_id", "count", "verification_status", "is_discarded")


@query(
    "carryover",
    t.sql(
        f"""SELECT c.counter_id, v.base_id, n.count, 'carryover' AS verification_status, v.gone AS is_discarded
            FROM counter c JOIN ({CHECKED}) v ON c.k = v.k
            LEFT JOIN (SELECT base_id, min(count) AS count FROM edge GROUP BY 1) n ON v.base_id = n.base_id""",
        "counter",
        "edge",
    ),
)
def carryover(spark, sf):
    previous = _checked(spark, sf).join(t.counter(spark, sf).select("counter_id", "latitude", "longitude"), "counter_id")
    previous = previous.withColumns({"name": F.col("counter_id"), "ars": F.lit("010000000000"), "osm_source": F.lit("osm")})
    out = joins.carry_over(previous, t.edge(spark, sf), 2023, "2024-05-01 00:00:00")
    return out.select("counter_id", "base_id", "count", "verification_status", "is_discarded")


@query(
    "join_edge_by_id",
    t.sql("SELECT c.counter_id, e.base_id, e.count FROM counter c LEFT JOIN edge e ON e.edge_id = c.k * 30", "counter", "edge"),
)
def join_edge_by_id(spark, sf):
    counters = t.counter(spark, sf).withColumn("edge_id", F.col("k") * 30)
    return joins.join_edges(counters, t.edge(spark, sf), columns=["base_id", "count"]).select("counter_id", "base_id", "count")


CHANGES = """SELECT s_suppkey AS k, CAST(s_suppkey + 7 AS BIGINT) AS base_id, CASE WHEN s_suppkey % 4 = 2 THEN NULL ELSE CAST(5 AS BIGINT) END AS count
             FROM supplier WHERE s_suppkey % 2 = 0"""


@query(
    "apply_changes",
    t.sql(
        f"""SELECT c.counter_id, CASE WHEN v.k IS NULL THEN CAST(c.k AS BIGINT) ELSE v.base_id END AS base_id, coalesce(v.count, CAST(c.k * 2 AS BIGINT)) AS count,
                   CASE WHEN v.k IS NULL THEN 'unverified' ELSE 'verified' END AS verification_status
            FROM counter c LEFT JOIN ({CHANGES}) v ON c.k = v.k""",
        "counter",
    ),
)
def apply_changes(spark, sf):
    counters = t.counter(spark, sf).select(
        "counter_id", F.col("k").alias("base_id"), (F.col("k") * 2).alias("count"), F.lit("unverified").alias("verification_status")
    )
    s = F.col("s_suppkey")
    changes = table(spark, sf, "supplier").select(
        joins.pad_left(s + F.when(s % 2 == 1, 10**9).otherwise(0), 3).alias("counter_id"), (s + 7).alias("base_id"), F.when(s % 4 != 2, F.lit(5)).cast("bigint").alias("count")
    )
    out = joins.apply_changes(counters, changes, "2024-05-01 00:00:00")
    return out.select("counter_id", "base_id", "count", "verification_status")


# --- regional joins --------------------------------------------------------------------------

def _moved(communes, away):
    """Communes of which some move to a land that does not exist, so that their keys match nothing."""
    return communes.withColumn("ars", F.when(away, F.concat(F.lit("99"), F.substring("ars", 3, 10))).otherwise(F.col("ars")))


TYPES = """SELECT ars, min(CAST(51 + k % 5 AS BIGINT)) AS regiostar5 FROM commune WHERE k % 3 <> 0 GROUP BY 1"""


@query(
    "regiostar_join",
    t.sql(f"SELECT c.k, r.regiostar5 FROM commune c LEFT JOIN ({TYPES}) r ON c.ars = r.ars", "commune"),
)
def regiostar_join(spark, sf):
    c = t.commune(spark, sf)
    types = _moved(c, F.col("k") % 3 == 0).select("ars", (F.lit(51) + F.col("k") % 5).alias("regiostar5"))
    return joins.join_regiostar(c.select("k", "ars"), types).select("k", "regiostar5")


VG_STATS = "SELECT substr(ars, 1, 9) AS p, min(struct_pack(a := n_users, b := n_trips, c := total_km)) AS s FROM commune WHERE k % 2 = 0 GROUP BY 1"


@query(
    "demographics_join",
    t.sql(
        f"""SELECT c.k, r.s.a AS n_users, r.s.b AS n_trips, r.s.c AS total_km
            FROM commune c LEFT JOIN ({VG_STATS}) r ON substr(c.ars, 1, 9) = r.p""",
        "commune",
    ),
)
def demographics_join(spark, sf):
    c = t.commune(spark, sf)
    return joins.join_demographics(c.select("k", "ars"), _moved(c, F.col("k") % 2 == 1)).select("k", "n_users", "n_trips", "total_km")


@query(
    "stats_join",
    t.sql(
        """SELECT c.k, s.n_users, s.n_trips, s.total_km, s.population FROM commune c
           LEFT JOIN (SELECT rpad(substr(ars, 1, 5), 12, '0') AS ars, CAST(sum(n_users) AS BIGINT) AS n_users, CAST(sum(n_trips) AS BIGINT) AS n_trips,
                             sum(total_km) AS total_km, CAST(sum(population) AS BIGINT) AS population FROM commune WHERE k % 2 = 0 GROUP BY 1) s
             ON rpad(substr(c.ars, 1, 5), 12, '0') = s.ars""",
        "commune",
    ),
)
def stats_join(spark, sf):
    c = t.commune(spark, sf)
    some = _moved(c, F.col("k") % 2 == 1)
    keyed = c.select("k", F.rpad(F.substring("ars", 1, 5), 12, "0").alias("admin_ars"))
    out = joins.join_statistics(keyed, adm.rollup_statistics(some, "Kreis"))
    out = joins.join_population(out, adm.rollup_population(some, "Kreis"))
    return out.select("k", "n_users", "n_trips", "total_km", "population")


@query(
    "independent_units",
    t.sql(
        """SELECT ars, admin_level FROM unit WHERE admin_level = 'Verwaltungsgemeinschaft'
           UNION ALL SELECT ars, admin_level FROM unit u WHERE admin_level = 'Kreis' AND NOT EXISTS
             (SELECT 1 FROM unit v WHERE v.admin_level = 'Verwaltungsgemeinschaft' AND substr(v.ars, 1, 5) = substr(u.ars, 1, 5))
           UNION ALL SELECT ars, admin_level FROM unit u WHERE admin_level = 'Land' AND NOT EXISTS
             (SELECT 1 FROM unit v WHERE v.admin_level = 'Kreis' AND substr(v.ars, 1, 2) = substr(u.ars, 1, 2))""",
        "unit",
    ),
)
def independent_units(spark, sf):
    return adm.units_at_level(t.unit(spark, sf), "Verwaltungsgemeinschaft").select("ars", "admin_level")


@query("units_of_land", t.sql("SELECT ars, admin_level FROM unit WHERE admin_level = 'Kreis' AND starts_with(ars, '02')", "unit"))
def units_of_land(spark, sf):
    return adm.units_at_level(t.unit(spark, sf), "Kreis", "02").select("ars", "admin_level")


@query(
    "admin_rollup",
    t.sql(
        """SELECT rpad(substr(ars, 1, 2), 12, '0') AS ars, CAST(sum(n_users) AS BIGINT) AS n_users, CAST(sum(n_trips) AS BIGINT) AS n_trips,
                  sum(total_km) AS total_km FROM commune GROUP BY 1""",
        "commune",
    ),
)
def admin_rollup(spark, sf):
    return adm.rollup_statistics(t.commune(spark, sf), "Land")


@query(
    "admin_rollup_cities",
    t.sql(
        """SELECT CASE WHEN substr(c.ars, 1, 5) IN (SELECT substr(ars, 1, 5) FROM unit u WHERE admin_level = 'Kreis' AND NOT EXISTS
                     (SELECT 1 FROM unit v WHERE v.admin_level = 'Verwaltungsgemeinschaft' AND substr(v.ars, 1, 5) = substr(u.ars, 1, 5)))
                   THEN rpad(substr(c.ars, 1, 5), 12, '0') ELSE rpad(substr(c.ars, 1, 9), 12, '0') END AS ars,
                  CAST(sum(n_users) AS BIGINT) AS n_users, CAST(sum(n_trips) AS BIGINT) AS n_trips, sum(total_km) AS total_km
           FROM commune c GROUP BY 1""",
        "commune",
        "unit",
    ),
)
def admin_rollup_cities(spark, sf):
    return adm.rollup_statistics(t.commune(spark, sf), "Verwaltungsgemeinschaft", t.unit(spark, sf))


@query(
    "population_rollup",
    t.sql("SELECT rpad(substr(ars, 1, 9), 12, '0') AS ars, CAST(sum(population) AS BIGINT) AS population FROM commune GROUP BY 1", "commune"),
)
def population_rollup(spark, sf):
    return adm.rollup_population(t.commune(spark, sf), "Verwaltungsgemeinschaft")


@query(
    "missing_codes",
    t.sql("SELECT DISTINCT substr(ars, 1, 12) AS code FROM commune WHERE substr(ars, 1, 12) NOT IN (SELECT ars FROM commune WHERE k % 3 = 1)", "commune"),
)
def missing_codes(spark, sf):
    c = t.commune(spark, sf)
    return adm.missing_codes(c, _moved(c, F.col("k") % 3 != 1))


@query("total_population", t.sql("SELECT k, CAST((SELECT sum(population) FROM commune) AS BIGINT) AS population FROM commune", "commune"))
def total_population(spark, sf):
    return adm.total_population(t.commune(spark, sf)).select("k", "population")


@query(
    "key_overlap",
    """SELECT coalesce(l.k, r.k) AS key, CASE WHEN r.k IS NULL THEN 'left_only' WHEN l.k IS NULL THEN 'right_only' ELSE 'both' END AS side
       FROM (SELECT DISTINCT c_custkey AS k FROM customer) l FULL JOIN (SELECT DISTINCT o_custkey * 2 AS k FROM orders) r ON l.k = r.k""",
)
def key_overlap_query(spark, sf):
    left = table(spark, sf, "customer").select(F.col("c_custkey").alias("id"))
    right = table(spark, sf, "orders").select((F.col("o_custkey") * 2).alias("id"))
    return key_overlap(left, right, "id")


# --- contracts -------------------------------------------------------------------------------

ORDER_RULES = Contract(
    "order",
    (
        Rule("o_orderkey", "bigint", unique=True),
        Rule("o_custkey", "bigint", unique=True),
        Rule("o_orderstatus", "string", allowed=("O", "F")),
        Rule("o_totalprice", "double", at_least=5000, at_most=400000),
        Rule("o_orderpriority", "string", length=(5, 8)),
        Rule("absent", "string"),
        Rule("absent_too", "string", optional=True),
    ),
)


@query(
    "validate_contract",
    """SELECT * FROM (
         SELECT 'o_custkey' AS "column", 'unique' AS rule, CAST((SELECT sum(n) FROM (SELECT count(*) AS n FROM orders GROUP BY o_custkey) WHERE n > 1) AS BIGINT) AS n_failed
         UNION ALL SELECT 'o_orderstatus', 'allowed', (SELECT count(*) FROM orders WHERE o_orderstatus NOT IN ('O', 'F'))
         UNION ALL SELECT 'o_totalprice', 'at_least_5000', (SELECT count(*) FROM orders WHERE o_totalprice < 5000)
         UNION ALL SELECT 'o_totalprice', 'at_most_400000', (SELECT count(*) FROM orders WHERE o_totalprice > 400000)
         UNION ALL SELECT 'o_orderpriority', 'length', (SELECT count(*) FROM orders WHERE length(o_orderpriority) NOT BETWEEN 5 AND 8)
         UNION ALL SELECT 'absent', 'required', 1) WHERE n_failed > 0""",
)
def validate_contract(spark, sf):
    return check_contract(table(spark, sf, "orders"), ORDER_RULES)


@query(
    "validate_datasets",
    """SELECT 'city_centroids' AS dataset, TRUE AS exists, FALSE AS schema_valid, CAST(count(*) AS BIGINT) AS row_count, 'place:required' AS error FROM supplier
       UNION ALL SELECT 'counter_locations', FALSE, NULL, NULL, 'file not found'
       UNION ALL SELECT 'traffic_volumes', TRUE, TRUE, count(*), NULL FROM part
       UNION ALL SELECT 'orders', TRUE, NULL, count(*), NULL FROM orders""",
)
def validate_datasets_query(spark, sf):
    return validate_datasets(
        spark,
        {
            "city_centroids": table(spark, sf, "supplier").withColumnRenamed("s_name", "name"),
            "counter_locations": None,
            "traffic_volumes": t.edge(spark, sf),
            "orders": table(spark, sf, "orders"),
        },
    )


@query(
    "violation_sample",
    """SELECT 'o_totalprice' AS "column", 'at_least_5000' AS rule, v AS value FROM
         (SELECT CAST(o_totalprice AS VARCHAR) AS v FROM orders WHERE o_totalprice < 5000 ORDER BY v LIMIT 5)""",
)
def violation_sample_query(spark, sf):
    rules = Contract("price", (Rule("o_totalprice", "double", at_least=5000),))
    return violation_sample(table(spark, sf, "orders"), rules, 5)


