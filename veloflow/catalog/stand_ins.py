"""Traffic tables derived from the driver tables, once as Spark plans and once as SQL text.

Both sides use the same integer arithmetic, so coordinates and keys agree to the last bit.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.region_keys import pad_left
from .registry import table

# --- SQL -------------------------------------------------------------------------------------

CTE: dict[str, str] = {
    # one counter per supplier
    "counter": """
        SELECT s_suppkey AS k,
               CASE WHEN length(CAST(s_suppkey AS VARCHAR)) < 3 THEN lpad(CAST(s_suppkey AS VARCHAR), 3, '0')
                    ELSE CAST(s_suppkey AS VARCHAR) END AS counter_id,
               (8000 + (s_suppkey * 7919) % 1000) / 1000 AS longitude,
               (50000 + (s_suppkey * 104729) % 1000) / 1000 AS latitude,
               s_acctbal
        FROM supplier""",
    # one two-point edge per part
    "edge": """
        SELECT p_partkey AS edge_id, CAST(p_partkey // 2 AS BIGINT) AS base_id, CAST(p_size * 10 AS BIGINT) AS count,
               (80000 + (p_partkey * 6151) % 10000) / 10000 AS lon1,
               (500000 + (p_partkey * 3571) % 10000) / 10000 AS lat1,
               (80000 + (p_partkey * 6151) % 10000 + (p_partkey % 7 - 3) * 20) / 10000 AS lon2,
               (500000 + (p_partkey * 3571) % 10000 + (p_partkey % 5 - 2) * 20) / 10000 AS lat2
        FROM part""",
    # rectangles that each customer's area adds (1) or leaves out (-1)
    "area_rect": """
        SELECT c_custkey AS k, sgn, (X + dx0) / 10000 AS x0, (X + dx9) / 10000 AS x9, (Y + dy0) / 10000 AS y0, (Y + dy9) / 10000 AS y9
        FROM (SELECT c_custkey, 80000 + (c_custkey * 6151) % 10000 AS X, 500000 + (c_custkey * 3571) % 10000 AS Y FROM customer),
             (VALUES (1, 0, 200, 0, 200, 1), (-1, 20, 80, 20, 80, 3), (1, 300, 400, 0, 100, 2)) r (sgn, dx0, dx9, dy0, dy9, every)
        WHERE c_custkey % every = 0""",
    # raw infrastructure class per edge, one class in nine missing
    "edge_class": """
        SELECT p_partkey AS edge_id, CAST(p_partkey // 2 AS BIGINT) AS base_id,
               CASE p_partkey % 9 WHEN 0 THEN 'bicycle_lane_left' WHEN 1 THEN 'bus_lane_both' WHEN 2 THEN 'bicycle_way_both'
                    WHEN 3 THEN 'mit_road' WHEN 4 THEN 'mixed_way_left' WHEN 5 THEN 'path_not_forbidden'
                    WHEN 6 THEN 'bicycle_road_both' WHEN 7 THEN 'bicycle_way' ELSE NULL END AS raw
        FROM part""",
    # daily counts per user
    "daily": """
        SELECT CAST(user_id AS VARCHAR) AS counter_id, date_trunc('day', ts) AS day,
               CAST(count(*) FILTER (WHERE event_type = 'view') * 10 AS BIGINT) AS n
        FROM events GROUP BY 1, 2""",
    # administrative units with their level
    "unit": """
        SELECT DISTINCT ars, admin_level FROM (
          SELECT lpad(CAST(r_regionkey + 1 AS VARCHAR), 2, '0') || '0000000000' AS ars, 'Land' AS admin_level FROM region
          UNION ALL
          SELECT lpad(CAST(n_regionkey + 1 AS VARCHAR), 2, '0') || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') || '0000000', 'Kreis'
          FROM nation WHERE n_regionkey <> 4
          UNION ALL
          SELECT lpad(CAST(n_regionkey + 1 AS VARCHAR), 2, '0') || lpad(CAST(n_nationkey AS VARCHAR), 3, '0')
                 || lpad(CAST(c_custkey % 40 AS VARCHAR), 4, '0') || '000', 'Verwaltungsgemeinschaft'
          FROM customer JOIN nation ON c_nationkey = n_nationkey WHERE n_regionkey <> 4 AND n_nationkey % 4 <> 0)""",
    # one commune record per customer
    "commune": """
        SELECT lpad(CAST(n_regionkey + 1 AS VARCHAR), 2, '0') || lpad(CAST(n_nationkey AS VARCHAR), 3, '0')
                 || lpad(CAST(c_custkey % 40 AS VARCHAR), 4, '0') || lpad(CAST(c_custkey % 1000 AS VARCHAR), 3, '0') AS ars,
               c_custkey AS k, CAST(c_custkey % 100 AS BIGINT) AS n_users, CAST((c_custkey * 7) % 1000 AS BIGINT) AS n_trips,
               CAST((c_custkey * 13) % 5000 AS DOUBLE) AS total_km,
               CAST(CASE WHEN c_custkey % 25 = 0 THEN 0 ELSE 100 + (c_custkey * 31) % 9000 END AS BIGINT) AS population,
               CAST((c_custkey * 17) % 3000 AS BIGINT) AS stadtradeln_volume
        FROM customer JOIN nation ON c_nationkey = n_nationkey""",
    # one candidate assignment per part: traffic, volume, check state, two candidate distances
    "matched": """
        SELECT p.p_partkey AS k, CAST(p.p_partkey AS VARCHAR) AS counter_id, l.dtv,
               CAST(CASE WHEN p.p_partkey % 17 = 0 THEN NULL WHEN p.p_partkey % 19 = 0 THEN 0 ELSE p.p_size * 20 END AS BIGINT) AS count,
               CASE WHEN p.p_partkey % 11 = 0 THEN 'verified' WHEN p.p_partkey % 13 = 0 THEN 'carryover' ELSE 'unverified' END
                 AS verification_status,
               CAST(p.p_partkey % 50 AS DOUBLE) AS d1,
               CASE WHEN p.p_partkey % 3 = 0 THEN NULL ELSE (p.p_partkey % 50) * (CASE WHEN p.p_partkey % 2 = 0 THEN 1.5::DOUBLE ELSE 2.5::DOUBLE END) END AS d2
        FROM part p JOIN (SELECT l_partkey, CAST(sum(l_quantity) AS DOUBLE) AS dtv FROM lineitem GROUP BY 1) l
          ON p.p_partkey = l.l_partkey""",
    # actual and predicted value per order
    "scored": """
        SELECT o_orderkey AS id, o_custkey, o_orderstatus, o_orderpriority, o_orderdate, o_totalprice AS y_true, l.y_pred
        FROM orders JOIN (SELECT l_orderkey, round(sum(l_extendedprice), 2) AS y_pred FROM lineitem GROUP BY 1) l
          ON o_orderkey = l.l_orderkey""",
    # the same per customer; one priority class is missing
    "station": """
        SELECT o_custkey AS id, CASE WHEN o_custkey % 7 = 6 THEN NULL ELSE CAST(o_custkey % 7 AS VARCHAR) END AS stratum,
               round(sum(y_true), 2) / 100 AS y_true,
               CASE WHEN o_custkey % 23 = 0 THEN CAST(0 AS DOUBLE) ELSE round(sum(y_pred), 2) / 100 END AS y_pred
        FROM (SELECT o_orderkey AS id, o_custkey, o_totalprice AS y_true, l.y_pred
              FROM orders JOIN (SELECT l_orderkey, round(sum(l_extendedprice), 2) AS y_pred FROM lineitem GROUP BY 1) l
                ON o_orderkey = l.l_orderkey) GROUP BY o_custkey""",
    # training table per order under delivery names
    "training": """
        SELECT CAST(o_orderkey AS VARCHAR) AS id,
               CAST(CASE WHEN o_orderkey % 50 = 0 THEN -1 ELSE (o_orderkey * 7) % 9973 END AS BIGINT) AS base_id,
               CASE WHEN o_orderkey % 40 = 0 THEN NULL ELSE o_totalprice / 100 END AS "DZS_mean_SR",
               CASE WHEN o_orderkey % 31 = 0 THEN CAST(0 AS DOUBLE) ELSE l.q END AS "Erh_SR",
               CAST((o_orderkey * 37) % 50000 AS DOUBLE) AS "HubDist",
               CAST(o_orderkey % 97 AS DOUBLE) / 1000 AS "TN_SR_relativ",
               CAST(o_orderkey % 97 AS DOUBLE) * l.q / 1000 AS "Streckengewicht_SR",
               CAST(71 + o_orderkey % 7 AS INTEGER) AS "RegioStaR7",
               CASE o_orderkey % 6 WHEN 0 THEN 'no' WHEN 1 THEN 'mixed_way' WHEN 2 THEN 'mit_road' WHEN 3 THEN 'bicycle_lane'
                    WHEN 4 THEN 'bicycle_road' ELSE 'bicycle_way' END AS "OSM_Radinfra",
               CAST(extract(year FROM o_orderdate) AS INTEGER) AS year
        FROM orders JOIN (SELECT l_orderkey, CAST(sum(l_quantity) AS DOUBLE) AS q FROM lineitem GROUP BY 1) l
          ON o_orderkey = l.l_orderkey""",
    # 25 tiles over the counter area, one per nation; every third has a square hole
    "tile": """
        SELECT n_nationkey AS k, lpad(CAST(n_regionkey + 1 AS VARCHAR), 2, '0') || lpad(CAST(n_nationkey AS VARCHAR), 3, '0') || '0000000' AS ars,
               (8000 + 200 * (n_nationkey % 5)) / 1000 AS x0, (8200 + 200 * (n_nationkey % 5)) / 1000 AS x9,
               (50000 + 200 * (n_nationkey // 5)) / 1000 AS y0, (50200 + 200 * (n_nationkey // 5)) / 1000 AS y9,
               n_nationkey % 3 = 0 AS has_hole,
               (8050 + 200 * (n_nationkey % 5)) / 1000 AS hx0, (8150 + 200 * (n_nationkey % 5)) / 1000 AS hx9,
               (50050 + 200 * (n_nationkey // 5)) / 1000 AS hy0, (50150 + 200 * (n_nationkey // 5)) / 1000 AS hy9
        FROM nation""",
    # one place per customer
    "place": """
        SELECT c_custkey AS k, (70000 + (c_custkey * 7877) % 30000) / 10000 AS longitude,
               (495000 + (c_custkey * 5821) % 20000) / 10000 AS latitude
        FROM customer""",
}


def with_tables(*ctes: str) -> str:
    return "WITH " + ", ".join(f"{n} AS ({CTE[n].strip()})" for n in ctes)


def sql(body: str, *ctes: str) -> str:
    """Statement with the named stand-in tables in front."""
    return f"{with_tables(*ctes)} {body.strip()}" if ctes else body.strip()


# --- Spark -----------------------------------------------------------------------------------



def counter(spark: SparkSession, sf: str) -> DataFrame:
    s = F.col("s_suppkey")
    return table(spark, sf, "supplier").select(
        s.alias("k"),
        pad_left(s, 3).alias("counter_id"),
        ((F.lit(8000) + (s * 7919) % 1000) / 1000).alias("longitude"),
        ((F.lit(50000) + (s * 104729) % 1000) / 1000).alias("latitude"),
        "s_acctbal",
    )


def edge(spark: SparkSession, sf: str) -> DataFrame:
    p = F.col("p_partkey")
    lon, lat = F.lit(80000) + (p * 6151) % 10000, F.lit(500000) + (p * 3571) % 10000

    def vertex(x: Column, y: Column) -> Column:
        return F.struct((x / 10000).alias("x"), (y / 10000).alias("y"))

    line = F.array(vertex(lon, lat), vertex(lon + (p % 7 - 3) * 20, lat + (p % 5 - 2) * 20))
    return table(spark, sf, "part").select(
        p.alias("edge_id"), F.floor(p / 2).alias("base_id"), (F.col("p_size") * 10).cast("bigint").alias("count"), line.alias("line")
    )


RAW_CLASSES = (
    "bicycle_lane_left",
    "bus_lane_both",
    "bicycle_way_both",
    "mit_road",
    "mixed_way_left",
    "path_not_forbidden",
    "bicycle_road_both",
    "bicycle_way",
)


def pick(c: Column, values: tuple[str, ...]) -> Column:
    return F.get(F.array(*[F.lit(v) for v in values]), c.cast("int"))


def edge_class(spark: SparkSession, sf: str) -> DataFrame:
    p = F.col("p_partkey")
    return table(spark, sf, "part").select(p.alias("edge_id"), F.floor(p / 2).alias("base_id"), pick(p % 9, RAW_CLASSES).alias("raw"))


def daily(spark: SparkSession, sf: str) -> DataFrame:
    return (
        table(spark, sf, "events")
        .groupBy(F.col("user_id").cast("string").alias("counter_id"), F.date_trunc("day", "ts").cast("timestamp_ntz").alias("timestamp"))
        .agg((F.count_if(F.col("event_type") == "view") * 10).alias("count"))
    )


def _key(*parts: tuple[Column, int]) -> Column:
    return F.concat(*[F.lpad(c.cast("string"), n, "0") for c, n in parts])


def _customers(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "customer").join(table(spark, sf, "nation"), F.col("c_nationkey") == F.col("n_nationkey"))


def unit(spark: SparkSession, sf: str) -> DataFrame:
    land, kreis = (F.col("n_regionkey") + 1, 2), (F.col("n_nationkey"), 3)
    regions = table(spark, sf, "region").select(
        F.rpad(_key((F.col("r_regionkey") + 1, 2)), 12, "0").alias("ars"), F.lit("Land").alias("admin_level")
    )
    nations = table(spark, sf, "nation").where("n_regionkey <> 4")
    counties = nations.select(F.rpad(_key(land, kreis), 12, "0").alias("ars"), F.lit("Kreis").alias("admin_level"))
    communities = (
        _customers(spark, sf)
        .where("n_regionkey <> 4 and n_nationkey % 4 <> 0")
        .select(
            F.rpad(_key(land, kreis, (F.col("c_custkey") % 40, 4)), 12, "0").alias("ars"),
            F.lit("Verwaltungsgemeinschaft").alias("admin_level"),
        )
    )
    return regions.unionByName(counties).unionByName(communities).distinct()


def commune(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col("c_custkey")
    ars = _key((F.col("n_regionkey") + 1, 2), (F.col("n_nationkey"), 3), (c % 40, 4), (c % 1000, 3))
    return _customers(spark, sf).select(
        ars.alias("ars"),
        c.alias("k"),
        (c % 100).alias("n_users"),
        ((c * 7) % 1000).alias("n_trips"),
        ((c * 13) % 5000).cast("double").alias("total_km"),
        F.when(c % 25 == 0, F.lit(0)).otherwise(F.lit(100) + (c * 31) % 9000).cast("bigint").alias("population"),
        ((c * 17) % 3000).alias("stadtradeln_volume"),
    )


def matched(spark: SparkSession, sf: str) -> DataFrame:
    p = F.col("p_partkey")
    sums = table(spark, sf, "lineitem").groupBy("l_partkey").agg(F.sum("l_quantity").alias("dtv"))
    d1 = (p % 50).cast("double")
    d2 = d1 * F.when(p % 2 == 0, 1.5).otherwise(2.5)

    def candidate(d: Column) -> Column:
        return F.struct(d.alias("distance"))

    return (
        table(spark, sf, "part")
        .join(sums, p == F.col("l_partkey"))
        .select(
            p.alias("k"),
            p.cast("string").alias("counter_id"),
            "dtv",
            F.when(p % 17 == 0, None).when(p % 19 == 0, 0).otherwise(F.col("p_size") * 20).cast("bigint").alias("count"),
            F.when(p % 11 == 0, "verified").when(p % 13 == 0, "carryover").otherwise("unverified").alias("verification_status"),
            # stored farthest first, the detector has to sort
            F.when(p % 3 == 0, F.array(candidate(d1))).otherwise(F.array(candidate(d2), candidate(d1))).alias("candidate_edges"),
        )
    )


def _order_sums(spark: SparkSession, sf: str) -> DataFrame:
    return table(spark, sf, "lineitem").groupBy("l_orderkey").agg(
        F.round(F.sum("l_extendedprice"), 2).alias("y_pred"), F.sum("l_quantity").alias("q")
    )


def scored(spark: SparkSession, sf: str) -> DataFrame:
    joined = table(spark, sf, "orders").join(_order_sums(spark, sf), F.col("o_orderkey") == F.col("l_orderkey"))
    return joined.select(
        F.col("o_orderkey").alias("id"),
        "o_custkey",
        "o_orderstatus",
        "o_orderpriority",
        "o_orderdate",
        F.col("o_totalprice").alias("y_true"),
        "y_pred",
    )


def station(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col("o_custkey")
    return (
        scored(spark, sf)
        .groupBy("o_custkey")
        .agg((F.round(F.sum("y_true"), 2) / 100).alias("y_true"), (F.round(F.sum("y_pred"), 2) / 100).alias("p"))
        .select(
            c.alias("id"),
            F.when(c % 7 != 6, (c % 7).cast("string")).alias("stratum"),
            "y_true",
            F.when(c % 23 == 0, 0.0).otherwise(F.col("p")).alias("y_pred"),
        )
    )


CATEGORY_NAMES = ("no", "mixed_way", "mit_road", "bicycle_lane", "bicycle_road", "bicycle_way")


def training(spark: SparkSession, sf: str) -> DataFrame:
    o = F.col("o_orderkey")
    joined = table(spark, sf, "orders").join(_order_sums(spark, sf), o == F.col("l_orderkey"))
    return joined.select(
        o.cast("string").alias("id"),
        F.when(o % 50 == 0, F.lit(-1)).otherwise((o * 7) % 9973).cast("bigint").alias("base_id"),
        F.when(o % 40 != 0, F.col("o_totalprice") / 100).alias("DZS_mean_SR"),
        F.when(o % 31 == 0, 0.0).otherwise(F.col("q")).alias("Erh_SR"),
        ((o * 37) % 50000).cast("double").alias("HubDist"),
        ((o % 97).cast("double") / 1000).alias("TN_SR_relativ"),
        ((o % 97).cast("double") * F.col("q") / 1000).alias("Streckengewicht_SR"),
        (F.lit(71) + o % 7).cast("int").alias("RegioStaR7"),
        pick(o % 6, CATEGORY_NAMES).alias("OSM_Radinfra"),
        F.year("o_orderdate").alias("year"),
    )


def tile(spark: SparkSession, sf: str) -> DataFrame:
    n = F.col("n_nationkey")
    col, row = (n % 5) * 200, F.floor(n / 5) * 200

    def square(x0: int, x9: int) -> Column:
        def p(x: int, y: int) -> Column:
            return F.struct(((F.lit(8000 + x) + col) / 1000).alias("x"), ((F.lit(50000 + y) + row) / 1000).alias("y"))

        return F.array(p(x0, x0), p(x9, x0), p(x9, x9), p(x0, x9), p(x0, x0))

    rings = F.when(n % 3 == 0, F.array(square(0, 200), square(50, 150))).otherwise(F.array(square(0, 200)))
    key = F.rpad(_key((F.col("n_regionkey") + 1, 2), (n, 3)), 12, "0")
    return table(spark, sf, "nation").select(key.alias("ars"), F.col("n_name").alias("name"), rings.alias("rings"))


def area(spark: SparkSession, sf: str) -> DataFrame:
    """A square per customer, each third with a hole off its middle, each second with a smaller square beside it."""
    c = F.col("c_custkey")
    x, y = F.lit(80000) + (c * 6151) % 10000, F.lit(500000) + (c * 3571) % 10000

    def square(dx: int, dy: int, side: int) -> Column:
        corners = ((0, 0), (side, 0), (side, side), (0, side), (0, 0))
        return F.array(*[F.struct(((x + dx + a) / 10000).alias("x"), ((y + dy + b) / 10000).alias("y")) for a, b in corners])

    first = F.when(c % 3 == 0, F.array(square(0, 0, 200), square(20, 20, 60))).otherwise(F.array(square(0, 0, 200)))
    parts = F.when(c % 2 == 0, F.array(first, F.array(square(300, 0, 100)))).otherwise(F.array(first))
    kind = F.when(c % 2 == 0, "MULTIPOLYGON").otherwise("POLYGON")
    return table(spark, sf, "customer").select(c.alias("k"), F.struct(kind.alias("kind"), parts.alias("parts")).alias("shape"))


def place(spark: SparkSession, sf: str) -> DataFrame:
    c = F.col("c_custkey")
    return table(spark, sf, "customer").select(
        c.alias("k"),
        ((F.lit(70000) + (c * 7877) % 30000) / 10000).alias("longitude"),
        ((F.lit(495000) + (c * 5821) % 20000) / 10000).alias("latitude"),
    )
