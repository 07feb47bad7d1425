"""The composite pipelines over the stand-in network."""

from __future__ import annotations

from pyspark.sql import Column, functions as F

from ..ml.training import fit_model
from ..operators.calibration import GlobalMultiplicative
from ..plans.etl import EtlInputs, Structure, run_etl
from ..plans.predict import prepare_review, run_calibration, run_prediction
from . import stand_ins as t
from .counters import DTV_SQL, END, INFRA_SQL, START
from .registry import query, rounded
from .spatial import WITHIN_TILE, _pairs, _x, _y

# Own edges of each counter: one 0.0001 degrees north of it, for half of the counters a second one.
NETWORK = """SELECT edge_id, base_id, count, lon1, lat1, lon2, lat2, raw FROM (
    SELECT e.*, c.raw FROM edge e JOIN edge_class c ON e.edge_id = c.edge_id
    UNION ALL SELECT 1000000000 + k, 500000000 + k, CAST(k * 10 + 5 AS BIGINT), longitude - 0.001::DOUBLE, latitude + 0.0001::DOUBLE,
                     longitude + 0.001::DOUBLE, latitude + 0.0001::DOUBLE, 'bicycle_way_left' FROM counter
    UNION ALL SELECT 2000000000 + k, 600000000 + k, CAST(7 AS BIGINT), longitude - 0.001::DOUBLE, latitude - CASE WHEN k % 4 = 0 THEN 0.00015::DOUBLE ELSE 0.00025::DOUBLE END,
                     longitude + 0.001::DOUBLE, latitude - CASE WHEN k % 4 = 0 THEN 0.00015::DOUBLE ELSE 0.00025::DOUBLE END, 'mit_road' FROM counter WHERE k % 4 < 2)"""


def network(spark, sf):
    base = t.edge(spark, sf).join(t.edge_class(spark, sf).select("edge_id", F.col("raw").alias("bicycle_infrastructure")), "edge_id")
    c, k = t.counter(spark, sf), F.col("k")

    def beside(offset: Column, first: int, way: int, count: Column, cls: str):
        y = F.col("latitude") + offset
        line = F.array(*[F.struct((F.col("longitude") + d).alias("x"), y.alias("y")) for d in (F.lit(-0.001), F.lit(0.001))])
        return c.select(
            (F.lit(first) + k).alias("edge_id"),
            (F.lit(way) + k).alias("base_id"),
            count.cast("bigint").alias("count"),
            line.alias("line"),
            F.lit(cls).alias("bicycle_infrastructure"),
            "k",
        )

    north = beside(F.lit(0.0001), 1_000_000_000, 500_000_000, k * 10 + 5, "bicycle_way_left")
    gap = -F.when(k % 4 == 0, 0.00015).otherwise(0.00025)
    south = beside(gap, 2_000_000_000, 600_000_000, F.lit(7), "mit_road").where("k % 4 < 2")
    return base.select("edge_id", "base_id", "count", "line", "bicycle_infrastructure").unionByName(north.drop("k")).unionByName(south.drop("k"))


def structure(spark, sf):
    n = F.col("n")
    tiles = t.tile(spark, sf).withColumn("n", F.substring("ars", 3, 3).cast("int"))
    municipalities = tiles.select("ars", "name", "rings", F.when(n % 8 == 0, 0).otherwise((n + 1) * 1000).cast("bigint").alias("population"))
    regiostar = tiles.select("ars", (F.lit(51) + n % 5).alias("regiostar5"), (F.lit(71) + n % 7).alias("regiostar7"))
    demographics = tiles.select(
        F.when(n % 6 == 1, F.concat(F.lit("99"), F.substring("ars", 3, 10))).otherwise(F.col("ars")).alias("ars"), (n * 10 + 3).cast("bigint").alias("n_users"), (n * 100).cast("bigint").alias("n_trips"), (n * 7.5).alias("total_km")
    )
    return Structure(municipalities, regiostar, t.place(spark, sf), demographics)


def inputs(spark, sf, verified: bool = False):
    k = F.col("k")
    locations = t.counter(spark, sf).select(k.cast("string").alias("name"), "longitude", "latitude")
    checked = None
    if verified:
        checked = t.counter(spark, sf).select(
            k.cast("string").alias("counter_id"),
            (k * 3).alias("base_id"),
            (k * 10).alias("count"),
            t.pick(k % 9, t.RAW_CLASSES).alias("bicycle_infrastructure"),
            F.when(k % 5 == 0, "verified").otherwise("carryover").alias("verification_status"),
        )
    return EtlInputs(locations, network(spark, sf), structure(spark, sf), START, END, t.daily(spark, sf), verified=checked)


RAW_OF_K = """CASE k % 9 WHEN 0 THEN 'bicycle_lane_left' WHEN 1 THEN 'bus_lane_both' WHEN 2 THEN 'bicycle_way_both' WHEN 3 THEN 'mit_road'
   WHEN 4 THEN 'mixed_way_left' WHEN 5 THEN 'path_not_forbidden' WHEN 6 THEN 'bicycle_road_both' WHEN 7 THEN 'bicycle_way' ELSE NULL END"""
TILE_OF = f"SELECT p.k, min(u.k) AS n FROM (SELECT k, longitude AS px, latitude AS py FROM counter) p JOIN tile u ON {WITHIN_TILE} GROUP BY 1"
HUB = f"""SELECT c.k, min(sqrt(({_x('c.longitude')} - {_x('p.longitude')}) ** 2 + ({_y('c.latitude')} - {_y('p.latitude')}) ** 2)) AS d FROM counter c, place p GROUP BY 1"""
USERS = "CASE WHEN n % 6 <> 1 THEN n * 10 + 3 END"
PEOPLE = "CASE WHEN n % 8 = 0 THEN NULL ELSE (n + 1) * 1000 END"


@query(
    "etl_pipeline",
    t.sql(
        f"""SELECT {INFRA_SQL} AS "OSM_Radinfra", round(CAST({USERS} AS DOUBLE) / {PEOPLE}, 6) AS "TN_SR_relativ",
                  round(CAST({USERS} AS DOUBLE) * (k * 10) / {PEOPLE}, 6) AS "Streckengewicht_SR",
                  CAST(51 + n % 5 AS INTEGER) AS "RegioStaR5", CAST(71 + n % 7 AS INTEGER) AS "RegioStaR7", CAST(k * 10 AS BIGINT) AS "Erh_SR",
                  round(d, 4) AS "HubDist", CAST(k AS VARCHAR) AS id, CAST(k * 3 AS BIGINT) AS base_id, latitude AS lat, longitude AS lon, dtv AS "DZS_mean_SR"
           FROM (SELECT c.k, c.latitude, c.longitude, m.dtv, x.n, h.d, {RAW_OF_K.replace('k %', 'c.k %')} AS raw
                 FROM counter c JOIN (SELECT * FROM ({DTV_SQL}) WHERE q >= 0.5 AND observation_count >= 7) m ON CAST(c.k AS VARCHAR) = m.counter_id
                 LEFT JOIN ({TILE_OF}) x ON x.k = c.k JOIN ({HUB}) h ON h.k = c.k)""",
        "daily",
        "counter",
        "tile",
        "place",
    ),
)
def etl_pipeline(spark, sf):
    training = run_etl(inputs(spark, sf, verified=True)).training
    return rounded(rounded(training, 6, "TN_SR_relativ", "Streckengewicht_SR"), 4, "HubDist")


@query(
    "etl_counts",
    t.sql(
        f"""SELECT CAST((SELECT count(*) FROM ({DTV_SQL}) WHERE q >= 0.5 AND observation_count >= 7) AS BIGINT) AS n_targets, CAST(count(*) AS BIGINT) AS n_counters,
                   CAST(count(c.k * 3) AS BIGINT) AS n_matched, CAST(count(*) AS BIGINT) AS n_training
            FROM counter c JOIN (SELECT * FROM ({DTV_SQL}) WHERE q >= 0.5 AND observation_count >= 7) m ON CAST(c.k AS VARCHAR) = m.counter_id""",
        "daily",
        "counter",
    ),
)
def etl_counts(spark, sf):
    return run_etl(inputs(spark, sf, verified=True)).counts


NET_M = f"SELECT edge_id, base_id, count, {_x('lon1')} AS x1, {_y('lat1')} AS y1, {_x('lon2')} AS x2, {_y('lat2')} AS y2 FROM net"
GOOD = f"""SELECT c.k, CAST(c.k AS VARCHAR) AS counter_id, {_x('c.longitude')} AS px, {_y('c.latitude')} AS py, m.dtv
   FROM counter c JOIN (SELECT * FROM ({DTV_SQL}) WHERE q >= 0.5 AND observation_count >= 7) m ON CAST(c.k AS VARCHAR) = m.counter_id"""


@query(
    "etl_review",
    t.with_tables("daily", "counter", "edge", "edge_class")
    + f""", net AS ({NETWORK}), near AS (SELECT *, row_number() OVER (PARTITION BY counter_id ORDER BY d, edge_id) AS rn FROM ({_pairs(GOOD, NET_M)}) WHERE d <= 50)
        SELECT a.counter_id, a.base_id, a.count, round(a.d, 4) AS nearest_edge_dist_m, round(a.dtv / nullif(a.count, 0), 6) AS dtv_volume_ratio,
               coalesce(b.d / nullif(a.d, 0) < 2, FALSE) AS is_ambiguous FROM near a LEFT JOIN near b ON a.counter_id = b.counter_id AND b.rn = 2 WHERE a.rn = 1""",
)
def etl_review(spark, sf):
    review = run_etl(inputs(spark, sf), mode="verification").review
    out = review.select("counter_id", "base_id", "count", "nearest_edge_dist_m", "dtv_volume_ratio", "is_ambiguous")
    return rounded(rounded(out, 4, "nearest_edge_dist_m"), 6, "dtv_volume_ratio")


@query("etl_units")
def etl_units(spark, sf):
    """Administrative-unit variant: tiles as counties, their statistics summed per county."""
    s = structure(spark, sf)
    s.units = s.municipalities.select("ars", "name", F.lit("Kreis").alias("admin_level"), "rings")
    s.level = "Kreis"
    i = inputs(spark, sf, verified=True)
    i.structure = s
    return rounded(run_etl(i).training, 4)


def _edge_model(spark, sf):
    """Small model on the stand-in training table, by volume and infrastructure."""
    from .scoring import _learning_table

    return fit_model(_learning_table(spark, sf), "Linear Regression", ["stadtradeln_volume", "infra_category", "regiostar7"])


@query("predict_pipeline")
def predict_pipeline(spark, sf):
    scored = run_prediction(_edge_model(spark, sf), network(spark, sf), structure(spark, sf))
    return rounded(scored.select("edge_id", "base_id", "campaign_count", "predicted_dtv"), 4)


@query("calibration_pipeline")
def calibration_pipeline(spark, sf):
    edges = network(spark, sf).withColumn("predicted_dtv", F.col("count") * 2.0 + 1)
    stations = t.counter(spark, sf).select(F.col("counter_id").alias("id"), "longitude", "latitude", F.abs("s_acctbal").alias("dtv"))
    calibrated, _ = run_calibration(GlobalMultiplicative(), stations, edges)
    return rounded(calibrated.select("edge_id", "predicted_dtv_uncalibrated", "predicted_dtv"), 4)


@query("calibration_evaluation")
def calibration_evaluation(spark, sf):
    edges = network(spark, sf).withColumn("predicted_dtv", F.col("count") * 2.0 + 1)
    stations = t.counter(spark, sf).select(F.col("counter_id").alias("id"), "longitude", "latitude", F.abs("s_acctbal").alias("dtv"))
    _, evaluation = run_calibration(GlobalMultiplicative(), stations, edges)
    return rounded(evaluation, 4)


@query("review_edges")
def review_edges(spark, sf):
    _, edges = prepare_review(inputs(spark, sf))
    return edges.select("edge_id", "base_id", "count")


