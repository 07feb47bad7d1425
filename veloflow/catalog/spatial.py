"""Distance and containment joins, compared with brute force in SQL."""

from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from ..functions.geo import utm32_x, utm32_y
from ..functions.shapes import shape_centroid
from ..ml.inference import predict_at_locations
from ..operators import spatial as sp
from ..operators.edge_cells import candidate_pairs_stored, match_nearest_stored, store_edge_cells
from ..session import scratch_path
from ..sources import readers, writers
from . import stand_ins as t
from .registry import query, rounded

LIMIT = 2000.0
R = "6378137.0::DOUBLE"


def _x(lon):
    return f"({R} * radians({lon}))"


def _y(lat):
    return f"({R} * ln(tan(pi() / 4 + radians({lat}) / 2)))"


EDGE_M = f"SELECT edge_id, base_id, count, {_x('lon1')} AS x1, {_y('lat1')} AS y1, {_x('lon2')} AS x2, {_y('lat2')} AS y2 FROM edge"
POINT_M = f"SELECT counter_id, {_x('longitude')} AS px, {_y('latitude')} AS py FROM counter"
T_EXPR = """least(greatest(((px - x1) * (x2 - x1) + (py - y1) * (y2 - y1)) /
     (CASE WHEN (x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1) > 0 THEN (x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1) ELSE 1 END), 0), 1)"""


def _pairs(points: str, edges: str) -> str:
    """All pairs with their distance."""
    return f"""SELECT *, sqrt((px - (x1 + u * (x2 - x1))) * (px - (x1 + u * (x2 - x1))) + (py - (y1 + u * (y2 - y1))) * (py - (y1 + u * (y2 - y1)))) AS d
               FROM (SELECT *, {T_EXPR} AS u FROM ({points}) p, ({edges}) e)"""


@query(
    "nearest_edge",
    t.sql(
        f"""SELECT c.counter_id, round(n.d, 4) AS nearest_edge_dist_m, n.base_id, n.count FROM counter c LEFT JOIN
              (SELECT *, row_number() OVER (PARTITION BY counter_id ORDER BY d, edge_id) AS rn FROM ({_pairs(POINT_M, EDGE_M)}) WHERE d <= {LIMIT}) n
            ON c.counter_id = n.counter_id AND n.rn = 1""",
        "counter",
        "edge",
    ),
)
def nearest_edge(spark, sf):
    out = sp.match_nearest_edge(t.counter(spark, sf), t.edge(spark, sf), LIMIT, ["base_id", "count"])
    return rounded(out.select("counter_id", "nearest_edge_dist_m", "base_id", "count"), 4)


def _stored(spark, sf):
    name = f"edge_cells_{uuid.uuid4().hex}"
    return store_edge_cells(t.edge(spark, sf), name, LIMIT, ["base_id", "count"], path=scratch_path(spark, "edge-cells"), buckets=8)


@query(
    "nearest_edge_stored",
    t.sql(
        f"""SELECT c.counter_id, round(n.d, 4) AS nearest_edge_dist_m, n.base_id, n.count FROM counter c LEFT JOIN
              (SELECT *, row_number() OVER (PARTITION BY counter_id ORDER BY d, edge_id) AS rn FROM ({_pairs(POINT_M, EDGE_M)}) WHERE d <= {LIMIT}) n
            ON c.counter_id = n.counter_id AND n.rn = 1""",
        "counter",
        "edge",
    ),
)
def nearest_edge_stored(spark, sf):
    """J11 against edge cells stored once."""
    out = match_nearest_stored(t.counter(spark, sf), _stored(spark, sf), LIMIT)
    return rounded(out.select("counter_id", "nearest_edge_dist_m", "base_id", "count"), 4)


@query(
    "candidate_pairs_stored",
    t.sql(f"SELECT counter_id, edge_id, base_id, round(d, 4) AS distance FROM ({_pairs(POINT_M, EDGE_M)}) WHERE d <= {LIMIT}", "counter", "edge"),
)
def stored_candidates(spark, sf):
    """J12 against edge cells stored once."""
    pairs = candidate_pairs_stored(t.counter(spark, sf), _stored(spark, sf), LIMIT)
    return rounded(pairs.select("counter_id", "edge_id", "base_id", "distance"), 4)


@query(
    "candidate_edges",
    t.sql(f"SELECT counter_id, edge_id, base_id, round(d, 4) AS distance FROM ({_pairs(POINT_M, EDGE_M)}) WHERE d <= {LIMIT}", "counter", "edge"),
)
def candidate_edges(spark, sf):
    lists = sp.find_candidate_edges(t.counter(spark, sf), t.edge(spark, sf), LIMIT, ["base_id"])
    rows = lists.select("counter_id", F.inline("candidate_edges"))
    return rounded(rows.select("counter_id", "edge_id", "base_id", "distance"), 4)


@query(
    "candidate_counts",
    t.sql(
        f"""SELECT counter_id, CAST(count(*) AS BIGINT) AS n_candidates, round(min(d), 4) AS nearest, round(max(d), 4) AS farthest
            FROM ({_pairs(POINT_M, EDGE_M)}) WHERE d <= {LIMIT} GROUP BY 1""",
        "counter",
        "edge",
    ),
)
def candidate_counts(spark, sf):
    pairs = sp.candidate_pairs(t.counter(spark, sf), t.edge(spark, sf), LIMIT, [])
    stats = pairs.groupBy("counter_id").agg(
        F.count("*").alias("n_candidates"), F.min("distance").alias("nearest"), F.max("distance").alias("farthest")
    )
    return rounded(stats, 4)


@query(
    "nearest_centroid",
    t.sql(
        f"""SELECT c.counter_id, round(min(sqrt(({_x('c.longitude')} - {_x('p.longitude')}) ** 2 + ({_y('c.latitude')} - {_y('p.latitude')}) ** 2)), 4)
                   AS dist_to_center_m FROM counter c, place p GROUP BY 1""",
        "counter",
        "place",
    ),
)
def nearest_centroid(spark, sf):
    out = sp.distance_to_nearest(t.counter(spark, sf), t.place(spark, sf))
    return rounded(out.select("counter_id", "dist_to_center_m"), 4)


@query(
    "edge_centroid_distance",
    t.sql(
        f"""SELECT edge_id, round(min(sqrt(((x1 + x2) / 2 - {_x('p.longitude')}) ** 2 + ((y1 + y2) / 2 - {_y('p.latitude')}) ** 2)), 4) AS dist_to_center_m
            FROM ({EDGE_M}) e, place p GROUP BY 1""",
        "edge",
        "place",
    ),
)
def edge_centroid_distance(spark, sf):
    out = sp.line_distance_to_nearest(t.edge(spark, sf), t.place(spark, sf))
    return rounded(out.select("edge_id", "dist_to_center_m"), 4)


# zone 32 coordinates in SQL: third-order series, as text for one longitude and latitude
_N = 0.0016792203946287445
_A = 6367449.145771046
_E = 0.0818191910428158


def _series(kind: str) -> str:
    a = (
        _N / 2 - 2 * _N**2 / 3 + 5 * _N**3 / 16,
        13 * _N**2 / 48 - 3 * _N**3 / 5,
        61 * _N**3 / 240,
    )
    f, g, base = ("cos", "sinh", "eta") if kind == "x" else ("sin", "cosh", "xi")
    other = "eta" if kind == "x" else "eta"
    terms = " + ".join(f"{c!r}::DOUBLE * {f}({2 * j} * xi) * {g}({2 * j} * {other})" for j, c in enumerate(a, start=1))
    return f"({base} + {terms})"


def _utm(source: str, lon: str, lat: str, keep: str, x: str, y: str) -> str:
    t_expr = f"sinh(atanh(sin(radians({lat}))) - {_E!r}::DOUBLE * atanh({_E!r}::DOUBLE * sin(radians({lat}))))"
    return f"""SELECT {keep}, 500000 + {0.9996 * _A!r}::DOUBLE * {_series('x')} AS {x}, {0.9996 * _A!r}::DOUBLE * {_series('y')} AS {y}
               FROM (SELECT *, atan2(tt, cos(dl)) AS xi, atanh(sin(dl) / sqrt(1 + tt * tt)) AS eta
                     FROM (SELECT *, {t_expr} AS tt, radians({lon} - 9) AS dl FROM {source}))"""


STATION_UTM = _utm("counter", "longitude", "latitude", "counter_id", "px", "py")
EDGE_UTM = _utm(f"({_utm('edge', 'lon1', 'lat1', '*', 'x1', 'y1').replace('SELECT *, 500000', 'SELECT edge_id, count, lon2, lat2, 500000', 1)})", "lon2", "lat2", "edge_id, count, x1, y1", "x2", "y2")


@query("project_utm32", t.sql(f"SELECT counter_id, round(px, 3) AS x, round(py, 3) AS y FROM ({STATION_UTM})", "counter"))
def project_utm32(spark, sf):
    lon, lat = F.col("longitude"), F.col("latitude")
    return rounded(t.counter(spark, sf).select("counter_id", utm32_x(lon, lat).alias("x"), utm32_y(lon, lat).alias("y")), 3)


@query(
    "station_prediction",
    t.sql(
        f"""SELECT c.counter_id, round(n.d, 3) AS edge_dist_m, n.count / 2 AS predicted_dtv FROM counter c LEFT JOIN
              (SELECT *, row_number() OVER (PARTITION BY counter_id ORDER BY d, edge_id) AS rn FROM ({_pairs(STATION_UTM, EDGE_UTM)}) WHERE d <= 1500) n
            ON c.counter_id = n.counter_id AND n.rn = 1""",
        "counter",
        "edge",
    ),
)
def station_prediction(spark, sf):
    edges = t.edge(spark, sf).withColumn("predicted_dtv", F.col("count") / 2)
    out = predict_at_locations(t.counter(spark, sf), edges, 1500.0)
    return rounded(out.select("counter_id", "edge_dist_m", "predicted_dtv"), 3)


SEVERITY = "CASE k % 4 WHEN 0 THEN 'ok' WHEN 1 THEN 'warning' WHEN 2 THEN 'no_volume' ELSE 'ok' END"


@query(
    "near_flagged_edges",
    t.sql(
        f"""SELECT DISTINCT edge_id, base_id FROM ({_pairs(
            f"SELECT k, {_x('longitude')} AS px, {_y('latitude')} AS py, CASE WHEN k % 4 = 2 THEN 3000 ELSE 750 END AS radius FROM counter WHERE {SEVERITY} <> 'ok'",
            EDGE_M)}) WHERE d <= radius""",
        "counter",
        "edge",
    ),
)
def near_flagged_edges(spark, sf):
    counters = t.counter(spark, sf).withColumn("flag_severity", t.pick(F.col("k") % 4, ("ok", "warning", "no_volume", "ok")))
    return sp.edges_near_counters(t.edge(spark, sf), counters, 750.0, 3000.0).select("edge_id", "base_id")


IN_TILE = "px BETWEEN x0 AND x9 AND py BETWEEN y0 AND y9 AND NOT (has_hole AND px > hx0 AND px < hx9 AND py > hy0 AND py < hy9)"
WITHIN_TILE = "px > x0 AND px < x9 AND py > y0 AND py < y9 AND NOT (has_hole AND px BETWEEN hx0 AND hx9 AND py BETWEEN hy0 AND hy9)"
POINTS = "SELECT counter_id, longitude AS px, latitude AS py FROM counter"


@query(
    "unit_intersects",
    t.sql(
        f"""SELECT p.counter_id, min(u.ars) AS admin_ars FROM ({POINTS}) p LEFT JOIN tile u ON {IN_TILE} GROUP BY 1""",
        "counter",
        "tile",
    ),
)
def unit_intersects(spark, sf):
    return sp.join_units(t.counter(spark, sf), t.tile(spark, sf)).select("counter_id", "admin_ars")


@query(
    "unit_within",
    t.sql(f"SELECT p.counter_id, min(u.ars) AS ars FROM ({POINTS}) p JOIN tile u ON {WITHIN_TILE} GROUP BY 1", "counter", "tile"),
)
def unit_within(spark, sf):
    out = sp.join_units(t.counter(spark, sf), t.tile(spark, sf), output_key="ars", boundary=False, how="inner")
    return out.select("counter_id", "ars")


@query(
    "edge_unit_within",
    t.sql(
        f"""SELECT p.edge_id, min(u.ars) AS ars FROM (SELECT edge_id, (lon1 + lon2) / 2 AS px, (lat1 + lat2) / 2 AS py FROM edge) p
            LEFT JOIN tile u ON {WITHIN_TILE} GROUP BY 1""",
        "edge",
        "tile",
    ),
)
def edge_unit_within(spark, sf):
    edges = t.edge(spark, sf).select("edge_id", "line")
    return sp.join_lines_to_units(edges, t.tile(spark, sf)).select("edge_id", "ars")


# --- geometry of several parts, read from text -------------------------------------------------


def _written_areas(spark, sf):
    """Areas written as text, as a file with geometry is delivered, and read back."""
    areas = t.area(spark, sf).withColumn("ARS", F.format_string("%012d", "k")).drop("k")
    path = writers.write_predictions(areas, scratch_path(spark, "areas") + ".csv", "csv")
    return readers.read_municipalities(spark, path).withColumn("k", F.col("ars").cast("bigint"))


def _centroids(x0: str = "x0", x9: str = "x9", y0: str = "y0", y9: str = "y9") -> str:
    """Centroids of the areas from their rectangles."""
    w = f"sgn * ({x9} - {x0}) * ({y9} - {y0})"
    return f"SELECT k, sum({w} * ({x0} + {x9}) / 2) / sum({w}) AS px, sum({w} * ({y0} + {y9}) / 2) / sum({w}) AS py FROM area_rect GROUP BY k"


@query(
    "area_text",
    t.sql(
        f"""SELECT c.k, CASE WHEN c.k % 2 = 0 THEN 'MULTIPOLYGON' ELSE 'POLYGON' END AS kind, r.n_parts, r.n_rings,
                   round(c.px, 8) AS x, round(c.py, 8) AS y
            FROM ({_centroids()}) c JOIN (SELECT k, count(*) FILTER (WHERE sgn = 1) AS n_parts, count(*) AS n_rings FROM area_rect GROUP BY k) r
            ON c.k = r.k""",
        "area_rect",
    ),
)
def area_text(spark, sf):
    """Polygons with holes and several parts as text and back; centroids by surface."""
    s = F.col("shape")
    out = _written_areas(spark, sf).withColumn("_c", shape_centroid(s))
    counts = (F.size(s["parts"]).cast("bigint").alias("n_parts"), F.size("rings").cast("bigint").alias("n_rings"))
    return rounded(out.select("k", s["kind"].alias("kind"), *counts, F.col("_c.x").alias("x"), F.col("_c.y").alias("y")), 8)


@query(
    "area_unit_within",
    t.sql(f"SELECT p.k, min(u.ars) AS unit FROM ({_centroids()}) p LEFT JOIN tile u ON {WITHIN_TILE} GROUP BY 1", "area_rect", "tile"),
)
def area_unit_within(spark, sf):
    """Areas go to the unit their centroid lies in."""
    areas = _written_areas(spark, sf).select("k", "shape")
    return sp.join_lines_to_units(areas, t.tile(spark, sf), line="shape", output_key="unit").select("k", "unit")


@query(
    "area_center_distance",
    t.sql(
        f"""SELECT k, round(min(sqrt((a.px - b.px) * (a.px - b.px) + (a.py - b.py) * (a.py - b.py))), 3) AS dist_to_center_m
            FROM ({_centroids(_x('x0'), _x('x9'), _y('y0'), _y('y9'))}) a, ({POINT_M}) b GROUP BY k""",
        "area_rect",
        "counter",
    ),
)
def area_center_distance(spark, sf):
    """Distance of the projected centroid of each area to the nearest place."""
    areas = _written_areas(spark, sf).select("k", "shape")
    places = t.counter(spark, sf).select("longitude", "latitude")
    return rounded(sp.line_distance_to_nearest(areas, places, line="shape").select("k", "dist_to_center_m"), 3)


@query(
    "unit_of_multi_area",
    t.sql(
        """SELECT k, min(unit) AS unit FROM (
             SELECT c.k, r.k AS unit FROM counter c LEFT JOIN area_rect r ON c.longitude BETWEEN r.x0 AND r.x9 AND c.latitude BETWEEN r.y0 AND r.y9
               AND r.sgn = 1 AND NOT EXISTS (SELECT 1 FROM area_rect h WHERE h.k = r.k AND h.sgn = -1
                 AND c.longitude > h.x0 AND c.longitude < h.x9 AND c.latitude > h.y0 AND c.latitude < h.y9)) GROUP BY k""",
        "counter",
        "area_rect",
    ),
)
def unit_of_multi_area(spark, sf):
    """J15 on read geometry: locations in areas of several parts with holes."""
    units = _written_areas(spark, sf).select(F.col("k").alias("unit_key"), "rings")
    return sp.join_units(t.counter(spark, sf), units, key="unit_key", output_key="unit").select("k", "unit")


EDGE_PARTS_M = f"""SELECT edge_id, base_id, count, {_x('lon1 + shift')} AS x1, {_y('lat1')} AS y1, {_x('lon2 + shift')} AS x2, {_y('lat2')} AS y2
                   FROM edge, (VALUES (0), (0.003)) s (shift) WHERE shift = 0 OR edge_id % 2 = 0"""


@query(
    "nearest_multi_line",
    t.sql(
        f"""SELECT c.counter_id, round(n.d, 4) AS nearest_edge_dist_m, n.base_id, n.count FROM counter c LEFT JOIN
              (SELECT *, row_number() OVER (PARTITION BY counter_id ORDER BY d, edge_id) AS rn FROM ({_pairs(POINT_M, EDGE_PARTS_M)}) WHERE d <= {LIMIT}) n
            ON c.counter_id = n.counter_id AND n.rn = 1""",
        "counter",
        "edge",
    ),
)
def nearest_multi_line(spark, sf):
    """Edges of two parts, written as text and read back; the gap between the parts is no edge."""
    line = F.col("line")
    beside = F.transform(line, lambda v: F.struct((v["x"] + 0.003).alias("x"), v["y"].alias("y")))
    gap = F.array(F.lit(None).cast("struct<x:double,y:double>"))
    edges = t.edge(spark, sf).withColumn("line", F.when(F.col("edge_id") % 2 == 0, F.concat(line, gap, beside)).otherwise(line))
    path = writers.write_predictions(edges, scratch_path(spark, "multi") + ".csv", "csv")
    out = sp.match_nearest_edge(t.counter(spark, sf), readers.read_traffic_volumes(spark, path), LIMIT, ["base_id", "count"])
    return rounded(out.select("counter_id", "nearest_edge_dist_m", "base_id", "count"), 4)
