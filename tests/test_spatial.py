import numpy as np
import pytest
from pyspark.sql import functions as F

from veloflow.functions.geo import line_centroid, line_from_wkt, line_to_wkt, utm32_x, utm32_y
from veloflow.operators.calibration import GlobalMultiplicative
from veloflow.operators.spatial import (
    _cover,
    candidate_pairs,
    distance_to_nearest,
    edges_near_counters,
    find_candidate_edges,
    join_units,
    line_segments,
    match_nearest_edge,
    nearest_pairs,
)
from veloflow.plans.predict import run_calibration

LIMIT = 50.0
EDGE_SCHEMA = "edge_id int, base_id int, count int, line array<struct<x:double,y:double>>"
POINT_SCHEMA = "counter_id int, longitude double, latitude double"


def segment_distance(px, py, a, b):
    d = np.subtract(b, a)
    length = d @ d
    t = 0 if length == 0 else min(1, max(0, ((px - a[0]) * d[0] + (py - a[1]) * d[1]) / length))
    q = np.add(a, t * d)
    return float(np.hypot(px - q[0], py - q[1]))


def line_distance(px, py, line):
    return min(segment_distance(px, py, line[j], line[min(j + 1, len(line) - 1)]) for j in range(max(len(line) - 1, 1)))


@pytest.fixture(scope="module")
def network(spark):
    """Scattered lines, a crowd of short ones in one place, copies, long and missing ones."""
    rng = np.random.default_rng(0)
    points = [(i, *map(float, p)) for i, p in enumerate(rng.uniform(0, 1000, (120, 2)))]
    points += [(1000 + i, *map(float, 500 + p)) for i, p in enumerate(rng.normal(0, 2, (80, 2)))]
    points += [(2000, points[0][1], points[0][2]), (3000, None, 1.0), (3001, 5000.0, 5000.0)]
    lines = []
    for i in range(150):
        path = [rng.uniform(0, 1000, 2)]
        for _ in range(rng.integers(0, 4)):
            path.append(path[-1] + rng.normal(0, 30, 2))
        lines.append((i, i // 2, i * 10, [(float(x), float(y)) for x, y in path]))
    for i in range(150, 350):
        x, y = 500 + rng.normal(0, 2, 2)
        lines.append((i, i // 2, i * 10, [(float(x), float(y)), (float(x + rng.normal()), float(y))]))
    lines += [(400, 1, 1, lines[0][3]), (401, 1, 1, None), (402, 1, 1, []), (403, 7, 7, [(-400.0, 20.0), (1400.0, 25.0)])]
    want = {
        i: sorted((d, e[0]) for e in lines if x is not None and e[3] and (d := line_distance(x, y, e[3])) <= LIMIT)
        for i, x, y in points
    }
    return spark.createDataFrame(points, POINT_SCHEMA), spark.createDataFrame(lines, EDGE_SCHEMA), want


@pytest.mark.parametrize("dense", [None, 40])
def test_nearest_edge_equals_brute_force(network, dense):
    points, edges, want = network
    rows = match_nearest_edge(points, edges, LIMIT, ["base_id", "edge_id"], crs="plane", dense=dense).collect()
    assert len(rows) == len(want)
    for r in rows:
        best = want[r["counter_id"]]
        if not best:
            assert r["nearest_edge_dist_m"] is None and r["base_id"] is None
        else:
            assert r["nearest_edge_dist_m"] == pytest.approx(best[0][0], abs=1e-9)
            assert r["base_id"] == (best[0][1] // 2 if best[0][1] < 400 else 7)


def test_candidates_equal_brute_force(network):
    points, edges, want = network
    pairs = {(r["counter_id"], r["edge_id"]): r["distance"] for r in candidate_pairs(points, edges, LIMIT, [], crs="plane").collect()}
    expected = {(c, e): d for c, found in want.items() for d, e in found}
    assert pairs.keys() == expected.keys()
    assert all(pairs[k] == pytest.approx(expected[k], abs=1e-9) for k in pairs)
    lists = {r["counter_id"]: r["candidate_edges"] for r in find_candidate_edges(points, edges, LIMIT, ["count"], crs="plane").collect()}
    assert lists[3000] is None and lists[3001] == []
    for c, found in lists.items():
        assert [x["distance"] for x in found or []] == sorted(x["distance"] for x in found or [])
        assert len(found or []) == len(want[c])


@pytest.mark.parametrize("kind", ["spread", "clustered", "single_far"])
def test_distance_to_nearest_equals_brute_force(spark, network, kind):
    points, _, _ = network
    rng = np.random.default_rng(3)
    q = {
        "spread": rng.uniform(0, 300, (150, 2)),
        "clustered": np.concatenate([rng.uniform(0, 9000, (20, 2)), 500 + rng.normal(0, 1, (200, 2))]),
        "single_far": np.array([[1e5, 2e5]]),
    }[kind]
    places = spark.createDataFrame([(float(x), float(y)) for x, y in q], "longitude double, latitude double")
    for r in distance_to_nearest(points, places, crs="plane").collect():
        if r["longitude"] is None:
            assert r["dist_to_center_m"] is None
        else:
            assert r["dist_to_center_m"] == pytest.approx(np.hypot(q[:, 0] - r["longitude"], q[:, 1] - r["latitude"]).min(), abs=1e-6)


def test_distance_without_places(spark, network):
    points, _, _ = network
    none = spark.createDataFrame([], "longitude double, latitude double")
    assert distance_to_nearest(points, none, crs="plane").where("dist_to_center_m is not null").isEmpty()


def test_edges_near_flagged(network, spark):
    points, edges, _ = network
    flagged = points.withColumn(
        "flag_severity", F.when(F.col("counter_id") < 3, "no_volume").when(F.col("counter_id") < 6, "warning").otherwise("ok")
    )
    rows = {r["edge_id"] for r in edges_near_counters(edges, flagged, 30, 90, crs="plane").collect()}
    spots = [(r["longitude"], r["latitude"], 90 if r["counter_id"] < 3 else 30) for r in points.where("counter_id < 6").collect()]
    want = {e["edge_id"] for e in edges.collect() if e["line"] and any(line_distance(x, y, e["line"]) <= d for x, y, d in spots)}
    assert rows == want
    calm = points.withColumn("flag_severity", F.lit("ok"))
    assert not edges_near_counters(edges, calm, 30, 90, crs="plane").isEmpty()  # none flagged: all count


SQUARE = [(0.0, 0.0), (1.0, 0.0), (1.0, 1.0), (0.0, 1.0)]
HOLE = [(0.4, 0.4), (0.6, 0.4), (0.6, 0.6), (0.4, 0.6)]
RIGHT = [(1.0, 0.0), (2.0, 0.0), (2.0, 1.0), (1.0, 1.0)]
PART = [(5.0, 5.0), (6.0, 5.0), (5.5, 6.0)]


def test_units_with_hole_parts_and_border(spark):
    units = spark.createDataFrame([("02", [RIGHT]), ("01", [SQUARE, HOLE, PART])], "ars string, rings array<array<struct<x:double,y:double>>>")
    spots = [("in", 0.2, 0.2), ("hole", 0.5, 0.5), ("part", 5.5, 5.5), ("border", 1.0, 0.5), ("corner", 0.0, 0.0), ("rim", 0.4, 0.5), ("out", 3.0, 3.0), ("none", None, None)]
    points = spark.createDataFrame(spots, "counter_id string, longitude double, latitude double")
    found = {r["counter_id"]: r["admin_ars"] for r in join_units(points, units).collect()}
    assert found == {"in": "01", "hole": None, "part": "01", "border": "01", "corner": "01", "rim": "01", "out": None, "none": None}
    inner = {r["counter_id"]: r["ars"] for r in join_units(points, units, output_key="ars", boundary=False, how="inner").collect()}
    assert inner == {"in": "01", "part": "01"}


def test_two_nearest_equal_brute_force(network):
    """Counters that share a location bring two rows each, however many edges lie around."""
    points, edges, want = network
    copies = points.unionByName(points.withColumn("counter_id", F.col("counter_id") + 10000))
    rows = nearest_pairs(copies, edges, LIMIT, 2, crs="plane").orderBy("counter_id", "distance", "edge_id").collect()
    got = {}
    for r in rows:
        got.setdefault(r["counter_id"], []).append((round(r["distance"], 9), r["edge_id"]))
    expected = {c + shift: [(round(d, 9), e) for d, e in found[:2]] for c, found in want.items() for shift in (0, 10000) if found}
    assert got == expected


def test_cells_of_a_segment_come_once_and_are_generated_code(network):
    _, edges, _ = network
    cells = _cover(line_segments(edges, ["edge_id"], crs="plane"), 7.0)
    assert cells.count() == cells.distinct().count() > 0
    assert "lambdafunction" not in cells._jdf.queryExecution().executedPlan().toString().split("Generate")[1]


def test_calibration_matches_stations_once(network):
    points, edges, _ = network
    stations = points.where("longitude is not null").select("counter_id", (F.col("longitude") / 1e5 + 9).alias("longitude"), (F.col("latitude") / 1e5 + 50).alias("latitude"), F.lit(7.0).alias("dtv"))
    vertex = lambda v: F.struct((v["x"] / 1e5 + 9).alias("x"), (v["y"] / 1e5 + 50).alias("y"))
    placed = edges.withColumns({"line": F.transform("line", vertex), "predicted_dtv": F.col("count") + 1.0})
    _, evaluation = run_calibration(GlobalMultiplicative(), stations, placed)
    plan = evaluation._jdf.queryExecution().optimizedPlan().toString()
    assert "InMemoryRelation" in plan and "xxhash64" not in plan.split("InMemoryRelation")[0] and "Generate" not in plan.split("InMemoryRelation")[0]
    assert evaluation.first()["n_without_edge"] > 0


def test_no_nested_loop_over_large_sides(network):
    points, edges, _ = network
    for df in (
        match_nearest_edge(points, edges, LIMIT, crs="plane", dense=None),
        candidate_pairs(points, edges, LIMIT, crs="plane"),
        distance_to_nearest(points, points.where("longitude is not null"), crs="plane"),
    ):
        plan = df._jdf.queryExecution().toString()
        assert "NestedLoop" not in plan and "Cartesian" not in plan and "EvalPython" not in plan


def test_geometry_expressions(spark):
    df = spark.createDataFrame([([(0.0, 0.0), (4.0, 0.0), (4.0, 2.0)],), ([(1.0, 2.0)],), (None,)], "line array<struct<x:double,y:double>>")
    rows = df.select(line_centroid(F.col("line")).alias("m"), line_to_wkt(F.col("line")).alias("w")).collect()
    assert (rows[0]["m"]["x"], rows[0]["m"]["y"]) == pytest.approx((16 / 6, 2 / 6))
    assert (rows[1]["m"]["x"], rows[1]["m"]["y"]) == (1.0, 2.0) and rows[2]["m"] is None
    assert rows[0]["w"] == "LINESTRING (0.0 0.0, 4.0 0.0, 4.0 2.0)"
    back = spark.createDataFrame([(rows[0]["w"],), ("POINT (1 2)",)], "w string").select(line_from_wkt(F.col("w")).alias("l")).collect()
    assert [tuple(p) for p in back[0]["l"]] == [(0.0, 0.0), (4.0, 0.0), (4.0, 2.0)] and back[1]["l"] is None
    utm = spark.range(1).select(utm32_x(F.lit(9.0), F.lit(50.0)).alias("x"), utm32_y(F.lit(9.0), F.lit(50.0)).alias("y")).first()
    assert (utm["x"], utm["y"]) == pytest.approx((500000.0, 5538630.7027), abs=1e-3)
