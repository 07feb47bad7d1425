"""Geometry of several parts and rings: text in and out, centroids, joins on what was read."""

import math

import pytest
from pyspark.sql import functions as F

from veloflow.functions.geo import line_centroid, line_to_wkt
from veloflow.functions.shapes import shape_centroid, shape_from_wkt, shape_line, shape_rings, shape_to_wkt
from veloflow.operators.spatial import join_lines_to_units, join_units, line_distance_to_nearest, match_nearest_edge
from veloflow.sources.readers import admin_units, geometry_report, municipalities, read_municipalities, traffic_volumes
from veloflow.sources.writers import write_predictions

HOLED = "POLYGON ((0.0 0.0, 10.0 0.0, 10.0 10.0, 0.0 10.0, 0.0 0.0), (1.0 1.0, 1.0 5.0, 5.0 5.0, 5.0 1.0, 1.0 1.0))"
TWO = "MULTIPOLYGON (((0.0 0.0, 2.0 0.0, 2.0 2.0, 0.0 2.0, 0.0 0.0)), ((10.0 0.0, 11.0 0.0, 11.0 1.0, 10.0 1.0, 10.0 0.0), (10.2 0.2, 10.4 0.2, 10.4 0.4, 10.2 0.2)))"
LINES = "MULTILINESTRING ((0.0 0.0, 3.0 4.0), (10.0 0.0, 10.0 5.0, 12.0 5.0))"


def texts(spark, *values):
    return spark.createDataFrame([(i, v) for i, v in enumerate(values)], "i int, geometry string")


def column(df, c):
    return [r[0] for r in df.coalesce(1).orderBy("i").select(c).collect()]


def test_round_trip(spark):
    whole = (
        HOLED, TWO, LINES, "POINT (1.0 2.0)", "MULTIPOINT ((1.0 2.0), (3.0 4.0))", "LINESTRING (0.0 0.0, 1.0 1.0)",
        "POLYGON EMPTY", "MULTIPOLYGON EMPTY",
    )
    back = column(texts(spark, *whole), shape_to_wkt(shape_from_wkt(F.col("geometry"))))
    assert back == list(whole)


def test_other_notations(spark):
    given = texts(
        spark,
        "SRID=4326; polygon z((0 0 7,4 0 7 , 4 4 7,0 0 7))",
        "MULTIPOINT (1 2, 3 4)",
        "LineString ZM (0 0 1 1,\n 1e1 -.5 1 1)",
    )
    assert column(given, shape_to_wkt(shape_from_wkt(F.col("geometry")))) == [
        "POLYGON ((0.0 0.0, 4.0 0.0, 4.0 4.0, 0.0 0.0))",
        "MULTIPOINT ((1.0 2.0), (3.0 4.0))",
        "LINESTRING (0.0 0.0, 10.0 -0.5)",
    ]


def test_unreadable_texts_are_counted(spark):
    bad = (
        "POLYGON ((0 0, 1 0, 1 1, 0 1))",  # open
        "POLYGON ((0 0, 1 0, 0 0))",  # too short
        "POLYGON (0 0, 1 0, 1 1, 0 0)",
        "POLYGON ((0 0, 1 0, 1 1, 0 0)",
        "MULTIPOLYGON ((0 0, 1 0, 1 1, 0 0))",
        "LINESTRING ((0 0, 1 1))",
        "LINESTRING (0 0)",
        "LINESTRING (0 0, 1)",
        "LINESTRING (0 0, NaN 1)",
        "LINESTRING (0 0, 1e999 1)",
        "LINESTRING (0 0, 1 1,)",
        "POINT (1 2 3 4 5)",
        "CIRCLE (1 2)",
        "R",
    )
    df = texts(spark, *bad, None, " ", "POLYGON EMPTY", HOLED, LINES, LINES)
    assert column(df, shape_from_wkt(F.col("geometry")))[: len(bad) + 2] == [None] * (len(bad) + 2)
    assert {r["kind"]: r["n"] for r in geometry_report(df).collect()} == {
        "UNREADABLE": len(bad), "MISSING": 2, "EMPTY": 1, "POLYGON": 1, "MULTILINESTRING": 2,
    }
    assert geometry_report(df.where("false")).count() == 0


def test_long_texts(spark):
    n = 50_000
    ring = ",".join(f"{i} {i % 2}" for i in range(n))
    many = ",".join(f"(({i} 0,{i + 1} 0,{i + 1} 1,{i} 0))" for i in range(5_000))
    df = texts(spark, f"LINESTRING ({ring})", f"MULTIPOLYGON ({many})", "(" * n)
    shape = shape_from_wkt(F.col("geometry"))
    assert column(df, F.size(F.flatten(F.flatten(shape["parts"])))) == [n, 20_000, None]


@pytest.mark.parametrize(
    ("text", "x", "y"),
    [
        (HOLED, (100 * 5 - 16 * 3) / 84, (100 * 5 - 16 * 3) / 84),
        ("POLYGON ((0 0, 0 3, 3 0, 0 0))", 1.0, 1.0),  # the other way round
        ("MULTIPOLYGON (((0 0, 2 0, 2 2, 0 2, 0 0)), ((10 0, 11 0, 11 1, 10 1, 10 0)))", (4 * 1 + 10.5) / 5, (4 * 1 + 0.5) / 5),
        ("POLYGON ((0 0, 4 0, 2 0, 0 0))", 2.0, 0.0),  # no surface: by length
        ("POLYGON ((7 8, 7 8, 7 8, 7 8))", 7.0, 8.0),  # no length: by vertex
        (LINES, (5 * 1.5 + 5 * 10 + 2 * 11) / 12, (5 * 2 + 5 * 2.5 + 2 * 5) / 12),
        ("MULTIPOINT (1 2, 3 8)", 2.0, 5.0),
        ("POINT (1 2)", 1.0, 2.0),
    ],
)
def test_centroid(spark, text, x, y):
    c = texts(spark, text).select(shape_centroid(shape_from_wkt(F.col("geometry"))).alias("c")).first()["c"]
    assert (c["x"], c["y"]) == pytest.approx((x, y))


def test_centroid_of_nothing(spark):
    assert column(texts(spark, None, "POLYGON EMPTY", "x"), shape_centroid(shape_from_wkt(F.col("geometry")))) == [None] * 3


def test_small_area_far_from_zero_keeps_its_digits(spark):
    e, n = 4_500_000.0, 5_500_000.0
    square = ", ".join(f"{e + a} {n + b}" for a, b in ((0, 0), (0.01, 0), (0.01, 0.01), (0, 0.01), (0, 0)))
    c = texts(spark, f"POLYGON (({square}))").select(shape_centroid(shape_from_wkt(F.col("geometry"))).alias("c")).first()["c"]
    assert (c["x"], c["y"]) == pytest.approx((e + 0.005, n + 0.005), abs=1e-7)


def test_parts_of_a_line(spark):
    df = texts(spark, LINES, "LINESTRING (0 0, 2 0)", HOLED, "MULTILINESTRING EMPTY").withColumn("shape", shape_from_wkt(F.col("geometry")))
    df = df.withColumn("line", shape_line(F.col("shape")))
    assert column(df, F.size("line")) == [6, 2, None, None]
    assert column(df, line_to_wkt(F.col("line"))) == [LINES, "LINESTRING (0.0 0.0, 2.0 0.0)", None, None]
    assert column(df, F.size(shape_rings(F.col("shape")))) == [None, None, 2, None]
    by_line, by_shape = column(df, line_centroid(F.col("line"))), column(df, shape_centroid(F.col("shape")))
    for a, b in zip(by_line[:2], by_shape[:2]):
        assert tuple(a) == pytest.approx(tuple(b))


def test_multi_line_edges_match_without_their_gap(spark):
    raw = spark.createDataFrame(
        [("1", "1", "5", "MULTILINESTRING ((8.0 50.0, 8.001 50.0), (8.01 50.0, 8.011 50.0))"), ("2", "2", "6", "LINESTRING (8.005 50.001, 8.006 50.001)"), ("3", "3", "7", "nothing")],
        "KantenId string, GrundlagenId string, Verkehrsmenge string, geometry string",
    )
    edges = traffic_volumes(raw)
    places = spark.createDataFrame([(1, 8.0105, 50.0), (2, 8.0055, 50.0), (3, 8.0005, 50.0)], "counter_id int, longitude double, latitude double")
    out = {r["counter_id"]: r["base_id"] for r in match_nearest_edge(places, edges, 500.0, ["base_id"]).collect()}
    assert out == {1: 1, 2: 2, 3: 1}  # in the gap the other edge is nearer


def test_read_units(spark):
    df = spark.createDataFrame([("010000000000", "Gemeinde", "a", HOLED), ("020000000000", "Gemeinde", "b", TWO.replace("10.", "50.").replace("11.", "51.")), ("030000000000", "Gemeinde", "c", None)], "ARS string, ADM string, GEN string, geometry string")
    units = municipalities(df)
    assert units.columns == ["ars", "name", "rings", "shape"]
    spots = spark.createDataFrame([(1, 3.0, 3.0), (2, 7.0, 7.0), (3, 50.9, 0.9), (4, 50.35, 0.25)], "k int, longitude double, latitude double")
    found = {r["k"]: r["admin_ars"] for r in join_units(spots, units, cell=1.0).collect()}
    assert found == {1: None, 2: "010000000000", 3: "020000000000", 4: None}
    areas = units.select(F.col("ars").alias("own"), "shape")
    inside = {r["own"]: r["ars"] for r in join_lines_to_units(areas, units.select("ars", "rings"), line="shape", cell=1.0).collect()}
    assert inside == {"010000000000": "010000000000", "020000000000": None, "030000000000": None}
    places = spark.createDataFrame([(450 / 84, 450 / 84)], "longitude double, latitude double")
    far = {r["own"]: r["dist_to_center_m"] for r in line_distance_to_nearest(areas, places, line="shape").collect()}
    # the centroid is that of the projected area: a square and its hole in metres
    rx, ry = (lambda v: 6378137.0 * math.radians(v)), (lambda v: 6378137.0 * math.log(math.tan(math.pi / 4 + math.radians(v) / 2)))
    boxes = [(w, rx(a), rx(b), ry(a), ry(b)) for w, a, b in ((1, 0, 10), (-1, 1, 5))]
    surface = sum(w * (x9 - x0) * (y9 - y0) for w, x0, x9, y0, y9 in boxes)
    x = sum(w * (x9 - x0) * (y9 - y0) * (x0 + x9) / 2 for w, x0, x9, y0, y9 in boxes) / surface
    y = sum(w * (x9 - x0) * (y9 - y0) * (y0 + y9) / 2 for w, x0, x9, y0, y9 in boxes) / surface
    assert far["010000000000"] == pytest.approx(math.hypot(x - rx(450 / 84), y - ry(450 / 84)), abs=1e-3)
    assert far["020000000000"] is not None and far["030000000000"] is None


def test_units_through_a_file(spark, tmp_path):
    shapes = texts(spark, HOLED, TWO, "POLYGON EMPTY").select(F.col("i").cast("string").alias("ARS"), shape_from_wkt(F.col("geometry")).alias("shape"))
    path = write_predictions(shapes, str(tmp_path / "units.csv"), "csv")
    back = read_municipalities(spark, path).orderBy("ars")
    assert [r[0] for r in back.select(shape_to_wkt(F.col("shape"))).collect()] == [HOLED, TWO, "POLYGON EMPTY"]


def test_middle_of_a_segment_is_exact(spark):
    """A point of an outline stays on it: the middle of one segment has no rounding of its own."""
    xs = [(80000 + 7 * i) / 10000 for i in range(2000)]
    rows = spark.createDataFrame([(i, x, x + 0.002) for i, x in enumerate(xs)], "i int, a double, b double")
    vertex = lambda c: F.struct(F.col(c).alias("x"), F.lit(50.0).alias("y"))
    middles = column(rows, line_centroid(F.array(vertex("a"), vertex("b"))))
    assert [m["x"] for m in middles] == [(x + (x + 0.002)) / 2 for x in xs]


def test_rectangles_weigh_as_in_sql(spark):
    """Centroid of two squares from w = dx * dy and (x0 + x9) / 2, to the last digit."""
    squares = [[((80000 + 3 * i + dx) / 10000, (508000 - 7 * i + 0) / 10000, side / 10000) for dx, side in ((0, 200), (300, 100))] for i in range(500)]
    corners = [[(x, y, x + s, y + s) for x, y, s in two] for two in squares]
    wkt = ["MULTIPOLYGON (" + ", ".join(f"(({a} {b}, {c} {b}, {c} {d}, {a} {d}, {a} {b}))" for a, b, c, d in two) + ")" for two in corners]
    want = []
    for two in corners:
        w = [(c - a) * (d - b) for a, b, c, d in two]
        want.append((sum(v * (a + c) / 2 for v, (a, _, c, _) in zip(w, two)) / sum(w), sum(v * (b + d) / 2 for v, (_, b, _, d) in zip(w, two)) / sum(w)))
    got = column(texts(spark, *wkt), shape_centroid(shape_from_wkt(F.col("geometry"))))
    assert [(g["x"], g["y"]) for g in got] == want
