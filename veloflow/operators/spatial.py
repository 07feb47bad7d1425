"""Distance and containment joins as equi-joins on grid cells.

A distance predicate alone plans as a nested loop over both tables. Here each segment is laid
into the cells it runs through, each location looks at its own cell and the eight around it, and
the exact distance is computed for those pairs only. Nothing is missed: a segment within one
cell size of a location passes through one of these nine cells.

Skew: equal locations are joined once, equal segments are joined once where only the nearest
counts, and where a cell still holds many segments its surroundings are solved on a grid of a
quarter of the size first, again and again; only locations with nothing that near come back.
"""

from __future__ import annotations

import math
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window, functions as F, types as T

from ..functions.geo import line_centroid, project, project_line, project_shape, segment_distance
from ..functions.shapes import shape_centroid
from ..session import cut_lineage, reuse

EDGE_COLUMNS = ("base_id", "count", "bicycle_infrastructure")
CELL_SLACK = 1 + 1e-9  # keeps a pair at exactly the limit inside the nine cells
DENSE_CELL = 512  # segments in a cell above which a finer grid pays
MAX_REFINEMENTS = 6


def _floor_cell(c: Column, size: float) -> Column:
    return F.floor(c / F.lit(float(size)))


def _around(df: DataFrame, size: float, x: str = "px", y: str = "py", steps: int = 1) -> DataFrame:
    """One row per cell of the block around each location (columns ``cx``, ``cy``)."""
    offsets = F.array(*[F.lit(i) for i in range(-steps, steps + 1)])
    return (
        df.withColumns({"_i": _floor_cell(F.col(x), size), "_j": _floor_cell(F.col(y), size)})
        .withColumn("_di", F.explode(offsets))
        .withColumn("_dj", F.explode(offsets))
        .withColumns({"cx": F.col("_i") + F.col("_di"), "cy": F.col("_j") + F.col("_dj")})
        .drop("_i", "_j", "_di", "_dj")
    )


def _cover(segments: DataFrame, size: float) -> DataFrame:
    """One row per cell a segment runs through.

    The segment is walked in pieces no longer than a cell, so the number of cells grows with its
    length, not with the area of its bounding box. Pieces are rows, so all of it is generated code;
    a piece leaves out the cells of the piece before it.
    """
    x1, y1, x2, y2 = (F.col(c) for c in ("x1", "y1", "x2", "y2"))
    steps = F.greatest(F.ceil(F.sqrt((x2 - x1) * (x2 - x1) + (y2 - y1) * (y2 - y1)) / F.lit(float(size))), F.lit(1))
    walked = segments.withColumn("_n", steps).withColumn("_k", F.explode(F.sequence(F.lit(0).cast("long"), F.col("_n") - 1)))

    def at(k: Column, a: Column, b: Column) -> Column:
        return _floor_cell(F.when(k >= F.col("_n"), b).otherwise(a + (b - a) * (k / F.col("_n"))), size)

    k = F.col("_k")
    ends = {f"_{c}{i}": at(k + i - 1, a, b) for c, a, b in (("x", x1, x2), ("y", y1, y2)) for i in range(3)}

    def span(c: str, i: int) -> tuple[Column, Column]:
        return F.least(f"_{c}{i}", f"_{c}{i + 1}"), F.greatest(f"_{c}{i}", f"_{c}{i + 1}")

    cells = walked.withColumns(ends).withColumn("cx", F.explode(F.sequence(*span("x", 1)))).withColumn("cy", F.explode(F.sequence(*span("y", 1))))
    seen = (k > 0) & F.col("cx").between(*span("x", 0)) & F.col("cy").between(*span("y", 0))
    return cells.where(~seen).select(*segments.columns, "cx", "cy")


def line_segments(edges: DataFrame, columns: Sequence[str], line: str = "line", crs: str = "mercator") -> DataFrame:
    """One row per segment of each line, projected; a single vertex gives a zero-length segment. Parts stay apart."""
    v = F.col(line)
    n = F.size(v)
    # a segment per pair of neighbours; a lone vertex pairs with itself
    starts, ends = F.slice(v, 1, F.greatest(n - 1, F.lit(1))), F.slice(v, F.least(n, F.lit(2)), F.greatest(n - 1, F.lit(1)))
    pairs = F.zip_with(starts, ends, lambda a, b: F.struct(a.alias("a"), b.alias("b")))
    pairs = F.filter(pairs, lambda s: s["a"].isNotNull() & s["b"].isNotNull())
    rows = edges.where(n > 0).select(*columns, F.explode(pairs).alias("_s"))
    x1, y1 = project(F.col("_s.a.x"), F.col("_s.a.y"), crs)
    x2, y2 = project(F.col("_s.b.x"), F.col("_s.b.y"), crs)
    return rows.select(*columns, x1.alias("x1"), y1.alias("y1"), x2.alias("x2"), y2.alias("y2"))


def _with_position(df: DataFrame, lon: str, lat: str, crs: str) -> DataFrame:
    x, y = project(F.col(lon), F.col(lat), crs)
    return df.withColumns({"px": x, "py": y})


def _with_point(df: DataFrame, point: Column, x: str, y: str) -> DataFrame:
    """Add the coordinates of a computed point.

    A generator row keeps the optimizer from copying the computation into each later use.
    """
    return df.select("*", F.inline(F.array(point)).alias(x, y))


def _centroid(df: DataFrame, name: str, crs: str = "plane") -> Column:
    """Centroid of a column of lines or of shapes."""
    if isinstance(df.schema[name].dataType, T.StructType):
        return shape_centroid(project_shape(F.col(name), crs))
    return line_centroid(project_line(F.col(name), crs))


def _locations(df: DataFrame) -> DataFrame:
    return df.select("px", "py").where("px is not null and py is not null").distinct()


def _distance() -> Column:
    return segment_distance(*(F.col(c) for c in ("px", "py", "x1", "y1", "x2", "y2")))


def _nearest(points: DataFrame, segments: DataFrame, limit: float, dense: int | None, depth: int = 0) -> DataFrame:
    """``(px, py, best)`` with ``best`` the smallest ``(distance, edge)`` within the limit."""
    size = limit * CELL_SLACK
    return _nearest_in(points, _cover(segments, size), size, limit, dense, depth)


def _nearest_in(points: DataFrame, cover: DataFrame, size: float, limit: float, dense: int | None, depth: int = 0) -> DataFrame:
    """As :func:`_nearest`, for segments laid into cells of ``size``, which is not below the limit."""
    resolved = None
    if dense is not None and depth < MAX_REFINEMENTS:
        # few locations are seen to be few, so that the cells of all segments need no shuffle
        points = reuse(points)
        points.count()
        occupied = points.select(_floor_cell(F.col("px"), size).alias("cx"), _floor_cell(F.col("py"), size).alias("cy")).distinct()
        hot = cover.join(_block(occupied, 1), ["cx", "cy"], "left_semi").groupBy("cx", "cy").agg(F.count("*").alias("n")).where(F.col("n") > dense).select("cx", "cy")
        hot = reuse(hot)
        if hot.isEmpty():
            hot.unpersist()
        else:
            near, far = _block(hot, 1), _block(hot, 2)
            own = points.withColumns({"cx": _floor_cell(F.col("px"), size), "cy": _floor_cell(F.col("py"), size)})
            crowded = own.join(near, ["cx", "cy"], "left_semi").select("px", "py")
            around = cover.join(far, ["cx", "cy"], "left_semi").drop("cx", "cy").distinct()
            resolved = cut_lineage(_nearest(crowded, reuse(around), limit / 4, dense, depth + 1))
            points = points.join(resolved, ["px", "py"], "left_anti")
    pairs = _around(points, size).join(cover, ["cx", "cy"]).withColumn("_d", _distance())
    best = pairs.where(F.col("_d") <= limit).groupBy("px", "py").agg(F.min(F.struct(F.col("_d").alias("d"), "edge")).alias("best"))
    return best if resolved is None else best.unionByName(resolved)


def _block(cells: DataFrame, steps: int) -> DataFrame:
    offsets = F.array(*[F.lit(i) for i in range(-steps, steps + 1)])
    spread = cells.withColumn("_di", F.explode(offsets)).withColumn("_dj", F.explode(offsets))
    return spread.select((F.col("cx") + F.col("_di")).alias("cx"), (F.col("cy") + F.col("_dj")).alias("cy")).distinct()


def match_nearest_edge(
    counters: DataFrame,
    edges: DataFrame,
    max_distance_m: float = 50.0,
    edge_columns: Sequence[str] = EDGE_COLUMNS,
    *,
    edge_key: str = "edge_id",
    lon: str = "longitude",
    lat: str = "latitude",
    line: str = "line",
    crs: str = "mercator",
    distance_column: str = "nearest_edge_dist_m",
    dense: int | None = DENSE_CELL,
) -> DataFrame:
    """Each counter once, with its nearest edge within the limit and that edge's columns.

    Equal distances go to the smaller edge key. Counters without an edge or a position get NULL.
    """
    captured = [c for c in edge_columns if c in edges.columns and c != edge_key]
    located = _with_position(counters, lon, lat, crs)
    segments = line_segments(edges.where(F.col(edge_key).isNotNull()), [edge_key, *captured], line, crs)
    # copies of a segment differ in the edge only, the smallest one wins any tie
    edge = F.struct(F.col(edge_key), *[F.col(c) for c in captured])
    unique = segments.groupBy("x1", "y1", "x2", "y2").agg(F.min(edge).alias("edge"))
    best = _nearest(_locations(located), unique if dense is None else reuse(unique), float(max_distance_m), dense)
    found = best.select(
        "px", "py", F.col("best.d").alias(distance_column), *[F.col(f"best.edge.{c}").alias(c) for c in captured]
    )
    base = located.drop(distance_column, *captured)
    return base.join(found, ["px", "py"], "left").drop("px", "py")


def candidate_pairs(
    counters: DataFrame,
    edges: DataFrame,
    max_distance_m: float = 50.0,
    edge_columns: Sequence[str] = EDGE_COLUMNS,
    *,
    counter_key: str = "counter_id",
    edge_key: str = "edge_id",
    lon: str = "longitude",
    lat: str = "latitude",
    line: str = "line",
    crs: str = "mercator",
) -> DataFrame:
    """One row per counter and edge within the limit, with the distance."""
    captured = [c for c in edge_columns if c in edges.columns and c != edge_key]
    located = _with_position(counters.select(counter_key, lon, lat), lon, lat, crs)
    segments = line_segments(edges, [edge_key, *captured], line, crs)
    size = float(max_distance_m) * CELL_SLACK
    pairs = _around(_locations(located), size).join(_cover(segments, size), ["cx", "cy"]).withColumn("_d", _distance())
    near = (
        pairs.where(F.col("_d") <= float(max_distance_m))
        .groupBy("px", "py", edge_key, *captured)
        .agg(F.min("_d").alias("distance"))
    )
    return located.select(counter_key, "px", "py").join(near, ["px", "py"]).drop("px", "py")


def nearest_pairs(
    counters: DataFrame,
    edges: DataFrame,
    max_distance_m: float = 50.0,
    count: int = 2,
    *,
    counter_key: str = "counter_id",
    edge_key: str = "edge_id",
    lon: str = "longitude",
    lat: str = "latitude",
    line: str = "line",
    crs: str = "mercator",
) -> DataFrame:
    """The rows of :func:`candidate_pairs` with the ``count`` nearest edges of each counter, smaller keys first where distances are equal.

    They are picked per location, so counters that share one do not multiply the edges around it.
    """
    located = _with_position(counters.select(counter_key, lon, lat), lon, lat, crs)
    points = reuse(_locations(located))
    points.count()  # few locations are seen to be few, so that the cells of all segments need no shuffle
    limit = float(max_distance_m)
    size = limit * CELL_SLACK
    pairs = _around(points, size).join(_cover(line_segments(edges, [edge_key], line, crs), size), ["cx", "cy"]).withColumn("_d", _distance())
    near = pairs.where(F.col("_d") <= limit).groupBy("px", "py", edge_key).agg(F.min("_d").alias("distance"))
    place = F.row_number().over(Window.partitionBy("px", "py").orderBy("distance", edge_key))
    first = near.withColumn("_place", place).where(F.col("_place") <= count).drop("_place")
    return located.select(counter_key, "px", "py").join(first, ["px", "py"]).drop("px", "py")


def find_candidate_edges(
    counters: DataFrame,
    edges: DataFrame,
    max_distance_m: float = 50.0,
    edge_columns: Sequence[str] = EDGE_COLUMNS,
    *,
    counter_key: str = "counter_id",
    edge_key: str = "edge_id",
    lon: str = "longitude",
    lat: str = "latitude",
    **kwargs,
) -> DataFrame:
    """Counters with ``candidate_edges``, nearest first; empty without a hit, NULL without a position.

    The list of a counter is part of the result by definition; :func:`candidate_pairs` gives the
    same pairs as rows.
    """
    pairs = candidate_pairs(
        counters, edges, max_distance_m, edge_columns, counter_key=counter_key, edge_key=edge_key, lon=lon, lat=lat, **kwargs
    )
    captured = [c for c in edge_columns if c in edges.columns and c != edge_key]
    entry = F.struct("distance", edge_key, *captured)
    lists = pairs.groupBy(counter_key).agg(F.array_sort(F.collect_list(entry)).alias("candidate_edges"))
    kind = lists.schema["candidate_edges"].dataType.simpleString()
    joined = counters.drop("candidate_edges").join(lists, counter_key, "left")
    has_position = F.col(lon).isNotNull() & F.col(lat).isNotNull()
    none = F.when(has_position, F.array().cast(kind))
    return joined.withColumn("candidate_edges", F.coalesce("candidate_edges", none))


def edges_near_counters(
    edges: DataFrame,
    counters: DataFrame,
    buffer_m: float = 250.0,
    no_volume_buffer_m: float = 1000.0,
    only_flagged: bool = True,
    *,
    edge_key: str = "edge_id",
    lon: str = "longitude",
    lat: str = "latitude",
    line: str = "line",
    crs: str = "mercator",
) -> DataFrame:
    """Edges inside the buffer of a flagged or checked counter (of any counter if none is)."""
    flagged = counters
    if only_flagged:
        test = F.lit(False)
        if "is_outlier" in counters.columns:
            test = test | F.coalesce(F.col("is_outlier"), F.lit(False))
        if "flag_severity" in counters.columns:
            test = test | ~F.col("flag_severity").eqNullSafe("ok")
        if "verification_status" in counters.columns:
            test = test | F.coalesce(F.col("verification_status").isin("verified", "carryover"), F.lit(False))
        flagged = counters.where(test)
        if flagged.isEmpty():
            flagged = counters
    radius = F.lit(float(buffer_m))
    if "flag_severity" in counters.columns:
        radius = F.when(F.col("flag_severity") == "no_volume", float(no_volume_buffer_m)).otherwise(radius)
    spots = (
        _with_position(flagged, lon, lat, crs)
        .where("px is not null and py is not null")
        .groupBy("px", "py")
        .agg(F.max(radius).alias("radius"))
    )
    size = max(buffer_m, no_volume_buffer_m) * CELL_SLACK
    cover = _cover(line_segments(edges, [edge_key], line, crs), size).alias("s")
    spots = _around(spots, size).alias("p")
    near = (F.col("s.cx") == F.col("p.cx")) & (F.col("s.cy") == F.col("p.cy")) & (_distance() <= F.col("radius"))
    hits = cover.join(spots, near, "left_semi").select(edge_key).distinct()
    return edges.join(hits, edge_key, "left_semi")


# --- nearest place, no distance limit --------------------------------------------------------

TREE_FANOUT = 4  # children per side of a tree box
LEAF_PLACES = 64
MAX_TREE_DEPTH = 12
SMALL_TREE_LEVELS = 3  # at most 16 + 256 + 4096 boxes in all


def distance_to_nearest(
    df: DataFrame,
    centroids: DataFrame,
    *,
    lon: str = "longitude",
    lat: str = "latitude",
    output: str = "dist_to_center_m",
    crs: str = "mercator",
) -> DataFrame:
    """Distance to the nearest centroid, however far.

    Work is done per occupied grid cell, not per row. The centroids are boxed at several levels;
    from the top, each cell keeps the boxes that can hold the nearest centroid of some location
    in it and opens only those. Rows then meet the few centroids left for their cell.
    """
    located = _with_position(df, lon, lat, crs)
    places = _locations(_with_position(centroids.select(lon, lat), lon, lat, crs))
    places = reuse(places.select(F.col("px").alias("qx"), F.col("py").alias("qy")))
    box = places.agg(
        F.count("*").alias("n"),
        F.min("qx").alias("x0"), F.max("qx").alias("x9"), F.min("qy").alias("y0"), F.max("qy").alias("y9"),
    ).first()
    base = located.drop(output)
    if not box["n"]:
        return base.drop("px", "py").withColumn(output, F.lit(None).cast("double"))
    root = max(box["x9"] - box["x0"], box["y9"] - box["y0"], 1.0) * CELL_SLACK
    places = places.withColumns({"ux": F.col("qx") - box["x0"], "uy": F.col("qy") - box["y0"]})
    depth = _tree_depth(places, root, box["n"])
    points = _locations(located).withColumns({"ux": F.col("px") - box["x0"], "uy": F.col("py") - box["y0"]})
    nearest = _nearest_place(points, places, root, depth)
    return base.join(nearest.withColumnRenamed("d", output), ["px", "py"], "left").drop("px", "py")


def _tree_depth(places: DataFrame, root: float, n: int) -> int:
    """Levels until no box holds many places; each try is one small count over the places."""
    depth = max(1, math.ceil(math.log(max(n / LEAF_PLACES, 1.0), TREE_FANOUT**2)))
    while depth < MAX_TREE_DEPTH:
        size = root / TREE_FANOUT**depth
        fullest = places.groupBy(_floor_cell(F.col("ux"), size), _floor_cell(F.col("uy"), size)).count()
        if fullest.agg(F.max("count")).first()[0] <= LEAF_PLACES:
            return depth
        depth += 1
    return depth


def _box_range(lo1: Column, hi1: Column, lo2: Column, hi2: Column) -> tuple[Column, Column]:
    """Smallest and largest distance along one axis between two intervals."""
    gap = F.greatest(lo1 - hi2, lo2 - hi1, F.lit(0.0))
    return gap, F.greatest(hi1 - lo2, hi2 - lo1)


def _nearest_place(points: DataFrame, places: DataFrame, root: float, depth: int) -> DataFrame:
    leaf = root / TREE_FANOUT**depth
    own = points.withColumns({"ci": _floor_cell(F.col("ux"), leaf), "cj": _floor_cell(F.col("uy"), leaf)})
    bounds = [f(c).alias(a) for f, c, a in ((F.min, "px", "ax"), (F.max, "px", "bx"), (F.min, "py", "ay"), (F.max, "py", "by"))]
    opened = own.groupBy("ci", "cj").agg(*bounds)
    kept = ("ci", "cj", "ax", "bx", "ay", "by")
    for level in range(1, depth + 2):
        if level <= depth:
            size = root / TREE_FANOUT**level
            boxes = places.groupBy(_floor_cell(F.col("ux"), size).alias("kx"), _floor_cell(F.col("uy"), size).alias("ky")).agg(
                F.min("qx").alias("qx0"), F.max("qx").alias("qx9"), F.min("qy").alias("qy0"), F.max("qy").alias("qy9")
            )
            parent = (F.floor(F.col("kx") / TREE_FANOUT), F.floor(F.col("ky") / TREE_FANOUT))
        else:
            # the places themselves, as boxes without extent
            boxes = places.select(
                *[_floor_cell(F.col(u), leaf).alias(k) for u, k in (("ux", "kx"), ("uy", "ky"))],
                *[F.col(q).alias(f"{q}{e}") for q in ("qx", "qy") for e in ("0", "9")],
            )
            parent = (F.col("kx"), F.col("ky"))
        boxes = boxes.withColumns({"nx": parent[0], "ny": parent[1]})
        if level == 1:
            # below the root there are at most 16 boxes, they travel as one literal
            fields = ("kx", "ky", "qx0", "qx9", "qy0", "qy9")
            top = boxes.agg(F.collect_list(F.struct(*fields))).scalar()
            opened = opened.select(*kept, F.inline(top).alias(*fields))
        else:
            # the next two levels have at most 256 and 4096 boxes by construction
            children = F.broadcast(boxes) if level <= min(depth, SMALL_TREE_LEVELS) else boxes
            opened = opened.select(*kept, "nx", "ny").join(children, ["nx", "ny"])
        gap_x, reach_x = _box_range(*(F.col(c) for c in ("ax", "bx", "qx0", "qx9")))
        gap_y, reach_y = _box_range(*(F.col(c) for c in ("ay", "by", "qy0", "qy9")))
        pairs = opened.select(
            *kept,
            F.col("kx").alias("nx"),
            F.col("ky").alias("ny"),
            "qx0",
            "qy0",
            F.sqrt(gap_x * gap_x + gap_y * gap_y).alias("near"),
            F.sqrt(reach_x * reach_x + reach_y * reach_y).alias("far"),
        )
        # a box that starts beyond the far end of another cannot hold the nearest place
        limit = F.min("far").over(Window.partitionBy("ci", "cj")) * CELL_SLACK
        opened = pairs.withColumn("_limit", limit).where(F.col("near") <= F.col("_limit")).drop("_limit")
    options = opened.select("ci", "cj", F.col("qx0").alias("qx"), F.col("qy0").alias("qy"))
    dx, dy = F.col("px") - F.col("qx"), F.col("py") - F.col("qy")
    return own.join(options, ["ci", "cj"]).groupBy("px", "py").agg(F.min(F.sqrt(dx * dx + dy * dy)).alias("d"))


# --- containment -----------------------------------------------------------------------------


def ring_edges(units: DataFrame, key: str = "ars", rings: str = "rings") -> DataFrame:
    """Boundary pieces of each unit; open rings are closed. Holes and parts are just more rings."""

    def closed(ring: Column) -> Column:
        return F.transform(
            F.sequence(F.lit(0), F.size(ring) - 1),
            lambda i: F.struct(
                F.get(ring, i).alias("a"), F.get(ring, F.when(i + 1 < F.size(ring), i + 1).otherwise(F.lit(0))).alias("b")
            ),
        )

    exploded = units.select(F.col(key).alias("unit"), F.explode(rings).alias("_r")).where(F.size("_r") > 1)
    return exploded.select("unit", F.explode(closed(F.col("_r"))).alias("_e")).select(
        "unit",
        F.col("_e.a.x").alias("x1"),
        F.col("_e.a.y").alias("y1"),
        F.col("_e.b.x").alias("x2"),
        F.col("_e.b.y").alias("y2"),
    )


def points_in_units(
    points: DataFrame, units: DataFrame, *, key: str = "ars", rings: str = "rings", boundary: bool, cell: float = 0.1
) -> DataFrame:
    """``(px, py, unit)`` for locations inside a unit; ``boundary`` decides about its outline.

    Bounding boxes give candidate units per grid cell. A candidate is tested by counting how
    many outline pieces a ray to the east crosses, reading only the pieces in the same strip of
    latitude: the work per location does not grow with the length of the outline.
    """
    outline = ring_edges(units, key, rings)
    box = outline.groupBy("unit").agg(
        F.min(F.least("x1", "x2")).alias("x0"),
        F.max(F.greatest("x1", "x2")).alias("x9"),
        F.min(F.least("y1", "y2")).alias("y0"),
        F.max(F.greatest("y1", "y2")).alias("y9"),
    )
    boxes = (
        box.withColumn("cx", F.explode(F.sequence(_floor_cell(F.col("x0"), cell), _floor_cell(F.col("x9"), cell))))
        .withColumn("cy", F.explode(F.sequence(_floor_cell(F.col("y0"), cell), _floor_cell(F.col("y9"), cell))))
    )
    own = points.withColumns({"cx": _floor_cell(F.col("px"), cell), "cy": _floor_cell(F.col("py"), cell)})
    inside_box = F.col("px").between(F.col("x0"), F.col("x9")) & F.col("py").between(F.col("y0"), F.col("y9"))
    candidates = own.join(boxes, ["cx", "cy"]).where(inside_box).select("px", "py", "unit", F.col("cy").alias("strip"))

    low, high = F.least("y1", "y2"), F.greatest("y1", "y2")
    strips = outline.withColumn("strip", F.explode(F.sequence(_floor_cell(low, cell), _floor_cell(high, cell))))
    px, py, x1, y1, x2, y2 = (F.col(c) for c in ("px", "py", "x1", "y1", "x2", "y2"))
    at_x = x1 + (py - y1) * (x2 - x1) / F.when(y1 != y2, y2 - y1).otherwise(F.lit(1.0))
    crosses = ((y1 <= py) != (y2 <= py)) & (px < at_x)
    cross = (x2 - x1) * (py - y1) - (y2 - y1) * (px - x1)
    touches = (cross == 0) & px.between(F.least("x1", "x2"), F.greatest("x1", "x2")) & py.between(low, high)
    tested = (
        candidates.join(strips, ["unit", "strip"])
        .where(py.between(low, high))
        .groupBy("px", "py", "unit")
        .agg(F.count_if(crosses).alias("n"), F.coalesce(F.max(touches), F.lit(False)).alias("on"))
    )
    odd = F.col("n") % 2 == 1
    keep = (odd | F.col("on")) if boundary else (odd & ~F.col("on"))
    return tested.where(keep).select("px", "py", "unit")


def _join_first_unit(located: DataFrame, units: DataFrame, key: str, rings: str, columns: Sequence[str], boundary: bool, cell: float) -> DataFrame:
    """One unit per location. A key may have several outlines (exclaves, land and water); each is tested by itself and the
    attributes are those of the outline that holds the location. Of several the smallest key counts, then the smallest hash."""
    own = units.select(key, rings, *[c for c in columns if c != key])
    own = own.withColumn("_outline", F.xxhash64(*own.columns)).dropDuplicates(["_outline"])
    hits = points_in_units(_locations(located), own, key="_outline", rings=rings, boundary=boundary, cell=cell)
    attrs = own.select(F.col("_outline").alias("unit"), F.col(key).alias("_key"), *columns)
    keyed = hits.join(attrs.select("unit", "_key"), "unit")
    first = keyed.groupBy("px", "py").agg(F.min(F.struct("_key", "unit")).alias("_first")).select("px", "py", F.col("_first.unit").alias("unit"))
    first = first.join(attrs, "unit").drop("unit").withColumnRenamed("_key", "unit")
    return located.join(first, ["px", "py"], "left").drop("px", "py")


def join_units(
    df: DataFrame,
    units: DataFrame,
    *,
    key: str = "ars",
    output_key: str = "admin_ars",
    columns: Sequence[str] = (),
    rings: str = "rings",
    lon: str = "longitude",
    lat: str = "latitude",
    boundary: bool = True,
    how: str = "left",
    cell: float = 0.1,
) -> DataFrame:
    """Rows with the unit that holds their position; on a shared outline the smallest key counts."""
    located = _with_position(df.drop(*columns), lon, lat, "plane")
    out = _join_first_unit(located, units, key, rings, columns, boundary, cell).withColumnRenamed("unit", output_key)
    return out if how == "left" else out.where(F.col(output_key).isNotNull())


def join_lines_to_units(
    edges: DataFrame,
    units: DataFrame,
    *,
    key: str = "ars",
    output_key: str = "ars",
    columns: Sequence[str] = (),
    rings: str = "rings",
    line: str = "line",
    how: str = "left",
    cell: float = 0.1,
) -> DataFrame:
    """Edges, or areas given as shapes, with the unit their centroid lies within (outline excluded)."""
    located = _with_point(edges.drop(*columns), _centroid(edges, line), "px", "py")
    out = _join_first_unit(located, units, key, rings, columns, False, cell).withColumnRenamed("unit", output_key)
    return out if how == "left" else out.where(F.col(output_key).isNotNull())


def line_distance_to_nearest(edges: DataFrame, centroids: DataFrame, *, line: str = "line", **kwargs) -> DataFrame:
    """Distance from the projected centroid of each line, or area given as a shape, to the nearest place."""
    middle = _centroid(edges, line, "mercator")
    places = _with_position(centroids, kwargs.pop("lon", "longitude"), kwargs.pop("lat", "latitude"), "mercator")
    placed = _with_point(edges, middle, "_mx", "_my")
    targets = places.select(F.col("px").alias("_mx"), F.col("py").alias("_my"))
    return distance_to_nearest(placed, targets, lon="_mx", lat="_my", crs="plane", **kwargs).drop("_mx", "_my")
