"""Map projections and planar geometry as native expressions.

A line is ``ARRAY<STRUCT<x,y>>``; a NULL vertex divides the parts of a line with several. No geometry type and no Python is involved, so all of it
stays inside generated code.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, functions as F

from .shapes import LINES, shape_from_wkt, shape_line

EARTH_RADIUS_M = 6378137.0

# GRS80 ellipsoid and transverse Mercator zone 32.
GRS80_A = 6378137.0
GRS80_F = 1 / 298.257222101
UTM_K0 = 0.9996
UTM32_MERIDIAN_DEG = 9.0
UTM_FALSE_EASTING = 500000.0


def mercator_x(lon: Column) -> Column:
    return F.lit(EARTH_RADIUS_M) * F.radians(lon)


def mercator_y(lat: Column) -> Column:
    return F.lit(EARTH_RADIUS_M) * F.log(F.tan(F.lit(math.pi / 4) + F.radians(lat) / 2))


def _krueger() -> tuple[float, float, tuple[float, ...]]:
    n = GRS80_F / (2 - GRS80_F)
    radius = GRS80_A / (1 + n) * (1 + n**2 / 4 + n**4 / 64)
    series = (
        n / 2 - 2 * n**2 / 3 + 5 * n**3 / 16,
        13 * n**2 / 48 - 3 * n**3 / 5,
        61 * n**3 / 240,
    )
    return n, radius, series


def _krueger_angles(lon: Column, lat: Column) -> tuple[Column, Column]:
    n, _, _ = _krueger()
    e = 2 * math.sqrt(n) / (1 + n)
    sin_lat = F.sin(F.radians(lat))
    t = F.sinh(F.atanh(sin_lat) - F.lit(e) * F.atanh(F.lit(e) * sin_lat))
    d_lon = F.radians(lon - F.lit(UTM32_MERIDIAN_DEG))
    return F.atan2(t, F.cos(d_lon)), F.atanh(F.sin(d_lon) / F.sqrt(F.lit(1.0) + t * t))


def utm32_x(lon: Column, lat: Column) -> Column:
    _, radius, series = _krueger()
    xi, eta = _krueger_angles(lon, lat)
    out = eta
    for j, a in enumerate(series, start=1):
        out = out + F.lit(a) * F.cos(F.lit(2.0 * j) * xi) * F.sinh(F.lit(2.0 * j) * eta)
    return F.lit(UTM_FALSE_EASTING) + F.lit(UTM_K0 * radius) * out


def utm32_y(lon: Column, lat: Column) -> Column:
    _, radius, series = _krueger()
    xi, eta = _krueger_angles(lon, lat)
    out = xi
    for j, a in enumerate(series, start=1):
        out = out + F.lit(a) * F.sin(F.lit(2.0 * j) * xi) * F.cosh(F.lit(2.0 * j) * eta)
    return F.lit(UTM_K0 * radius) * out


def project(lon: Column, lat: Column, crs: str) -> tuple[Column, Column]:
    """Planar coordinates for ``mercator`` (EPSG:3857), ``utm32`` (EPSG:25832) or ``plane``."""
    if crs == "mercator":
        return mercator_x(lon), mercator_y(lat)
    if crs == "utm32":
        return utm32_x(lon, lat), utm32_y(lon, lat)
    if crs == "plane":
        return lon.cast("double"), lat.cast("double")
    raise ValueError(f"Unknown projection {crs!r}")


def project_line(line: Column, crs: str) -> Column:
    """Project each vertex of a line given in degrees."""

    def vertex(p: Column) -> Column:
        x, y = project(p["x"], p["y"], crs)
        return F.when(p.isNotNull(), F.struct(x.alias("x"), y.alias("y")))

    return F.transform(line, vertex)


def project_shape(shape: Column, crs: str) -> Column:
    """Project each vertex of a shape given in degrees."""
    parts = F.transform(shape["parts"], lambda p: F.transform(p, lambda r: project_line(r, crs)))
    return F.when(shape.isNotNull(), F.struct(shape["kind"].alias("kind"), parts.alias("parts")))


def segment_distance(px: Column, py: Column, x1: Column, y1: Column, x2: Column, y2: Column) -> Column:
    """Distance from a point to a segment; a zero-length segment acts as a point."""
    dx, dy = x2 - x1, y2 - y1
    length2 = dx * dx + dy * dy
    along = ((px - x1) * dx + (py - y1) * dy) / F.when(length2 > 0, length2).otherwise(F.lit(1.0))
    t = F.least(F.greatest(along, F.lit(0.0)), F.lit(1.0))
    ex, ey = px - (x1 + t * dx), py - (y1 + t * dy)
    return F.sqrt(ex * ex + ey * ey)


def line_centroid(line: Column) -> Column:
    """Length-weighted mean of the segment midpoints; a line without length is its first vertex.

    Midpoints are summed as offsets from the first one, so a single segment gives its midpoint to the last digit.
    """
    n = F.size(line)
    rest = F.greatest(n - 1, F.lit(0))

    def segment(a: Column, b: Column) -> Column:
        length = F.hypot(b["x"] - a["x"], b["y"] - a["y"])
        x, y = (a["x"] + b["x"]) / 2, (a["y"] + b["y"]) / 2
        return F.when(a.isNotNull() & b.isNotNull(), F.struct(length.alias("w"), x.alias("x"), y.alias("y")))

    def add(acc: Column, s: Column) -> Column:
        first = F.when(acc["x0"].isNull(), s).otherwise(F.struct(s["w"].alias("w"), acc["x0"].alias("x"), acc["y0"].alias("y")))
        return F.struct(
            (acc["w"] + s["w"]).alias("w"),
            (acc["x"] + s["w"] * (s["x"] - first["x"])).alias("x"),
            (acc["y"] + s["w"] * (s["y"] - first["y"])).alias("y"),
            first["x"].alias("x0"),
            first["y"].alias("y0"),
        )

    def finish(acc: Column) -> Column:
        first = F.get(line, F.lit(0))
        has_length = acc["w"] > 0
        return F.struct(
            F.when(has_length, acc["x0"] + acc["x"] / acc["w"]).otherwise(first["x"]).alias("x"),
            F.when(has_length, acc["y0"] + acc["y"] / acc["w"]).otherwise(first["y"]).alias("y"),
        )

    segments = F.filter(F.zip_with(F.slice(line, 1, rest), F.slice(line, 2, rest), segment), lambda s: s.isNotNull())
    none = F.lit(None).cast("double")
    zero = F.struct(*[F.lit(0.0).alias(c) for c in ("w", "x", "y")], none.alias("x0"), none.alias("y0"))
    return F.when(n > 0, F.aggregate(segments, zero, add, finish))


def line_to_wkt(line: Column) -> Column:
    """``LINESTRING (x y, …)``, or MULTILINESTRING where there are several parts; a missing line stays NULL."""

    def vertex(p: Column) -> Column:
        return F.when(p.isNull(), F.lit("/")).otherwise(F.concat_ws(" ", p["x"].cast("string"), p["y"].cast("string")))

    points = F.concat_ws(", ", F.transform(line, vertex))
    several = F.concat(F.lit("MULTILINESTRING (("), F.replace(points, F.lit(", /, "), F.lit("), (")), F.lit("))"))
    one = F.concat(F.lit("LINESTRING ("), points, F.lit(")"))
    return F.when(line.isNotNull(), F.when(F.exists(line, lambda p: p.isNull()), several).otherwise(one))


def line_from_wkt(text: Column) -> Column:
    """Vertices of a LINESTRING or MULTILINESTRING text; anything else becomes NULL."""
    shape = shape_from_wkt(text)
    return shape_line(F.when(shape["kind"].isin(*LINES), shape))
