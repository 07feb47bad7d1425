"""A network laid into grid cells once and stored bucketed by cell, for all distance joins against it.

Each call of a distance join in :mod:`spatial` covers the edges with cells and shuffles them. Here that is done once: the
segments are written as a table bucketed by cell, and the joins shuffle the locations only.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession, functions as F

from .spatial import CELL_SLACK, DENSE_CELL, EDGE_COLUMNS, _around, _cover, _distance, _locations, _nearest_in, _with_position, line_segments

BUCKETS = 200


@dataclass(frozen=True)
class EdgeCells:
    """Where a network's cells are stored and how they were laid."""

    table: str
    max_distance_m: float
    edge_key: str
    columns: tuple[str, ...]
    crs: str

    @property
    def size(self) -> float:
        return self.max_distance_m * CELL_SLACK

    def read(self, spark: SparkSession, limit: float) -> DataFrame:
        if limit > self.max_distance_m:
            raise ValueError(f"Cells stored for {self.max_distance_m} m do not serve a limit of {limit} m")
        return spark.table(self.table)


def store_edge_cells(
    edges: DataFrame,
    table: str,
    max_distance_m: float,
    edge_columns: Sequence[str] = EDGE_COLUMNS,
    *,
    path: str | None = None,
    buckets: int = BUCKETS,
    edge_key: str = "edge_id",
    line: str = "line",
    crs: str = "mercator",
) -> EdgeCells:
    """Write the cells of all edges, for limits up to ``max_distance_m``; one shuffle, a file per bucket.

    ``table`` replaces one of that name, in the warehouse or under ``path``. Edges without a line have no cells.
    Choose ``buckets`` so that a bucket fits a task: about the covered segments' bytes over 200 MB.
    """
    captured = tuple(c for c in edge_columns if c in edges.columns and c != edge_key)
    cells = EdgeCells(table, float(max_distance_m), edge_key, captured, crs)
    cover = _cover(line_segments(edges, [edge_key, *captured], line, crs), cells.size)
    writer = cover.repartition(buckets, "cx", "cy").write.mode("overwrite").bucketBy(buckets, "cx", "cy").sortBy("cx", "cy")
    (writer.option("path", path) if path else writer).saveAsTable(table)
    return cells


def match_nearest_stored(
    counters: DataFrame,
    cells: EdgeCells,
    max_distance_m: float = 50.0,
    *,
    lon: str = "longitude",
    lat: str = "latitude",
    distance_column: str = "nearest_edge_dist_m",
    dense: int | None = DENSE_CELL,
) -> DataFrame:
    """As :func:`spatial.match_nearest_edge`, against stored cells."""
    limit, captured = float(max_distance_m), list(cells.columns)
    located = _with_position(counters, lon, lat, cells.crs)
    keyed = cells.read(counters.sparkSession, limit).where(F.col(cells.edge_key).isNotNull())
    cover = keyed.select("x1", "y1", "x2", "y2", F.struct(cells.edge_key, *captured).alias("edge"), "cx", "cy")
    best = _nearest_in(_locations(located), cover, cells.size, limit, dense)
    found = best.select("px", "py", F.col("best.d").alias(distance_column), *[F.col(f"best.edge.{c}").alias(c) for c in captured])
    return located.drop(distance_column, *captured).join(found, ["px", "py"], "left").drop("px", "py")


def candidate_pairs_stored(
    counters: DataFrame, cells: EdgeCells, max_distance_m: float = 50.0, *, counter_key: str = "counter_id", lon: str = "longitude", lat: str = "latitude"
) -> DataFrame:
    """As :func:`spatial.candidate_pairs`, against stored cells."""
    limit = float(max_distance_m)
    located = _with_position(counters.select(counter_key, lon, lat), lon, lat, cells.crs)
    pairs = _around(_locations(located), cells.size).join(cells.read(counters.sparkSession, limit), ["cx", "cy"]).withColumn("_d", _distance())
    near = pairs.where(F.col("_d") <= limit).groupBy("px", "py", cells.edge_key, *cells.columns).agg(F.min("_d").alias("distance"))
    return located.select(counter_key, "px", "py").join(near, ["px", "py"]).drop("px", "py")
