"""Connected components of a link table, by alternating large-star and small-star steps on DataFrames."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from veloflow.llm.common import written


def _large_star(edges: DataFrame) -> DataFrame:
    """Every node links its larger neighbours to the least of itself and its neighbours."""
    both = edges.unionAll(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
    least = both.groupBy("u").agg(F.least(F.min("v"), F.col("u")).alias("m"))
    return both.filter("v > u").join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v").distinct()


def _small_star(edges: DataFrame) -> DataFrame:
    """Every node links itself and its smaller neighbours to the least of these. Edges run from larger u to smaller v."""
    least = edges.groupBy("u").agg(F.min("v").alias("m"))
    inner = edges.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).filter("u <> v")
    return inner.unionAll(least.select("u", F.col("m").alias("v"))).distinct()


def components(links: DataFrame, left: str, right: str) -> DataFrame:
    """(node, root) for each node of a link, root being the least node that can be reached.

    Each round writes the edges to the shared folder, so lineage stays short and lost executors lose nothing. Rounds grow
    with the logarithm of the longest path. A node with many links is reduced by partial aggregation; the joins are between
    an edge table and one row per node, which adaptive execution splits where a node is hot. Links with a null end are
    left out; repeated links and links to oneself change nothing. No links give no rows.
    """
    ends = links.select(F.col(left).alias("a"), F.col(right).alias("b")).filter("a <> b")
    edges = written(ends.select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct(), "edges")
    before = None
    while True:
        now = edges.agg(F.count(F.lit(1)).alias("n"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)")).alias("s")).first()
        if now["n"] == 0 or (now["n"], now["s"]) == before:
            break
        before = (now["n"], now["s"])
        edges = written(_small_star(_large_star(edges)), "edges")
    nodes = edges.select(F.col("u").alias("node"), F.col("v").alias("root"))
    return nodes.unionAll(edges.select(F.col("v").alias("node"), F.col("v").alias("root")).distinct())
