"""Centroid clustering in whole numbers: the nearest centroid is found by a tournament of bisecting planes.

Vectors and centroids are integers, so every comparison is exact. Of two centroids a and b a vector x is nearer to b where
2 x (b - a) > |b|^2 - |a|^2: the normals b - a and the thresholds are computed once for every pair of centroids. A vector meets
the centroids in their order; after k - 1 such sign tests one is left, and only its distance is computed. Zero favours the
smaller number. The tables of a tournament hold k^2 normals and travel with the tasks; what comes back to the driver is one
sum for each centroid and component.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from veloflow.llm.common import fresh, written

SIZE = 64
CENTROIDS = 16
ROUNDS = 3
SCALE = 64
#: Whole components below this are exact in 64 bits throughout: 64 products of a doubled component and a difference.
LIMIT = 1 << 27
#: Vectors that meet the centroids at once.
CHUNK = 1 << 14


def whole_vectors(column: pa.Array, size: int = SIZE) -> tuple[np.ndarray, np.ndarray]:
    """Places of the vectors that are kept, and floor(64 x) of their components."""
    if pa.types.is_fixed_size_list(column.type):
        column = column.cast(pa.list_(column.type.value_type))
    lengths = column.value_lengths().fill_null(-1).to_numpy(zero_copy_only=False)
    at = np.flatnonzero(lengths == size)
    flat = column.take(pa.array(at)).flatten().cast(pa.float64())
    values = np.asarray(flat.fill_null(np.nan).to_numpy(zero_copy_only=False)).reshape(-1, size)
    good = np.isfinite(values).all(axis=1)
    scaled = np.floor(values[good] * SCALE)
    at, fits = at[good], (np.abs(scaled) < LIMIT).all(axis=1)
    return at[fits], scaled[fits].astype(np.int64)


class Tournament:
    """Normals and thresholds of every two centroids, numbered by their rows."""

    def __init__(self, centroids: np.ndarray):
        self.centroids = centroids
        self.normals = 2 * (centroids[None, :, :] - centroids[:, None, :])
        square = (centroids * centroids).sum(axis=1)
        self.thresholds = square[None, :] - square[:, None]

    def nearest(self, vectors: np.ndarray) -> np.ndarray:
        """The number of each vector's centroid: the champion so far meets the next one, and stays unless it is farther."""
        champion = np.zeros(len(vectors), np.int64)
        for rival in range(1, len(self.centroids)):
            sign = np.einsum("ij,ij->i", self.normals[champion, rival], vectors) - self.thresholds[champion, rival]
            champion[sign > 0] = rival
        return champion

    def distances(self, vectors: np.ndarray, to: np.ndarray) -> np.ndarray:
        gap = vectors - self.centroids[to]
        return np.einsum("ij,ij->i", gap, gap)


def first_centroids(vectors: DataFrame, key: str, embedding: str, size: int, count: int) -> np.ndarray:
    """The kept vectors whose keys have the least sha256 of ``1:key``; equal keys by components. At most ``count`` rows come back."""

    def kept(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, whole = whole_vectors(batch.column(1), size)
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at)), pa.array(list(whole), pa.list_(pa.int64()))], ["hash", "components"])

    hashed = vectors.select(F.sha2(F.concat(F.lit("1:"), F.coalesce(F.col(key).cast("string"), F.lit(""))), 256).alias("hash"), F.col(embedding).alias("v"))
    rows = hashed.mapInArrow(kept, "hash string, components array<long>").orderBy("hash", "components").limit(count).collect()
    return np.array([r["components"] for r in rows], np.int64).reshape(-1, size)


def moved(vectors: DataFrame, embedding: str, centroids: np.ndarray) -> np.ndarray:
    """The centroids after one round: floor(sum / count) of what is nearest to each; a centroid without vectors stays."""
    game, size = Tournament(centroids), centroids.shape[1]

    def sums(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total, count = np.zeros_like(centroids), np.zeros(len(centroids), np.int64)
        for batch in batches:
            _, whole = whole_vectors(batch.column(0), size)
            for low in range(0, len(whole), CHUNK):
                part = whole[low : low + CHUNK]
                to = game.nearest(part)
                np.add.at(total, to, part)
                count += np.bincount(to, minlength=len(centroids))
        number, place = np.divmod(np.arange(total.size), size)
        used = count[number] > 0
        yield pa.RecordBatch.from_arrays([pa.array(x[used]) for x in (number, place, total.ravel(), count[number])], ["cluster", "place", "total", "n"])

    parts = vectors.select(embedding).mapInArrow(sums, "cluster long, place long, total long, n long")
    wide = lambda c: F.sum(F.col(c).cast("decimal(20,0)")).alias(c)
    after = centroids.copy()
    for r in parts.groupBy("cluster", "place").agg(wide("total"), wide("n")).collect():
        after[r["cluster"], r["place"]] = int(r["total"]) // int(r["n"])
    return after


def nearest_centroids(vectors: DataFrame, centroids: np.ndarray, key: str = "vec_id", embedding: str = "embedding") -> DataFrame:
    """(key, cluster int, distance long) of each vector that is kept."""
    game, size = Tournament(centroids), centroids.shape[1]
    picked = vectors.select(key, F.col(embedding).alias(fresh(vectors, "components")))
    schema = T.StructType([picked.schema.fields[0], T.StructField("cluster", T.IntegerType()), T.StructField("distance", T.LongType())])

    def assigned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, whole = whole_vectors(batch.column(1), size)
            for low in range(0, len(whole), CHUNK):
                part = whole[low : low + CHUNK]
                to = game.nearest(part)
                yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at[low : low + CHUNK])), pa.array(to.astype(np.int32)), pa.array(game.distances(part, to))], schema.names)

    return picked.mapInArrow(assigned, schema)


def fit(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", size: int = SIZE, count: int = CENTROIDS, rounds: int = ROUNDS) -> np.ndarray:
    """Whole centroids after ``rounds`` rounds; fewer than ``count`` where fewer vectors are kept."""
    centroids = first_centroids(vectors, key, embedding, size, count)
    for _ in range(rounds if len(centroids) else 0):
        centroids = moved(vectors, embedding, centroids)
    return centroids


def digest(centroid: np.ndarray) -> str:
    import hashlib

    return hashlib.sha256(",".join(map(str, centroid.tolist())).encode()).hexdigest()


def cluster(vectors: DataFrame, key: str = "vec_id", embedding: str = "embedding", fitted: Callable[..., np.ndarray] = fit) -> DataFrame:
    """Cluster, distance and inertia of each vector.

    Columns: the key, cluster (int), distance (long, squared), cluster_inertia and inertia (long), centroid_sha256. Kept are
    vectors of exactly 64 components, none null or not finite, below 2^21 in size: beyond that a squared distance does not
    fit a long. Other rows have no row in the result, nor have empty tables. Repeated rows count each time; equal keys are
    told apart by their components where the first centroids are chosen, a null key counts as an empty text there. Of equal
    centroids the smaller number gets the vectors and the other stays empty. Inertias beyond a long are null. Other columns
    are ignored.
    """
    centroids = fitted(vectors, key, embedding)
    if not len(centroids):
        empty = vectors.select(key).limit(0)
        return empty.select(key, *(F.lit(None).cast(t).alias(c) for c, t in (("cluster", "int"), ("distance", "long"), ("cluster_inertia", "long"), ("inertia", "long"), ("centroid_sha256", "string"))))
    assigned = written(nearest_centroids(vectors, centroids, key, embedding), "assigned")
    within = {r["cluster"]: int(r["s"]) for r in assigned.groupBy("cluster").agg(F.sum(F.col("distance").cast("decimal(20,0)")).alias("s")).collect()}
    long = lambda x: x if x < 1 << 63 else None
    table = [(c, long(s), long(sum(within.values())), digest(centroids[c])) for c, s in sorted(within.items())]
    facts = vectors.sparkSession.createDataFrame(table, "cluster int, cluster_inertia long, inertia long, centroid_sha256 string")
    # one row for each centroid
    return assigned.join(F.broadcast(facts), "cluster").select(key, "cluster", "distance", "cluster_inertia", "inertia", "centroid_sha256")
