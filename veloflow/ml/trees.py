"""Regression trees grown level by level from histograms, and what is built of them: forests, stopped boosting, AdaBoost.R2.

Rows carry their features as an array and, for each feature, the number of cut points below it; AdaBoost, which reads them in
every round, packs many into a row of bytes. For each level the tasks count
rows, weights and weighted targets by (tree, node, feature, bin) with numpy and Spark adds their counts; running sums over bins give every split's gain in Spark, and
one row per node comes back to the driver. A grown tree is a SQL expression over the feature array, so rows never hold a
place in a tree: it is computed where it is needed. Cut points are all values of a feature with few of them, else quantiles.
"""

from __future__ import annotations

import json
import math
import random
import sys
from bisect import bisect_left
from collections.abc import Callable, Iterator, Sequence
from dataclasses import dataclass, field

import numpy as np
import pyarrow as pa
from pyspark import cloudpickle, keyword_only
from pyspark.ml.base import Estimator, Model
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import DenseVector
from pyspark.ml.param import Param, Params, TypeConverters
from pyspark.ml.param.shared import HasFeaturesCol, HasLabelCol, HasPredictionCol
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..functions.order_stats import few_group_medians, grouped_quantiles, quantiles
from ..session import cut_lineage, reuse, scratch_path

# what tasks call from here travels with them, so executors need no copy of the library
cloudpickle.register_pickle_by_value(sys.modules[__name__])

#: Rounds after which the running prediction is written out, so that plans stay short.
CUT_EVERY = 8
LEAST_GAIN = 1e-9
#: Sums a task holds at most while it counts rows by node, feature and bin.
SUMS_IN_TASK = 1 << 21
#: Leaves whose medians are found by counts on the driver.
FEW_LEAVES = 64
#: Rows that lie together in a row of a packed table.
PACKED_ROWS = 1 << 16

#: Reads a batch as bins by feature and row, targets, and weights by tree and row.
Reader = Callable[[pa.RecordBatch], Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]]


@dataclass
class Tree:
    """Splits by node: 1 is the root, ``2 n`` holds rows with a feature of at most the threshold, ``2 n + 1`` the others."""

    splits: dict[int, tuple[int, float]] = field(default_factory=dict)
    gains: dict[int, float] = field(default_factory=dict)
    values: dict[int, float] = field(default_factory=dict)

    def _sql(self, leaf: Callable[[int], str], node: int = 1) -> str:
        if node not in self.splits:
            return leaf(node)
        feature, threshold = self.splits[node]
        return f"CASE WHEN _x[{feature}] <= {threshold!r}D THEN {self._sql(leaf, 2 * node)} ELSE {self._sql(leaf, 2 * node + 1)} END"

    def place(self) -> str:
        """SQL of the leaf a row ends in."""
        return self._sql(str)

    def value(self) -> str:
        """SQL of the value of that leaf; a leaf that no row reached while fitting counts as zero."""
        return self._sql(lambda n: f"{self.values.get(n, 0.0)!r}D")

    def to_dict(self) -> dict:
        return {"splits": [[n, f, t] for n, (f, t) in self.splits.items()], "gains": list(self.gains.items()), "values": list(self.values.items())}

    @classmethod
    def from_dict(cls, d: dict) -> Tree:
        return cls({n: (f, t) for n, f, t in d["splits"]}, dict(map(tuple, d["gains"])), dict(map(tuple, d["values"])))


def cut_points(rows: DataFrame, size: int, bins: int = 32) -> list[list[float]]:
    """For each feature of the array ``_x`` its cut points, ascending: its values if at most ``bins``, else that many quantiles."""
    cuts = []
    for f in range(size):
        value = F.col("_x")[f]
        few = rows.select(value.alias("v")).where("v is not null").distinct().limit(bins + 1).collect()
        if len(few) <= bins:
            cuts.append(sorted(r["v"] for r in few))
        else:
            found = quantiles(rows, value, {str(i): i / bins for i in range(1, bins)})
            cuts.append(sorted({found[str(i)] for i in range(1, bins)}))
    return cuts


def binned(rows: DataFrame, cuts: list[list[float]]) -> DataFrame:
    """Adds ``_b``: for each feature the number of cut points below it."""
    def below(feature: int) -> Column:
        return F.size(F.filter(F.array(*map(F.lit, cuts[feature])).cast("array<double>"), lambda t: t < F.col("_x")[feature]))

    return rows.withColumn("_b", F.array(*map(below, range(len(cuts)))))


def _impurity_drop(criterion: str) -> Column:
    """Gain of a split from weights and weighted targets left (lw, ls) and in all (w, s); NULL where it is not allowed."""
    rw, rs = F.col("w") - F.col("lw"), F.col("s") - F.col("ls")
    if criterion == "squared_error":
        return F.col("ls") ** 2 / F.col("lw") + rs**2 / rw - F.col("s") ** 2 / F.col("w")
    if criterion == "poisson":
        part = lambda s, w: s * F.log(s / w)
        return F.when((F.col("ls") > 0) & (rs > 0), part(F.col("ls"), F.col("lw")) + part(rs, rw) - part(F.col("s"), F.col("w")))
    raise ValueError(f"Unknown criterion {criterion!r}")


def grow(
    rows: DataFrame,
    cuts: list[list[float]],
    *,
    trees: int = 1,
    target: Column | None = None,
    weights: Sequence[Column] | None = None,
    criterion: str = "squared_error",
    max_depth: int = 3,
    min_leaf: int = 1,
    min_split: int = 2,
    pick: Callable[[int, int], Sequence[int]] | None = None,
    read: Reader | None = None,
) -> list[Tree]:
    """Grow trees side by side on ``rows`` (``_x``, ``_b``), one aggregate per level for all of them; leaves hold weighted means.

    A row takes part in a tree where its weight is above 0. ``pick`` names the features that a node of a tree may split on.
    With ``read`` the rows are of any form that it reads, and targets and weights are what it gives.
    Of gains equal to six digits, as sums differ in their last ones, the first feature and the lowest threshold win. The driver holds one row for each node of a level.
    """
    grown = [Tree() for _ in range(trees)]
    weights = weights or [F.lit(1.0)] * trees
    data = rows if read else rows.select("_b", (target if target is not None else F.col("_y")).cast("double").alias("_g"), F.array(*weights).cast("array<double>").alias("_w"))
    read = read or _column_reader(len(cuts), trees)

    for depth in range(max_depth):
        ends = [(t, n) for t, tree in enumerate(grown) for n in ([1] if depth == 0 else [c for p in tree.splits for c in (2 * p, 2 * p + 1)]) if n >= 1 << depth]
        if not ends:
            break
        allowed = {(t, n): tuple(range(len(cuts)) if pick is None else pick(t, n)) for t, n in ends}
        best = []
        for part in _parts(ends, len(cuts) * (max(map(len, cuts)) + 1)):
            counted = _summed(data, grown, cuts, {e: allowed[e] for e in part}, read)
            histogram = counted.groupBy("tree", "node", "f", "b").agg(*(F.sum(c).alias(c) for c in "nws")).repartition("tree", "node")
            whole = Window.partitionBy("tree", "node", "f")
            left = whole.orderBy("b").rowsBetween(Window.unboundedPreceding, 0)
            right = whole.orderBy("b").rowsBetween(1, Window.unboundedFollowing)
            summed = histogram.select("tree", "node", "f", "b", *(F.sum(c).over(left).alias(f"l{c}") for c in "nws"), *(F.sum(c).over(right).alias(f"r{c}") for c in "ws"), *(F.sum(c).over(whole).alias(c) for c in "nws"))
            sizes = (F.col("ln") >= min_leaf) & (F.col("n") - F.col("ln") >= max(min_leaf, 1)) & (F.col("n") >= min_split)
            gained = summed.where(sizes).withColumn("gain", _impurity_drop(criterion)).where(F.col("gain") > LEAST_GAIN)
            best += gained.groupBy("tree", "node").agg(F.max_by(F.struct("f", "b", "gain", (F.col("ls") / F.col("lw")).alias("left"), (F.col("rs") / F.col("rw")).alias("right")), F.struct(F.round("gain", 6), -F.col("f"), -F.col("b"))).alias("best")).collect()
        for r in best:
            tree = grown[r["tree"]]
            tree.splits[r["node"]] = (r["best"]["f"], cuts[r["best"]["f"]][r["best"]["b"]])
            tree.gains[r["node"]] = r["best"]["gain"]
            tree.values.pop(r["node"], None)
            tree.values |= {2 * r["node"]: r["best"]["left"], 2 * r["node"] + 1: r["best"]["right"]}
        if not best:
            break
    whole_trees = [(t, 1) for t, tree in enumerate(grown) if not tree.splits]
    for part in _parts(whole_trees, 1):
        for r in _summed(data, grown, cuts, dict.fromkeys(part, ()), read).groupBy("tree", "node").agg((F.sum("s") / F.sum("w")).alias("v")).collect():
            grown[r["tree"]].values[r["node"]] = r["v"]
    return grown


def _parts(nodes: list[tuple[int, int]], cells: int) -> list[list[tuple[int, int]]]:
    """Nodes in parts whose sums fit a task."""
    step = max(1, SUMS_IN_TASK // cells)
    return [nodes[i : i + step] for i in range(0, len(nodes), step)]


def _walk(tree: Tree, cuts: list[list[float]]) -> tuple[np.ndarray, ...]:
    """The tree as arrays by running number: feature, bin (above all bins for a leaf), number of the left child (the right one follows; a leaf's own), node."""
    order, at = [1], 0
    feature, cut, left = [], [], []
    while at < len(order):
        node = order[at]
        f, threshold = tree.splits.get(node, (-1, 0.0))
        feature.append(max(f, 0))
        cut.append(bisect_left(cuts[f], threshold) if f >= 0 else 1 << 40)
        left.append(len(order) if f >= 0 else at)
        order += [2 * node, 2 * node + 1] if f >= 0 else []
        at += 1
    return tuple(np.array(a, dtype=np.int64) for a in (feature, cut, left, order))


def _placed(walk: tuple[np.ndarray, ...], bins: np.ndarray) -> np.ndarray:
    """Running number of the leaf that each row (a column of ``bins``) ends in."""
    feature, cut, left, order = walk
    row, at = np.arange(bins.shape[1]), np.zeros(bins.shape[1], dtype=np.int64)
    for _ in range(int(order.max()).bit_length() - 1):
        at = left[at] + (bins[feature[at], row] > cut[at])
    return at


def _column_reader(size: int, trees: int) -> Reader:
    """Reads rows of bins, target and weights, each row's as a list."""

    def read(batch: pa.RecordBatch) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
        bins = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, size)
        g = batch.column(1).fill_null(0.0).to_numpy(zero_copy_only=False)
        weights = batch.column(2).flatten().fill_null(0.0).to_numpy(zero_copy_only=False).reshape(batch.num_rows, trees)
        yield np.ascontiguousarray(bins.T), g, np.ascontiguousarray(weights.T)

    return read


def _summed(data: DataFrame, grown: list[Tree], cuts: list[list[float]], wanted: dict[tuple[int, int], tuple[int, ...]], read: Reader) -> DataFrame:
    """Rows, weights and weighted targets that each task found by (tree, node, feature, bin), for the features named for a node.

    A node without features gives its totals alone (feature -1). Rows are counted where they lie: what leaves a task are sums.
    """
    size, width = len(cuts), max(map(len, cuts), default=0) + 1
    walks = {t: _walk(grown[t], cuts) for t in dict.fromkeys(t for t, _ in wanted)}
    slots = {}
    for t, (*_, order) in walks.items():
        nodes = [n for tree, n in wanted if tree == t]
        slots[t] = nodes, np.array([nodes.index(n) if n in nodes else -1 for n in order.tolist()], dtype=np.int64)
    totals = not any(wanted.values())

    def count(batches):
        sums = {t: np.zeros((3, len(nodes), 1 if totals else size, 1 if totals else width)) for t, (nodes, _) in slots.items()}
        for bins, g, weights in (part for batch in batches for part in read(batch)):
            for t, walk in walks.items():
                drawn = np.flatnonzero(weights[t] > 0)
                b, w = (bins, weights[t]) if len(drawn) == len(g) else (bins[:, drawn], weights[t][drawn])
                s = w * (g if len(drawn) == len(g) else g[drawn])
                slot = slots[t][1][_placed(walk, b)]
                if (slot < 0).any():
                    kept = np.flatnonzero(slot >= 0)
                    slot, b, w, s = slot[kept], b[:, kept], w[kept], s[kept]
                shape = sums[t].shape
                for f in range(shape[2]):
                    place = slot if totals else slot * width + b[f]
                    for i, what in enumerate((None, w, s)):
                        sums[t][i, :, f, :] += np.bincount(place, what, shape[1] * shape[3]).reshape(shape[1], shape[3])
        found = []
        for t, (nodes, _) in slots.items():
            for i, f, b in zip(*(x.tolist() for x in np.nonzero(sums[t][0]))):
                if totals or f in wanted[t, nodes[i]]:
                    n, w, s = sums[t][:, i, f, b].tolist()
                    found.append((t, nodes[i], -1 if totals else f, b, int(n), w, s))
        columns = list(zip(*found)) or [()] * 7
        kinds = (pa.int32(), pa.int64(), pa.int32(), pa.int32(), pa.int64(), pa.float64(), pa.float64())
        yield pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(columns, kinds)], names=["tree", "node", "f", "b", "n", "w", "s"])

    return data.mapInArrow(count, "tree int, node long, f int, b int, n long, w double, s double")


_PACKED = "bins binary, y binary, log_w binary"


def packed(rows: DataFrame, cuts: list[list[float]]) -> DataFrame:
    """Rows (``_b``, ``_y``) with a logarithm of their weight, 0 at first, many in a row: bins by feature, then targets, then logarithms as bytes."""
    size, kind = len(cuts), np.min_scalar_type(max(map(len, cuts), default=0))

    def pack(batches):
        parts, count = [], 0
        for batch in batches:
            bins = batch.column(0).flatten().to_numpy(zero_copy_only=False).reshape(batch.num_rows, size)
            parts.append((bins.T.astype(kind), batch.column(1).to_numpy(zero_copy_only=False)))
            count += batch.num_rows
            if count >= PACKED_ROWS:
                yield _packed_row(*(np.concatenate(x, axis=-1) for x in zip(*parts)))
                parts, count = [], 0
        if parts:
            yield _packed_row(*(np.concatenate(x, axis=-1) for x in zip(*parts)))

    return rows.select("_b", "_y").mapInArrow(pack, _PACKED)


def _packed_row(bins: np.ndarray, y: np.ndarray, log_w: np.ndarray | None = None) -> pa.RecordBatch:
    log_w = np.zeros(len(y)) if log_w is None else log_w
    return pa.RecordBatch.from_arrays([pa.array([a.tobytes()], pa.binary()) for a in (bins, y, log_w)], _PACKED.replace(" binary", "").split(", "))


def _unpacked(batch: pa.RecordBatch, cuts: list[list[float]], rounds: Sequence[Round]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray]]:
    """(bins, targets, logarithms of the weights after the rounds) of each row of a packed table."""
    kind = np.min_scalar_type(max(map(len, cuts), default=0))
    for bins, y, log_w in zip(*(c.to_pylist() for c in batch.columns), strict=True):
        bins, y, log_w = np.frombuffer(bins, kind).reshape(len(cuts), -1), np.frombuffer(y), np.frombuffer(log_w)
        for done in rounds:
            log_w = log_w + (1 - done.share(done.error(bins, y))) * done.slope
        yield bins, y, log_w


@dataclass
class Round:
    """A round of AdaBoost.R2: its tree, the largest error, the loss of a share of it, and what a row without an error adds to its logarithm."""

    walk: tuple[np.ndarray, ...]
    values: np.ndarray
    loss: str
    largest: float = 0.0
    slope: float = 0.0

    def error(self, bins: np.ndarray, y: np.ndarray) -> np.ndarray:
        return np.abs(y - self.values[_placed(self.walk, bins)])

    def share(self, error: np.ndarray) -> np.ndarray:
        share = error / self.largest
        return {"linear": lambda: share, "square": lambda: share**2, "exponential": lambda: 1 - np.exp(-share)}[self.loss]()


def _reduced(rows: DataFrame, cuts: list[list[float]], rounds: Sequence[Round], measure: Callable[..., list[float]], how: list[str]) -> list[float]:
    """Numbers measured on each part of a packed table after the rounds, put together over all parts by sum or max."""
    names = [f"v{i}" for i in range(len(how))]

    def each(batches):
        for batch in batches:
            found = [measure(*part) for part in _unpacked(batch, cuts, rounds)]
            yield pa.RecordBatch.from_arrays([pa.array(map(float, c), pa.float64()) for c in zip(*found)] if found else [pa.array([], pa.float64())] * len(how), names)

    return list(rows.mapInArrow(each, ", ".join(f"{n} double" for n in names)).agg(*(getattr(F, h)(n) for h, n in zip(how, names))).first())


def _stored(rows: DataFrame) -> DataFrame:
    path = scratch_path(rows.sparkSession, "packed-rows")
    rows.write.parquet(path)
    return rows.sparkSession.read.schema(rows.schema).parquet(path)


class TreeModel(Model, HasFeaturesCol, HasPredictionCol):
    """Trees combined as a sum with a base, a mean, or a weighted median."""

    def __init__(self, trees: list[Tree], kind: str, size: int, base: float = 0.0, weights: Sequence[float] = (), history: Sequence[float] = ()):
        super().__init__()
        self.trees, self.kind, self.size, self.base, self.weights, self.history = trees, kind, size, base, list(weights), list(history)

    def value(self) -> Column:
        each = [F.expr(tree.value()) for tree in self.trees]
        if self.kind == "sum":
            return sum((v * w for v, w in zip(each, self.weights, strict=True)), F.lit(self.base))
        if self.kind == "mean":
            return sum(each, F.lit(0.0)) / max(len(each), 1)
        return weighted_median(each, self.weights)

    def _transform(self, dataset: DataFrame) -> DataFrame:
        return dataset.withColumn("_x", vector_to_array(self.getFeaturesCol())).withColumn(self.getPredictionCol(), self.value()).drop("_x")

    @property
    def featureImportances(self) -> DenseVector:
        total = np.zeros(self.size)
        for tree in self.trees:
            for node, (feature, _) in tree.splits.items():
                total[feature] += tree.gains[node]
        return DenseVector(total / total.sum() if total.sum() else total)

    def to_json(self) -> str:
        return json.dumps({"trees": [t.to_dict() for t in self.trees], "kind": self.kind, "size": self.size, "base": self.base, "weights": self.weights, "history": self.history, "features": self.getFeaturesCol(), "prediction": self.getPredictionCol()})

    @classmethod
    def from_json(cls, text: str) -> TreeModel:
        d = json.loads(text)
        model = cls([Tree.from_dict(t) for t in d["trees"]], d["kind"], d["size"], d["base"], d["weights"], d["history"])
        return model._set(featuresCol=d["features"], predictionCol=d["prediction"])


def weighted_median(values: list[Column], weights: Sequence[float]) -> Column:
    """The least value whose weight together with that of the smaller ones is half of all or more."""
    pairs = F.array_sort(F.array(*(F.struct(v.alias("v"), F.lit(float(w)).alias("w")) for v, w in zip(values, weights, strict=True))))
    start = F.struct(F.lit(0.0).alias("below"), F.lit(None).cast("double").alias("v"))
    half = sum(weights) / 2
    step = lambda a, x: F.struct((a["below"] + x["w"]).alias("below"), F.when(a["v"].isNull() & (a["below"] + x["w"] >= half - 1e-12), x["v"]).otherwise(a["v"]).alias("v"))
    return F.aggregate(pairs, start, step, lambda a: a["v"])


class _TreeEstimator(Estimator, HasFeaturesCol, HasLabelCol, HasPredictionCol):
    maxDepth = Param(Params._dummy(), "maxDepth", "levels of a tree", TypeConverters.toInt)
    minInstancesPerNode = Param(Params._dummy(), "minInstancesPerNode", "rows a leaf holds at least", TypeConverters.toInt)
    minSamplesSplit = Param(Params._dummy(), "minSamplesSplit", "rows a node holds at least to be split", TypeConverters.toInt)
    featureSubsetStrategy = Param(Params._dummy(), "featureSubsetStrategy", "features a node may split on: all, sqrt or log2 of them", TypeConverters.toString)
    maxBins = Param(Params._dummy(), "maxBins", "cut points of a feature", TypeConverters.toInt)
    seed = Param(Params._dummy(), "seed", "seed", TypeConverters.toInt)

    def _prepared(self, dataset: DataFrame) -> tuple[DataFrame, list[list[float]], int]:
        """Rows with ``_x``, ``_b`` and ``_y``, written out once; rows without a label or with a missing feature are left out."""
        x = vector_to_array(self.getFeaturesCol())
        rows = dataset.select(x.alias("_x"), F.col(self.getLabelCol()).cast("double").alias("_y")).where(F.col("_y").isNotNull() & ~F.isnan("_y") & ~F.exists("_x", F.isnan))
        kept = reuse(rows)
        first = kept.first()
        if first is None:
            raise ValueError("No rows to fit on")
        cuts = cut_points(kept, len(first["_x"]), self.getOrDefault("maxBins"))
        # every level of every tree reads them again: columns on disk are cheaper to read than a checkpoint of rows
        path = scratch_path(dataset.sparkSession, "tree-rows")
        binned(kept, cuts).write.parquet(path)
        out = dataset.sparkSession.read.parquet(path)
        kept.unpersist()
        return out, cuts, len(first["_x"])

    def _pick(self, size: int, tree: int = 0) -> Callable[[int, int], list[int]] | None:
        kind = self.getOrDefault("featureSubsetStrategy")
        if kind == "all":
            return None
        few = max(1, int(math.sqrt(size) if kind == "sqrt" else math.log2(size)))
        return lambda t, node: random.Random(f"{self.getOrDefault('seed')}/{tree + t}/{node}").sample(range(size), few)

    def _sizes(self) -> dict[str, int]:
        return {"max_depth": self.getOrDefault("maxDepth"), "min_leaf": self.getOrDefault("minInstancesPerNode"), "min_split": self.getOrDefault("minSamplesSplit")}

    def _model(self, *args, **kwargs) -> TreeModel:
        return TreeModel(*args, **kwargs)._set(featuresCol=self.getFeaturesCol(), predictionCol=self.getPredictionCol())


class CriterionForest(_TreeEstimator):
    """Forest whose splits lower the squared error or the Poisson deviance; all trees of a forest grow a level in one job."""

    numTrees = Param(Params._dummy(), "numTrees", "trees", TypeConverters.toInt)
    criterion = Param(Params._dummy(), "criterion", "squared_error or poisson", TypeConverters.toString)
    bootstrap = Param(Params._dummy(), "bootstrap", "whether rows are drawn for each tree", TypeConverters.toBoolean)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", numTrees=128, criterion="squared_error", bootstrap=True, maxDepth=8, minInstancesPerNode=1, minSamplesSplit=32, featureSubsetStrategy="all", maxBins=32, seed=42):
        super().__init__()
        self._set(**self._input_kwargs)
        for name in ("numTrees", "criterion", "bootstrap", "maxDepth", "minInstancesPerNode", "minSamplesSplit", "featureSubsetStrategy", "maxBins", "seed"):
            self._set(**{name: locals()[name]})

    def _fit(self, dataset: DataFrame) -> TreeModel:
        rows, cuts, size = self._prepared(dataset)
        criterion, trees = self.getOrDefault("criterion"), self.getOrDefault("numTrees")
        if criterion == "poisson" and not rows.where("_y < 0").isEmpty():
            raise ValueError("The Poisson criterion needs targets of 0 or more")
        draws = [self._drawn(t) for t in range(trees)] if self.getOrDefault("bootstrap") else None
        grown = grow(rows, cuts, trees=trees, weights=draws, criterion=criterion, pick=self._pick(size), **self._sizes())
        return self._model(grown, "mean", size)

    def _drawn(self, tree: int) -> Column:
        """How often a tree draws a row: a Poisson number of mean 1 from the row's hash, so reruns agree."""
        u = F.pmod(F.xxhash64("_x", "_y", F.lit(self.getOrDefault("seed")), F.lit(tree)), F.lit(1 << 30)) / (1 << 30)
        bounds, p, total = [], math.exp(-1), 0.0
        for k in range(1, 9):
            total += p
            bounds.append(total)
            p /= k
        return sum((F.when(u >= b, 1.0).otherwise(0.0) for b in bounds), F.lit(0.0))


class StoppedBoosting(_TreeEstimator):
    """Gradient boosting with squared, absolute or Huber loss that ends when a held-out part gets no better.

    Rows are held out by their hash. After ``nIterNoChange`` rounds without a loss lower by ``tol`` than the best before, fitting
    ends and the trees up to the best round stay; 0 rounds switch this off. Absolute and Huber leaves are exact medians.
    """

    maxIter = Param(Params._dummy(), "maxIter", "trees at most", TypeConverters.toInt)
    stepSize = Param(Params._dummy(), "stepSize", "share of each tree", TypeConverters.toFloat)
    lossType = Param(Params._dummy(), "lossType", "squared, absolute or huber", TypeConverters.toString)
    alpha = Param(Params._dummy(), "alpha", "quantile of the residuals beyond which Huber loss is linear", TypeConverters.toFloat)
    nIterNoChange = Param(Params._dummy(), "nIterNoChange", "rounds without a better held-out loss", TypeConverters.toInt)
    validationFraction = Param(Params._dummy(), "validationFraction", "share of rows held out", TypeConverters.toFloat)
    tol = Param(Params._dummy(), "tol", "how much lower a better loss is", TypeConverters.toFloat)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", maxIter=128, stepSize=0.1, lossType="squared", alpha=0.9, nIterNoChange=10, validationFraction=0.1, tol=1e-4, maxDepth=3, minInstancesPerNode=16, minSamplesSplit=2, featureSubsetStrategy="all", maxBins=32, seed=42):
        super().__init__()
        self._set(**self._input_kwargs)
        for name in ("maxIter", "stepSize", "lossType", "alpha", "nIterNoChange", "validationFraction", "tol", "maxDepth", "minInstancesPerNode", "minSamplesSplit", "featureSubsetStrategy", "maxBins", "seed"):
            self._set(**{name: locals()[name]})

    def held_out(self) -> Column:
        share = F.pmod(F.xxhash64("_x", "_y", F.lit(self.getOrDefault("seed"))), F.lit(1 << 20)) / (1 << 20)
        return (share < self.getOrDefault("validationFraction")) if self.getOrDefault("nIterNoChange") else F.lit(False)

    def _fit(self, dataset: DataFrame) -> TreeModel:
        loss, patience, step = self.getOrDefault("lossType"), self.getOrDefault("nIterNoChange"), self.getOrDefault("stepSize")
        if loss not in ("squared", "absolute", "huber"):
            raise ValueError(f"Unknown loss {loss!r}")
        rows, cuts, size = self._prepared(dataset)
        rows = rows.withColumn("_held", self.held_out())
        fitted_on = rows.where("not _held")
        base = float(fitted_on.agg(F.avg("_y")).first()[0]) if loss == "squared" else quantiles(fitted_on, "_y", {"m": 0.5})["m"]
        trees: list[Tree] = []
        history: list[float] = []
        current = rows.withColumn("_f", F.lit(base))
        for number in range(self.getOrDefault("maxIter")):
            left = F.col("_y") - F.col("_f")
            train = current.where("not _held").withColumn("_r", left)
            delta = quantiles(train, F.abs("_r"), {"d": self.getOrDefault("alpha")})["d"] if loss == "huber" else 0.0
            pull = {"squared": F.col("_r"), "absolute": F.signum("_r"), "huber": F.greatest(F.lit(-delta), F.least(F.lit(delta), F.col("_r")))}[loss]
            tree = grow(train, cuts, target=pull, pick=self._pick(size, number), **self._sizes())[0]
            if loss != "squared":
                tree.values = leaf_values(train, tree, delta if loss == "huber" else None)
            trees.append(tree)
            current = current.withColumn("_f", F.col("_f") + F.expr(tree.value()) * step)
            if len(trees) % CUT_EVERY == 0:
                current = cut_lineage(current)
            if patience:
                history.append(self._loss(current.where("_held"), loss, delta))
                if len(history) > patience and min(history[-patience:]) > min(history[:-patience]) - self.getOrDefault("tol"):
                    break
        kept = history.index(min(history)) + 1 if history and history[-1] == history[-1] else len(trees)
        return self._model(trees[:kept], "sum", size, base, [step] * kept, history)

    def _loss(self, rows: DataFrame, loss: str, delta: float) -> float:
        r = F.abs(F.col("_y") - F.col("_f"))
        each = {"squared": r * r, "absolute": r, "huber": F.when(r <= delta, r * r / 2).otherwise(delta * (r - delta / 2))}[loss]
        found = rows.agg(F.avg(each)).first()[0]
        return float("nan") if found is None else found


def leaf_values(rows: DataFrame, tree: Tree, delta: float | None) -> dict[int, float]:
    """Median of the residuals ``_r`` of each leaf; with ``delta`` moved by the mean of what is left of them, clipped to it."""
    placed = rows.withColumn("_leaf", F.expr(tree.place()))
    if len(tree.splits) < FEW_LEAVES:
        medians = few_group_medians(placed, "_r", "_leaf")
    else:
        medians = {r["_leaf"]: r["m"] for r in grouped_quantiles(placed, "_r", {"m": 0.5}, ["_leaf"]).collect()}
    if delta is None or not medians:
        return medians
    middle = F.create_map(*(x for n, m in medians.items() for x in (F.lit(n), F.lit(m))))
    off = F.col("_r") - middle[F.col("_leaf")]
    moved = placed.groupBy("_leaf").agg(F.avg(F.signum(off) * F.least(F.lit(delta), F.abs(off))).alias("v")).collect()
    return {r["_leaf"]: medians[r["_leaf"]] + r["v"] for r in moved}


class AdaBoostR2(_TreeEstimator):
    """AdaBoost.R2: each round fits a tree to weighted rows and lowers the weights of rows it predicts well; weighted median of all.

    With a linear loss a row's error is its share of the largest one. Fitting ends early where a tree is perfect or where the
    weighted error is half or more; such a tree counts only if it is the first.
    """

    maxIter = Param(Params._dummy(), "maxIter", "trees at most", TypeConverters.toInt)
    stepSize = Param(Params._dummy(), "stepSize", "share of each round", TypeConverters.toFloat)
    lossType = Param(Params._dummy(), "lossType", "linear, square or exponential", TypeConverters.toString)

    @keyword_only
    def __init__(self, *, featuresCol="features", labelCol="label", predictionCol="prediction", maxIter=50, stepSize=1.0, lossType="linear", maxDepth=3, minInstancesPerNode=1, minSamplesSplit=2, featureSubsetStrategy="all", maxBins=32, seed=42):
        super().__init__()
        self._set(**self._input_kwargs)
        for name in ("maxIter", "stepSize", "lossType", "maxDepth", "minInstancesPerNode", "minSamplesSplit", "featureSubsetStrategy", "maxBins", "seed"):
            self._set(**{name: locals()[name]})

    def _fit(self, dataset: DataFrame) -> TreeModel:
        rows, cuts, size = self._prepared(dataset)
        step, kind = self.getOrDefault("stepSize"), self.getOrDefault("lossType")
        if kind not in ("linear", "square", "exponential"):
            raise ValueError(f"Unknown loss {kind!r}")
        # weights are logarithms, so that many rounds do not underflow
        current = _stored(packed(rows, cuts))
        trees: list[Tree] = []
        weights: list[float] = []
        since: list[Round] = []  # rounds that the stored logarithms do not have yet
        for number in range(self.getOrDefault("maxIter")):
            before = tuple(since)
            top = _reduced(current, cuts, before, lambda b, y, log_w: [log_w.max()], ["max"])[0]

            def read(batch, before=before, top=top):
                return ((b, y, np.exp(log_w - top)[None]) for b, y, log_w in _unpacked(batch, cuts, before))

            tree = grow(current, cuts, pick=self._pick(size, number), read=read, **self._sizes())[0]
            walk = _walk(tree, cuts)
            now = Round(walk, np.array([tree.values.get(n, 0.0) for n in walk[3].tolist()]), kind)

            def measured(b, y, log_w, now=now, top=top):
                error, w = now.error(b, y), np.exp(log_w - top)
                return [error[w > 0].max(initial=0.0), w.sum(), (w * error).sum(), (w * error**2).sum()]

            now.largest, whole, linear, square = _reduced(current, cuts, before, measured, ["max", "sum", "sum", "sum"])
            if not now.largest:
                trees, weights = [*trees, tree], [*weights, 1.0]
                break
            if kind == "exponential":  # its sum needs the largest error first
                lost = _reduced(current, cuts, before, lambda b, y, log_w, now=now, top=top: [(np.exp(log_w - top) * now.share(now.error(b, y))).sum()], ["sum"])[0]
            else:
                lost = linear / now.largest if kind == "linear" else square / now.largest**2
            loss = lost / whole
            if loss >= 0.5:
                if not trees:
                    trees, weights = [tree], [1.0]
                break
            now.slope = step * math.log(loss / (1 - loss))
            trees.append(tree)
            weights.append(-now.slope)
            since.append(now)
            if len(since) == CUT_EVERY:
                done = tuple(since)

                def moved(batches, done=done):
                    return (_packed_row(*row) for batch in batches for row in _unpacked(batch, cuts, done))

                current, since = _stored(current.mapInArrow(moved, _PACKED)), []
        return self._model(trees, "median", size, 0.0, weights)
