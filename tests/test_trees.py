"""Trees, forests, stopped and Huber boosting, AdaBoost.R2 against plain loops."""

import math

import numpy as np
import pytest
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import functions as F

from veloflow.ml import trees as T
from veloflow.ml import training as ml
from veloflow.ml.models import get_model
from veloflow.sources.writers import load_model, save_model

RNG = np.random.default_rng(11)
X = RNG.integers(0, 9, (220, 3)).astype(float)
Y = np.round(np.exp(X[:, 0] / 4) + 3 * (X[:, 1] > 4) + RNG.normal(0, 0.4, 220), 3).clip(0) + (RNG.random(220) < 0.04) * 25


@pytest.fixture(scope="module")
def rows(spark):
    df = spark.createDataFrame([(*map(float, x), float(y)) for x, y in zip(X, Y)], "a double, b double, c double, label double")
    return VectorAssembler(inputCols=["a", "b", "c"], outputCol="features").transform(df).cache()


def drop(criterion, s, w, ls, lw):
    rs, rw = s - ls, w - lw
    if criterion == "poisson":
        return ls * math.log(ls / lw) + rs * math.log(rs / rw) - s * math.log(s / w) if ls > 0 and rs > 0 else None
    return ls**2 / lw + rs**2 / rw - s**2 / w


def plain_tree(x, g, w, criterion, depth, min_leaf, min_split, node=1):
    """Every threshold of every feature tried at every node."""
    best = None
    if depth and len(g) >= min_split:
        for f in range(x.shape[1]):
            for t in np.unique(x[:, f]):
                left = x[:, f] <= t
                if min(left.sum(), (~left).sum()) < max(min_leaf, 1):
                    continue
                gain = drop(criterion, (w * g).sum(), w.sum(), (w * g)[left].sum(), w[left].sum())
                if gain is not None and gain > 1e-9 and (best is None or round(gain, 6) > round(best[0], 6)):
                    best = (gain, f, t)
    if best is None:
        return {node: None}
    left = x[:, best[1]] <= best[2]
    return {node: best[1:]} | plain_tree(x[left], g[left], w[left], criterion, depth - 1, min_leaf, min_split, 2 * node) | plain_tree(x[~left], g[~left], w[~left], criterion, depth - 1, min_leaf, min_split, 2 * node + 1)


def leaf_of(tree, x):
    node = 1
    while tree.splits.get(node):
        f, t = tree.splits[node]
        node = 2 * node + (not x[f] <= t)
    return node


def predicted(model, rows):
    return np.array([r["prediction"] for r in model.transform(rows).select("prediction").collect()])


@pytest.mark.parametrize("criterion", ["squared_error", "poisson"])
def test_splits_equal_every_split_tried(rows, criterion):
    model = T.CriterionForest(numTrees=1, criterion=criterion, bootstrap=False, maxDepth=4, minInstancesPerNode=5, minSamplesSplit=24).fit(rows)
    want = plain_tree(X, Y, np.ones(len(Y)), criterion, 4, 5, 24)
    assert model.trees[0].splits == {n: s for n, s in want.items() if s}
    leaf = np.array([leaf_of(model.trees[0], x) for x in X])
    assert predicted(model, rows) == pytest.approx(np.array([Y[leaf == n].mean() for n in leaf]))
    with pytest.raises(ValueError):
        T.CriterionForest(criterion="gini").fit(rows)
    if criterion == "poisson":
        with pytest.raises(ValueError):
            T.CriterionForest(criterion="poisson").fit(rows.withColumn("label", F.col("label") - 5))


def test_forest_draws_rows_and_features(rows):
    forest = T.CriterionForest(numTrees=8, criterion="poisson", maxDepth=4, minSamplesSplit=16, featureSubsetStrategy="sqrt")
    one, two = forest.fit(rows), forest.fit(rows.repartition(5))
    assert [t.splits for t in one.trees] == [t.splits for t in two.trees]
    assert len({str(t.splits) for t in one.trees}) > 4
    assert 1 - ((predicted(one, rows) - Y) ** 2).sum() / ((Y - Y.mean()) ** 2).sum() > 0.05
    assert sum(one.featureImportances) == pytest.approx(1.0)


@pytest.mark.parametrize("loss", ["squared", "absolute", "huber"])
def test_boosting_equals_a_plain_loop(rows, loss):
    """Leaves and predictions computed by hand over the trees that were grown, which are those that a plain search grows."""
    model = T.StoppedBoosting(maxIter=4, stepSize=0.5, lossType=loss, nIterNoChange=0, maxDepth=2, minInstancesPerNode=8).fit(rows)
    f = np.full(len(Y), Y.mean() if loss == "squared" else np.median(Y))
    assert model.base == pytest.approx(f[0])
    for tree in model.trees:
        r = Y - f
        delta = np.quantile(np.abs(r), 0.9)
        g = {"squared": r, "absolute": np.sign(r), "huber": np.clip(r, -delta, delta)}[loss]
        assert tree.splits == {n: s for n, s in plain_tree(X, g, np.ones(len(g)), "squared_error", 2, 8, 2).items() if s}
        leaf = np.array([leaf_of(tree, x) for x in X])
        for n in np.unique(leaf):
            mine = r[leaf == n]
            m = np.median(mine)
            want = {"squared": mine.mean(), "absolute": m, "huber": m + np.mean(np.sign(mine - m) * np.minimum(delta, np.abs(mine - m)))}[loss]
            assert tree.values[n] == pytest.approx(want)
        f = f + 0.5 * np.array([tree.values[n] for n in leaf])
    assert predicted(model, rows) == pytest.approx(f)


def test_boosting_stops(rows):
    flat = rows.withColumn("label", F.when(F.col("a") > 4, 10.0).otherwise(2.0))
    early = T.StoppedBoosting(maxIter=40, stepSize=0.8, nIterNoChange=2, validationFraction=0.3, minInstancesPerNode=4, maxDepth=1, tol=0.01)
    model = early.fit(flat)
    assert len(model.trees) < 10 and len(model.history) < 10 and len(model.trees) == model.history.index(min(model.history)) + 1
    full = early.copy({early.nIterNoChange: 0, early.maxIter: 5}).fit(flat)
    held = np.abs(predicted(model, flat) - predicted(full, flat)).max()
    assert held < 0.1 and len(full.trees) == 5 and not full.history


@pytest.mark.parametrize("loss", ["linear", "square", "exponential"])
def test_ada_boost_equals_a_plain_loop(rows, loss):
    model = T.AdaBoostR2(maxIter=3, lossType=loss, maxDepth=2).fit(rows)
    w = np.ones(len(Y))
    weights, values = [], []
    for tree in model.trees:
        assert tree.splits == {n: s for n, s in plain_tree(X, Y, w / w.max(), "squared_error", 2, 1, 2).items() if s}
        leaf = np.array([leaf_of(tree, x) for x in X])
        p = np.array([np.average(Y[leaf == n], weights=w[leaf == n]) for n in leaf])
        e = np.abs(Y - p) / np.abs(Y - p).max()
        e = {"linear": e, "square": e**2, "exponential": 1 - np.exp(-e)}[loss]
        share = np.average(e, weights=w)
        assert share < 0.5
        beta = share / (1 - share)
        w = w * beta ** (1 - e)
        weights.append(-math.log(beta))
        values.append(p)
    assert model.weights == pytest.approx(weights)
    if len(weights) < 3:  # it ended early, so the tree of the next round has half the error or more
        tree = T.Tree({n: s for n, s in plain_tree(X, Y, w / w.max(), "squared_error", 2, 1, 2).items() if s})
        leaf = np.array([leaf_of(tree, x) for x in X])
        e = np.abs(Y - np.array([np.average(Y[leaf == n], weights=w[leaf == n]) for n in leaf]))
        assert loss == "linear" and np.average(e / e.max(), weights=w) >= 0.5
    values, weights = np.array(values), np.array(weights)
    order = values.argsort(axis=0, kind="stable")
    at = (np.cumsum(weights[order], axis=0) >= weights.sum() / 2).argmax(axis=0)
    assert predicted(model, rows) == pytest.approx(values[order[at, np.arange(len(Y))], np.arange(len(Y))])


def test_ada_boost_ends_on_a_perfect_tree(rows):
    model = T.AdaBoostR2(maxIter=5, maxDepth=1).fit(rows.withColumn("label", F.when(F.col("b") > 3, 1.0).otherwise(0.0)))
    assert len(model.trees) == 1 and model.weights == [1.0]


def test_registry_and_round_trip(spark, tmp_path):
    rng = np.random.default_rng(0)
    df = spark.createDataFrame([(str(i), float(v), 71 + i % 7, float(v * 0.5 * (1 + i % 3))) for i, v in enumerate(np.exp(rng.normal(5, 1, 200)))], "id string, stadtradeln_volume double, regiostar7 int, dtv double")
    assert isinstance(get_model("Random Forest", criterion="poisson"), T.CriterionForest)
    assert isinstance(get_model("Gradient Boosting", lossType="huber"), T.StoppedBoosting)
    for name, params in (("Random Forest", {"criterion": "poisson", "numTrees": 3, "maxDepth": 3, "minSamplesSplit": 8}), ("Gradient Boosting", {"lossType": "huber", "maxIter": 2, "stepSize": 0.5}), ("AdaBoost Regression", {"maxIter": 2})):
        trained = ml.fit_model(df, name, ["stadtradeln_volume", "regiostar7"], **params)
        back = load_model(spark, save_model(trained, spark, str(tmp_path / name.replace(" ", "_"))))
        before = {r["id"]: r["y"] for r in trained.predict(df, "y").collect()}
        assert {r["id"]: r["y"] for r in back.predict(df, "y").collect()} == pytest.approx(before)
        assert len(set(before.values())) > 2
    tuned = ml.fit_model(df, "Gradient Boosting", ["stadtradeln_volume"], tune=True, grid={"lossType": ["squared", "huber"]}, folds=2, maxIter=1, maxDepth=1, nIterNoChange=1)
    assert tuned.best_params["lossType"] in ("squared", "huber")


def test_levels_are_counted_in_the_tasks(spark, monkeypatch):
    """What leaves a task are sums by node, feature and bin: not a row for each row, tree and feature."""
    from veloflow.ml import trees as module

    seen = []
    summed = module._summed
    monkeypatch.setattr(module, "_summed", lambda *a: seen.append(summed(*a)) or seen[-1])
    rows = spark.range(0, 5000, 1, 3).select(F.array((F.col("id") % 10).cast("double"), (F.col("id") % 7).cast("double")).alias("_x"), (F.col("id") % 5).cast("double").alias("_y"))
    cuts = [[float(v) for v in range(10)], [float(v) for v in range(7)]]
    grown = module.grow(module.binned(rows, cuts), cuts, trees=2, max_depth=2)
    assert seen and all(s.count() <= 3 * 2 * 2 * 17 for s in seen)
    means = {r["leaf"]: r["m"] for r in rows.groupBy(F.expr(grown[0].place()).alias("leaf")).agg(F.avg("_y").alias("m")).collect()}
    assert grown[0].values == pytest.approx(means)


def test_medians_of_few_groups(spark):
    from veloflow.functions.order_stats import few_group_medians

    values = [(i % 3, float((i * 37) % 101) - 50.0) for i in range(1000)] + [(3, 0.0), (3, -0.0), (4, None)]
    want = {g: float(np.median([v for k, v in values if k == g])) for g in range(4)}
    assert few_group_medians(spark.createDataFrame(values, "k int, v double"), "v", "k") == want


def test_power_works_out_repeated_values_once(spark):
    """Copies of a table have its exponent."""
    from veloflow.ml.preprocessing import fit_power_lambda

    one = spark.createDataFrame([(float(v),) for v in np.random.default_rng(1).lognormal(3, 1, 300).round(1) + 1], "v double")
    copies = one.crossJoin(spark.range(20)).select("v")
    assert fit_power_lambda(copies, "v") == pytest.approx(fit_power_lambda(one, "v"), abs=1e-9)


def test_ada_boost_rounds_on_packed_rows(rows, monkeypatch):
    """Parts of few rows and logarithms stored after each round give the same model; a level is one count, leaves need none."""
    want = T.AdaBoostR2(maxIter=4, lossType="square", maxDepth=2).fit(rows)
    counted, summed = [], T._summed
    monkeypatch.setattr(T, "_summed", lambda *a: counted.append(1) or summed(*a))
    monkeypatch.setattr(T, "CUT_EVERY", 1)
    monkeypatch.setattr(T, "PACKED_ROWS", 30)
    got = T.AdaBoostR2(maxIter=4, lossType="square", maxDepth=2).fit(rows.repartition(3))
    assert [t.splits for t in got.trees] == [t.splits for t in want.trees] and len(got.trees) == 4
    assert got.weights == pytest.approx(want.weights)
    assert [t.values for t in got.trees] == [pytest.approx(t.values) for t in want.trees]
    assert len(counted) == 2 * 4
