import numpy as np
import pytest
from pyspark.sql import functions as F

from veloflow.ml import preprocessing as prep
from veloflow.ml import training as ml
from veloflow.ml.inference import imputation_report, impute, predict_volumes
from veloflow.ml.models import get_model, list_models
from veloflow.operators.metrics import regression_metrics
from veloflow.sources.writers import load_model, save_model

FEATURES = ["stadtradeln_volume", "participation_rate", "dist_to_center_m", "infra_category", "regiostar7"]


@pytest.fixture(scope="module")
def table(spark):
    rng = np.random.default_rng(0)
    volume = np.exp(rng.normal(5, 1, 400))
    rows = [
        (str(i), float(v), float(rng.uniform(0, 0.1)), float(rng.uniform(0, 5000)), ["no", "bicycle_way", "mit_road"][i % 3], 71 + i % 7, float(v * 0.5 * np.exp(rng.normal(0, 0.1)) * (1 + i % 3)), 2023 + i % 2)
        for i, v in enumerate(volume)
    ]
    return spark.createDataFrame(rows, "id string, stadtradeln_volume double, participation_rate double, dist_to_center_m double, infra_category string, regiostar7 int, dtv double, year int").cache()


def test_scalers(table):
    fitted = prep.FeaturePrep(FEATURES).fit(table)
    assert [k for _, k in fitted.plan()] == ["power", "standard", "robust", "ordinal", "keep"]
    pdf = table.toPandas()
    z = np.log(pdf["stadtradeln_volume"])
    assert abs(fitted.numbers["stadtradeln_volume"]["lambda"]) < 0.2  # the data are log-normal
    assert fitted.numbers["dist_to_center_m"]["scale"] == pytest.approx(pdf["dist_to_center_m"].std(ddof=0))
    q = pdf["participation_rate"].quantile([0.25, 0.5, 0.75]).tolist()
    assert fitted.numbers["participation_rate"] == pytest.approx({"center": q[1], "scale": q[2] - q[0]})
    assert len(z) == 400


def test_box_cox_likelihood(table):
    lam = prep.fit_power_lambda(table, "dist_to_center_m")
    x = table.select("dist_to_center_m").toPandas()["dist_to_center_m"].to_numpy()

    def likelihood(value):
        y = np.log(x) if value == 0 else (x**value - 1) / value
        return (value - 1) * np.log(x).sum() - len(x) / 2 * np.log(y.var())

    assert all(likelihood(lam) >= likelihood(lam + d) - 1e-6 for d in (-0.05, -0.01, 0.01, 0.05))
    with pytest.raises(ValueError):
        prep.fit_power_lambda(table.withColumn("dist_to_center_m", F.lit(0.0)), "dist_to_center_m")


def test_split_is_repeatable(table):
    a, b = prep.train_test_split(table, 0.2, 1)
    c, _ = prep.train_test_split(table.repartition(7), 0.2, 1)
    assert a.count() + b.count() == 400 and {r["id"] for r in a.collect()} == {r["id"] for r in c.collect()}
    whole, same = prep.train_test_split(table, 0)
    assert whole.count() == same.count() == 400


def test_target_transform(spark):
    df = spark.createDataFrame([(10.0,), (100.0,)], "dtv double")
    tt = prep.TargetTransform.fitted(df, "dtv")
    out = df.select(tt.inverse(F.lit(50.0)).alias("hi"), tt.inverse(F.lit(-5.0)).alias("lo"), tt.inverse(tt.forward(F.col("dtv"))).alias("same")).first()
    assert (out["hi"], out["lo"]) == (200.0, 0.0) and out["same"] == pytest.approx(10.0)
    with pytest.raises(ValueError):
        prep.TargetTransform("sqrt")


def test_models_learn_and_round_trip(spark, table, tmp_path):
    assert {"Linear Regression", "Poisson", "Random Forest", "Gradient Boosting"} <= set(list_models())
    with pytest.raises(KeyError):
        get_model("SVR")
    for name, params in (("Linear Regression", {}), ("Random Forest", {"numTrees": 8, "minInstancesPerNode": 2}), ("Gradient Boosting", {"maxIter": 5})):
        trained = ml.fit_model(table, name, FEATURES, **params)
        assert regression_metrics(trained.predict(table, "y"), "dtv", "y").first()["r2"] > 0.3
        assert ml.feature_importance(trained, spark).count() == 5
    back = load_model(spark, save_model(trained, spark, str(tmp_path / "m")))
    before = {r["id"]: r["y"] for r in trained.predict(table, "y").collect()}
    assert {r["id"]: r["y"] for r in back.predict(table, "y").collect()} == pytest.approx(before)


def test_search_and_cross_validation(table):
    features = ["stadtradeln_volume", "infra_category"]
    trained = ml.fit_model(table, "Poisson", features, tune=True, grid={"regParam": [0.01, 10.0]}, folds=2)
    assert trained.best_params == {"regParam": 0.01}
    row = ml.cross_validate(table, "Linear Regression", features, folds=2).first()
    assert row["r2_gap"] == pytest.approx(row["r2_no_cv"] - row["r2_cv"]) and row["risk"] in ("low", "moderate", "high")
    oof = ml.out_of_fold(table, "Linear Regression", features, folds=2)
    assert oof.count() == 400 and oof.where("y_pred is null").isEmpty()


def test_temporal_stability(table):
    row = ml.temporal_stability(table, "Linear Regression", FEATURES, 2023, 2024).first()
    assert row["n_samples"] == 200 and row["test_year"] == 2024


def test_imputation(spark, table):
    rows = [(1.0, "b", None), (3.0, "a", None), (None, None, None), (float("inf"), "a", None), (7.0, "b", None)]
    df = spark.createDataFrame(rows, "x double, c string, none double")
    out = impute(df, ["x", "c", "none"]).collect()
    assert [r["x"] for r in out] == [1.0, 3.0, 3.0, 3.0, 7.0] and out[2]["c"] == "a" and out[0]["none"] == 0.0
    assert {r["column"]: r["n_missing"] for r in imputation_report(df, ["x", "c"]).collect()} == {"x": 2, "c": 1}
    trained = ml.fit_model(table, "Linear Regression", FEATURES)
    gappy = table.withColumn("participation_rate", F.when(F.col("id") != "3", F.col("participation_rate")))
    scored = predict_volumes(trained, gappy)
    assert scored.where("predicted_dtv is null").isEmpty() and scored.where("participation_rate is null").count() == 1


def test_search_fits_scalers_without_the_held_out_fold(spark, monkeypatch):
    from pyspark.sql import functions as F

    from veloflow.ml import training
    from veloflow.ml.preprocessing import FeaturePrep

    df = spark.range(90).select(F.col("id").cast("string").alias("id"), (F.col("id") * 7 % 50).cast("double").alias("dist_to_center_m"), (F.col("id") % 9 + 1.0).alias("dtv"))
    seen = []
    fit = FeaturePrep.fit
    monkeypatch.setattr(FeaturePrep, "fit", lambda self, rows: seen.append(rows.count()) or fit(self, rows))
    trained = training.fit_model(df, "Poisson", ["dist_to_center_m"], tune=True, grid={"regParam": [0.1, 1.0]}, folds=3)
    assert seen[0] == 90 and len(seen) == 4 and sum(90 - n for n in seen[1:]) == 90 and all(n < 90 for n in seen[1:])
    assert trained.best_params["regParam"] in (0.1, 1.0)


def test_ada_boost_query_has_all_rounds(monkeypatch):
    from veloflow.catalog import scoring

    asked = []
    monkeypatch.setattr(scoring, "_fit_metrics", lambda spark, sf, name, **params: asked.append((name, get_model(name, **params).getOrDefault("maxIter"))))
    scoring.train_ada_boost(None, "")
    assert asked == [("AdaBoost Regression", 50)]
