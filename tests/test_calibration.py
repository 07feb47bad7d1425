import json

import numpy as np
import pytest

from veloflow.operators import calibration as cal
from veloflow.sources.writers import load_calibrator, save_calibrator

PRED = [100, 200, 150, 300, 250, 180, 220, 280, 160, 190]
TRUE = [155, 305, 220, 450, 375, 260, 340, 430, 245, 290]


def frame(spark, pred, true, strata=None):
    strata = strata or [None] * len(pred)
    return spark.createDataFrame([(i, float(p), float(t), s) for i, (p, t, s) in enumerate(zip(pred, true, strata))], "id int, y_pred double, y_true double, s string")


def global_factor(pred, true):
    ok = [(p, t) for p, t in zip(pred, true) if p > 0 and t >= 0]
    return float(np.clip(np.median([t / p for p, t in ok]), 0.1, 10)) if ok else 1.0


def ridge(pred, true, alpha=1.0):
    x, y = np.log1p(pred), np.log1p(true)
    a = ((x - x.mean()) * (y - y.mean())).sum() / (((x - x.mean()) ** 2).sum() + alpha)
    return lambda p: max(np.expm1(a * (np.log1p(p) - x.mean()) + y.mean()), 0)


def test_global_factor_and_clipping(spark):
    assert cal.GlobalMultiplicative().fit(frame(spark, PRED, TRUE)).factor == pytest.approx(global_factor(PRED, TRUE))
    assert cal.GlobalMultiplicative().fit(frame(spark, [1000, 2000, 3000], [1, 2, 3])).factor == 0.1
    assert cal.GlobalMultiplicative().fit(frame(spark, [1, 2, 3], [1000, 2000, 3000])).factor == 10
    assert cal.GlobalMultiplicative().fit(frame(spark, [0, 100, 200, 0, 150], [10, 150, 300, 0, 225])).factor == 1.5
    assert cal.GlobalMultiplicative().fit(frame(spark, [0, 0], [1, 2])).factor == 1.0


def test_unfitted_and_factory(spark):
    with pytest.raises(RuntimeError):
        cal.LogLinear().apply(frame(spark, [1], [1]))
    with pytest.raises(ValueError):
        cal.create_calibrator("stratified")
    with pytest.raises(ValueError):
        cal.create_calibrator("nonsense")
    with pytest.raises(NotImplementedError):
        cal.create_calibrator("spatially_weighted")
    with pytest.raises(ValueError):
        cal.Stratified(["absent"]).fit(frame(spark, PRED, TRUE))


@pytest.mark.parametrize("n", [1, 2, 3, 10, 11])
@pytest.mark.parametrize("kind", ["global_multiplicative", "log_linear"])
def test_leave_one_out_equals_refitting(spark, kind, n):
    rng = np.random.default_rng(n)
    pred = np.round(rng.uniform(0, 300, n))
    true = np.round(pred * rng.choice([0.5, 1.5, 1.5, 2.0], n) + rng.integers(0, 3, n))
    pred[0] = 0  # an unusable ratio
    df = frame(spark, pred, true)
    got = {r["id"]: r["abs_error"] for r in cal.loocv_errors(cal.create_calibrator(kind).fit(df), df).collect()}
    for i in range(n):
        p, t = np.delete(pred, i), np.delete(true, i)
        if kind == "log_linear":
            want = abs((ridge(p, t)(pred[i]) if n > 1 else pred[i]) - true[i])
        else:
            want = abs(pred[i] * global_factor(p, t) - true[i])
        assert got[i] == pytest.approx(want, abs=1e-8)


@pytest.mark.parametrize("base", ["global_multiplicative", "log_linear"])
def test_stratified_apply_and_leave_one_out(spark, base):
    rng = np.random.default_rng(5)
    strata = ["a"] * 7 + ["b"] * 3 + [None] * 4 + ["c"] * 2
    pred = np.round(rng.uniform(50, 300, 16))
    true = np.round(pred * rng.uniform(0.8, 2.5, 16))
    df = frame(spark, pred, true, strata)
    fitted = cal.Stratified(["s"], 3, base).fit(df)
    assert {r["s"] for r in fitted.strata().collect()} == {"a", "b", None}

    def value(p, t, x):
        return ridge(p, t)(x) if base == "log_linear" else x * global_factor(p, t)

    def one(i, rows):
        own = [j for j in rows if strata[j] == strata[i]]
        use = own if len(own) >= 3 else rows
        return value(pred[use], true[use], pred[i])

    for r in fitted.apply(df).collect():
        assert r["y_calibrated"] == pytest.approx(one(r["id"], list(range(16))))
    for r in cal.loocv_errors(fitted, df).collect():
        rest = [j for j in range(16) if j != r["id"]]
        assert r["abs_error"] == pytest.approx(abs(one(r["id"], rest) - true[r["id"]]), abs=1e-8)


def test_error_falls_by_strata(spark):
    rng = np.random.default_rng(42)
    true = rng.uniform(100, 1000, 30)
    strata = ["x"] * 10 + ["y"] * 10 + ["z"] * 10
    factor = np.repeat([1.5, 1.2, 1.8], 10)
    df = frame(spark, true / factor * rng.normal(1, 0.02, 30), true, strata)
    fitted, row = cal.calibrate_and_evaluate(cal.Stratified(["s"]), df)
    result = row.first()
    assert fitted.strata().count() == 3 and result["mae_reduction"] > 0.3 and result["loocv_mae_mean"] is not None


def test_evaluation_without_enough_rows(spark):
    _, row = cal.calibrate_and_evaluate(cal.GlobalMultiplicative(), frame(spark, [1, 2], [2, 4]))
    assert row.first()["loocv_mae_mean"] is None


@pytest.mark.parametrize("make", [cal.GlobalMultiplicative, lambda: cal.LogLinear(2.0), lambda: cal.Stratified(["s"])])
def test_round_trip(spark, tmp_path, make):
    df = frame(spark, PRED, TRUE, ["a", "b"] * 5)
    fitted, row = cal.calibrate_and_evaluate(make(), df)
    path = save_calibrator(fitted, spark, str(tmp_path / "cal"), row)
    back = load_calibrator(spark, path)
    assert back.params() == json.loads(json.dumps(fitted.params()))
    before = {r["id"]: r["y_calibrated"] for r in fitted.apply(df).collect()}
    after = {r["id"]: r["y_calibrated"] for r in back.apply(df).collect()}
    assert before == pytest.approx(after)
    assert spark.read.json(f"{path}/metrics").first()["n_stations"] == 10


def test_apply_keeps_uncalibrated(spark):
    edges = spark.createDataFrame([(1, 10.0), (2, None)], "edge_id int, predicted_dtv double")
    out = cal.apply_to_edges(cal.GlobalMultiplicative(factor=2.0), edges).orderBy("edge_id").collect()
    assert out[0]["predicted_dtv"] == 20 and out[0]["predicted_dtv_uncalibrated"] == 10 and out[1]["predicted_dtv"] is None


def test_params_table(spark):
    fitted = cal.LogLinear().fit(frame(spark, PRED, TRUE))
    row = cal.params_table(fitted, spark, "2024-01-01 00:00:00").first()
    assert row["calibrator_type"] == "log_linear" and set(json.loads(row["params"])) == {"a", "b", "alpha"}
