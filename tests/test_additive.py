import numpy as np
import pytest
from pyspark.sql import functions as F

from veloflow.operators import additive as add
from veloflow.operators import calibration as cal
from veloflow.sources.writers import load_calibrator, save_calibrator

STRATA = ["a"] * 7 + ["b"] * 3 + [None] * 4 + ["c"] * 2
RNG = np.random.default_rng(5)
PRED = np.round(RNG.uniform(50, 300, 16))
TRUE = np.round(PRED * RNG.uniform(0.8, 2.5, 16))


@add.register_rule
class ThroughOrigin:
    """A rule as a user would write it: least squares through the origin of value + power * prediction squared."""

    name = "test_through_origin"

    def __init__(self, power):
        self.power = power

    def options(self):
        return {"power": self.power}

    def share(self, pred, true):
        return {"zz": F.pow(pred, 2 * self.power), "zt": F.pow(pred, F.lit(self.power)) * true}

    def solve(self, sums):
        return {"slope": F.try_divide(sums["zt"], F.when(sums["zz"] > 0.5, sums["zz"]))}

    def value(self, pred, params):
        return F.pow(pred, F.lit(self.power)) * params["slope"]


def refit(rule, pred, true):
    """The same rules in numpy; a function of the prediction."""
    if isinstance(rule, ThroughOrigin):
        z = pred**rule.power
        return lambda x: x**rule.power * (z * true).sum() / (z * z).sum()
    if isinstance(rule, add.RatioOfSums):
        ok = (pred > 0) & (true >= 0)
        return lambda x: x * (float(np.clip(true[ok].sum() / pred[ok].sum(), 0.1, 10)) if ok.any() else 1.0)
    x, y = np.log1p(pred), np.log1p(true)
    a = ((x - x.mean()) * (y - y.mean())).sum() / (((x - x.mean()) ** 2).sum() + rule.alpha)
    return lambda p: max(np.expm1(a * (np.log1p(p) - x.mean()) + y.mean()), 0)


def frame(spark, rows=range(16)):
    data = [(i, float(PRED[i]), float(TRUE[i]), STRATA[i]) for i in rows]
    return spark.createDataFrame(data, "id int, y_pred double, y_true double, s string")


def expected(rule, i, rows, strata):
    own = [j for j in rows if STRATA[j] == STRATA[i]] if strata else rows
    use = own if not strata or len(own) >= 3 else rows
    return refit(rule, PRED[use], TRUE[use])(PRED[i])


def check(df, fitted, rule, rows, strata):
    got = {r["id"]: r["y_calibrated"] for r in fitted.apply(df).collect()}
    assert got == pytest.approx({i: expected(rule, i, rows, strata) for i in got}, rel=1e-8)


RULES = [add.RatioOfSums(), add.LogRidge(2.0), ThroughOrigin(0.9)]


@pytest.mark.parametrize("strata", [(), ("s",)])
@pytest.mark.parametrize("rule", RULES, ids=lambda r: r.name)
def test_fit_and_leave_one_out_equal_refitting(spark, rule, strata):
    df, rows = frame(spark), list(range(16))
    fitted = add.Additive(rule, strata).fit(df)
    check(df, fitted, rule, rows, strata)
    for r in cal.loocv_errors(fitted, df).collect():
        rest = [j for j in rows if j != r["id"]]
        assert r["abs_error"] == pytest.approx(abs(expected(rule, r["id"], rest, strata) - TRUE[r["id"]]), abs=1e-6)
    _, row = cal.calibrate_and_evaluate(add.Additive(rule, strata), df)
    assert row.first()["n_stations"] == 16 and row.first()["loocv_mae_mean"] is not None


@pytest.mark.parametrize("strata", [(), ("s",)])
@pytest.mark.parametrize("rule", RULES, ids=lambda r: r.name)
def test_merge_subtract_and_storage(spark, tmp_path, rule, strata):
    df, some, rest = frame(spark), [0, 1, 2, 7, 8, 10, 14], [3, 4, 5, 6, 9, 11, 12, 13, 15]
    first, second = (add.Additive(rule, strata).fit(frame(spark, part)) for part in (some, rest))
    both = first.merge(second)
    assert both.n_stations == 16
    check(df, both, rule, list(range(16)), strata)
    check(df, both.subtract(first), rule, rest, strata)
    back = load_calibrator(spark, save_calibrator(first, spark, str(tmp_path / "state")))
    assert back.params() == first.params() | {"params": {**first.params()["params"], "stratify_by": list(strata)}}
    check(df, back, rule, some, strata)
    check(df, back.merge(second), rule, list(range(16)), strata)


def test_log_ridge_is_the_log_linear_calibrator(spark):
    df = frame(spark)
    a, b = add.Additive(add.LogRidge(1.0)).fit(df), cal.LogLinear(1.0).fit(df)
    for x, y in ((a.apply(df), b.apply(df)), (a.leave_one_out(df), b.leave_one_out(df))):
        assert [r[-1] for r in x.orderBy("id").collect()] == pytest.approx([r[-1] for r in y.orderBy("id").collect()])


def test_nulls_empty_tables_and_clashing_columns(spark):
    odd = spark.createDataFrame([(1, None, 5.0, None, 1), (2, 0.0, 3.0, "a", 2), (3, 2.0, 4.0, "a", 3)], "id int, y_pred double, y_true double, s string, n_rows int")
    out = {r["id"]: r for r in add.Additive(add.RatioOfSums(), ("s",), 1).fit(odd).apply(odd).collect()}
    assert out[1]["y_calibrated"] is None and out[2]["y_calibrated"] == 0 and out[3]["y_calibrated"] == 4 and out[3]["n_rows"] == 3
    none = add.Additive(add.RatioOfSums(), ("s",)).fit(odd.limit(0))
    assert none.n_stations == 0 and none.strata().count() == 0
    assert {r["id"]: r["y_calibrated"] for r in none.apply(odd).collect()} == {1: None, 2: 0, 3: 2}
    assert add.Additive(add.RatioOfSums()).fit(odd.limit(0)).n_stations == 0
    assert none.merge(add.Additive(add.RatioOfSums(), ("s",)).fit(odd)).n_stations == 3


def test_what_cannot_be_combined(spark, tmp_path):
    df = frame(spark)
    whole = add.Additive(add.RatioOfSums(), ("s",)).fit(df)
    with pytest.raises(ValueError):
        whole.merge(add.Additive(add.LogRidge(), ("s",)).fit(df))
    with pytest.raises(ValueError):
        whole.merge(add.Additive(add.RatioOfSums()).fit(df))
    with pytest.raises(ValueError):
        add.Additive(add.RatioOfSums(), ("s",)).fit(frame(spark, [0])).subtract(whole)
    with pytest.raises(ValueError):
        add.Additive(add.RatioOfSums(), ("absent",)).fit(df)
    with pytest.raises(RuntimeError):
        add.Additive(add.RatioOfSums()).apply(df)
    with pytest.raises(ValueError):
        add.Additive.restored({"rule": "unheard_of"}, whole.table)
    with pytest.raises(ValueError):
        add.register_rule(type("Other", (), {"name": "ratio_of_sums"}))
