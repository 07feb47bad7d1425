import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st

import veloflow.functions.order_stats as o
from veloflow.functions.order_stats import grouped_quantiles, order_statistics, quantiles

PROBS = {"min": 0, "q25": 0.25, "median": 0.5, "odd": 0.123, "max": 1}


def frame(spark, values):
    return spark.createDataFrame([(None if v is None else float(v),) for v in values], "v double")


@pytest.mark.parametrize("limit", [200_000, 5])
def test_order_statistics_equal_sorting(spark, monkeypatch, limit):
    monkeypatch.setattr(o, "EXACT_BELOW", limit)
    rng = np.random.default_rng(1)
    values = np.concatenate(
        [
            2.0 ** rng.integers(-40, 40, 300) * (1 + rng.choice([-1, 1], 300) * 2.0**-52),
            -np.exp(rng.normal(0, 9, 300)),
            np.zeros(100),
            1 + rng.integers(0, 50, 100) * 2.0**-50,
            np.full(400, 3.25),  # a third of all rows share one value
        ]
    )
    ordered = np.sort(values)
    wanted = [0, 1, 250, 299, 320, 399, 400, 500, 750, 1199]
    got = order_statistics(frame(spark, values), "v", {str(i): (lambda n, i=i: i) for i in [*wanted, 1200]})
    assert [got[str(i)] for i in wanted] == [ordered[i] for i in wanted]
    assert got["1200"] is None and got["n"] == 1200


def test_quantiles_skip_missing_and_infinite(spark):
    df = frame(spark, [1.0, 2.0, None, float("nan"), float("inf"), 4.0])
    assert quantiles(df, "v", {"m": 0.5, "q": 0.75}) == {"n": 3, "m": 2.0, "q": 3.0}
    assert quantiles(df.where("v < 0"), "v", {"m": 0.5}) == {"n": 0, "m": None}


@settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
@given(st.lists(st.floats(-1e6, 1e6, allow_nan=False), min_size=1, max_size=30))
def test_quantiles_match_numpy(spark, values):
    got = quantiles(frame(spark, values), "v", PROBS)
    for name, p in PROBS.items():
        assert got[name] == pytest.approx(np.quantile(values, p), rel=1e-12, abs=1e-9)


def test_grouped_quantiles(spark):
    rng = np.random.default_rng(2)
    rows = [(None if i % 4 == 3 else "abc"[i % 4], float(v)) for i, v in enumerate(rng.normal(0, 100, 300))]
    got = {r["g"]: r for r in grouped_quantiles(spark.createDataFrame(rows, "g string, v double"), "v", PROBS, ["g"]).collect()}
    assert set(got) == {"a", "b", "c", None}
    for g, row in got.items():
        values = [v for k, v in rows if k == g]
        assert row["n"] == len(values)
        for name, p in PROBS.items():
            assert row[name] == pytest.approx(np.quantile(values, p))
