"""Inputs that once gave wrong results."""

import json

import pytest
from pyspark.sql import functions as F

from veloflow.ml.preprocessing import fit_power_lambda
from veloflow.operators import assessment, metrics, spatial
from veloflow.operators.ranking import number_by_severity
from veloflow.sources import writers


def test_metrics_leave_out_missing_predictions(spark):
    df = spark.createDataFrame([(1.0, 1.5), (3.0, 2.5), (100.0, None), (None, 4.0)], "y_true double, y_pred double")
    row = metrics.regression_metrics(df).first()
    assert row["n_samples"] == 2 and row["r2"] == pytest.approx(1 - 0.5 / 2)


def square(x0, y0, side):
    return [[{"x": x0, "y": y0}, {"x": x0 + side, "y": y0}, {"x": x0 + side, "y": y0 + side}, {"x": x0, "y": y0 + side}]]


def test_unit_keys_may_repeat(spark):
    kind = "ars string, name string, rings array<array<struct<x:double,y:double>>>"
    units = spark.createDataFrame([("01", "land", square(8.0, 50.0, 1.0)), ("01", "water", square(10.0, 50.0, 1.0)), ("02", "twice", square(12.0, 50.0, 1.0)), ("02", "twice", square(12.0, 50.0, 1.0))], kind)
    points = spark.createDataFrame([(1, 8.5, 50.5), (2, 10.5, 50.5), (3, 12.5, 50.5), (4, 0.0, 0.0)], "id int, longitude double, latitude double")
    rows = spatial.join_units(points, units, columns=["name"]).orderBy("id").collect()
    assert [(r["id"], r["admin_ars"], r["name"]) for r in rows] == [(1, "01", "land"), (2, "01", "water"), (3, "02", "twice"), (4, None, None)]


def test_tables_that_share_only_the_key(spark):
    left, right = spark.createDataFrame([(1, 2)], "id int, a int"), spark.createDataFrame([(1, 2)], "id int, b int")
    assert assessment.compare_with_reference(left, right).first()["status"] == "fail"
    assert assessment.cell_mismatches(left, right, "id").count() == 0


def test_calibration_export_has_the_median_ratio(spark, tmp_path):
    df = spark.createDataFrame([("a", 10.0, 2.0), ("b", 20.0, 4.0)], "id string, dtv double, dtv_pred_ratio double")
    writers.write_calibration_data(df, str(tmp_path / "x"), 2024, "here")
    meta = spark.read.json(str(tmp_path / "x" / "metadata")).toJSON().first()
    assert 3.0 in _numbers(json.loads(meta))


def _numbers(x):
    return [n for v in x.values() for n in _numbers(v)] if isinstance(x, dict) else [x]


def test_edges_near_counters_without_severity(spark):
    counters = spark.createDataFrame([(1, 8.0, 50.0, None), (2, 9.0, 50.0, "ok"), (3, 10.0, 50.0, "critical")], "id int, longitude double, latitude double, flag_severity string")
    at = lambda x: [{"x": x, "y": 50.0}, {"x": x + 0.0001, "y": 50.0}]
    edges = spark.createDataFrame([(1, at(8.0)), (2, at(9.0)), (3, at(10.0))], "edge_id int, line array<struct<x:double,y:double>>")
    assert {r["edge_id"] for r in spatial.edges_near_counters(edges, counters).collect()} == {1, 3}


def test_positions_cover_all_rows(spark):
    df = spark.range(1000).select(F.col("id").alias("k"), F.when(F.col("id") % 3 == 0, "ok").otherwise("critical").alias("flag_severity"), (F.col("id") % 50).cast("double").alias("dtv_volume_ratio"))
    rows = number_by_severity(df, tie=["k"]).collect()
    want = sorted(rows, key=lambda r: (r["flag_severity"] == "ok", -r["dtv_volume_ratio"], r["k"]))
    assert [r["position"] for r in want] == list(range(1, 1001))


def test_power_search_goes_beyond_its_first_range(spark):
    df = spark.range(1, 400).select(F.pow(F.lit(1.0) + F.col("id") / 1000, F.lit(1 / 9.0)).alias("x"))
    assert fit_power_lambda(df, "x") > 5.5
