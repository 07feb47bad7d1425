import datetime

import pytest
from pyspark.sql import functions as F

from veloflow.functions.numeric import is_close
from veloflow.functions.region_keys import normalize_key, pad_left, region_prefix
from veloflow.operators import admin_units, assessment, contracts, features, infrastructure, joins, outliers, periods, targets
from veloflow.operators.columns import resolve_features, to_internal_names
from veloflow.operators.dedupe import keep_first, keep_highest, restore_rows
from veloflow.operators.metrics import regression_metrics, residual_stats


def values(df, key, value):
    return {r[key]: r[value] for r in df.collect()}


def test_region_keys(spark):
    codes = ["1234", "03000000", "99", "", "1234567890123", "10010000000"]
    df = spark.createDataFrame([(c,) for c in codes], "c string")
    assert values(df.select("c", pad_left(F.col("c")).alias("v")), "c", "v") == {c: c.zfill(12) for c in codes}
    smart = values(df.select("c", normalize_key(F.col("c")).alias("v")), "c", "v")
    assert smart["1234"] == "123400000000" and smart["03000000"] == "030000000000" and smart["99"] == "000000000099"
    assert smart[""] == "0" * 12 and smart["1234567890123"] == "123456789012"
    assert [region_prefix(k) for k in ("060000000000", "064000000000", "064110000000", "064110010000", "064110000001", "0")] == ["06", "06400", "06411", "06411001", "064110000001", "00"]


def test_daily_traffic_quality(spark):
    day = datetime.datetime(2024, 5, 1)
    rows = [("a", day + datetime.timedelta(days=i), 0 if i < 2 else 11) for i in range(8)] + [("b", day, 5), ("b", day + datetime.timedelta(days=40), 9)]
    rows += [("c", day, None), ("a", datetime.datetime(2024, 5, 10, 6), 1000)]
    df = spark.createDataFrame(rows, "counter_id string, timestamp timestamp_ntz, count bigint")
    out = {r["counter_id"]: r for r in targets.daily_traffic(df, "2024-05-01", "2024-05-10").collect()}
    assert out["a"]["dtv"] == 8.0 and out["a"]["zero_days"] == 2 and out["a"]["missing_days"] == 2  # 8.25, intraday row on the last day is out
    assert out["a"]["quality_score"] == pytest.approx(0.8 * (1 - 0.25 * 0.5)) and out["a"]["is_valid"]
    assert out["b"]["observation_count"] == 1 and not out["b"]["is_valid"]
    assert out["c"]["dtv"] == 0.0 and out["c"]["quality_score"] == 0.0


def test_half_even_rounding(spark):
    df = spark.createDataFrame([("x", datetime.datetime(2024, 1, 1), 2), ("x", datetime.datetime(2024, 1, 2), 3)], "counter_id string, timestamp timestamp_ntz, count int")
    assert targets.daily_traffic(df, "2024-01-01", "2024-01-02").first()["dtv"] == 2.0


def test_periods():
    assert periods.period_days("2024-05-01", "2024-05-21") == 21


def test_infrastructure_categories(spark):
    raw = ["bicycle_lane_left", "bus_lane_x", "bicycle_way_both", "mit_road_both", "mixed_way", "bicycle_road", "bicycle_road_left", "bicycle_lane", "service_misc", "else", None]
    df = spark.createDataFrame([(i, r) for i, r in enumerate(raw)], "i int, bicycle_infrastructure string")
    got = values(infrastructure.map_infrastructure(df), "i", "infra_category")
    assert list(got.values()) == ["bicycle_lane", "bicycle_lane", "bicycle_way", "mit_road", "mixed_way", "bicycle_road", "no", "bicycle_lane", "no", "no", "no"]
    out = values(infrastructure.map_output_infrastructure(df.withColumnRenamed("bicycle_infrastructure", "infra_category")), "i", "infra_category")
    assert out[6] == "bicycle_road"
    cur = values(infrastructure.map_curated_infrastructure(df.withColumn("infra_category", F.upper("bicycle_infrastructure"))), "i", "infra_category")
    assert cur[0] == "bicycle_lane" and cur[7] == "no"


def test_feature_registry(spark):
    reg = features.FeatureRegistry()
    with pytest.raises(KeyError):
        reg.get("x")
    reg.register(features.Feature("double_users", lambda: F.col("n_users") * 2, ("n_users",), fill=-1.0))
    assert "double_users" in reg.names() and reg.needs(["double_users"]) == {"n_users"}
    assert reg.missing_needs(["km_per_user"], ["n_users"]) == {"km_per_user": ["total_km"]}
    df = spark.createDataFrame([(10, 0), (None, 100)], "n_users int, population int")
    rows = features.derive_features(df, ["participation_rate", "double_users", "unknown"], reg).collect()
    assert rows[0]["participation_rate"] is None and rows[0]["double_users"] == 20 and rows[1]["double_users"] == -1


def test_names_and_aliases(spark):
    df = spark.createDataFrame([(None, 5, 1.0)], "EWZ int, Bev_insg int, DTV double")
    assert to_internal_names(df).first().asDict() == {"population": 5, "dtv": 1.0}
    assert resolve_features(["Erh_SR", "regiostar5"], ["stadtradeln_volume", "regiostar7"]) == {"stadtradeln_volume": "Erh_SR"}
    assert resolve_features(["regiostar5"], ["regiostar7"], lenient=True) == {"regiostar7": "regiostar5"}


def test_dedupe(spark):
    df = spark.createDataFrame([(1, 5.0, "a"), (1, 9.0, "b"), (-1, 1.0, "c"), (-1, 2.0, "d"), (2, None, "e"), (None, 3.0, "f"), (None, 4.0, "g")], "base_id int, dtv double, id string")
    assert {r["id"] for r in keep_highest(df, "dtv", tie="id").collect()} == {"b", "c", "d", "e", "g"}
    assert keep_first(df, ["base_id"], [F.col("id")]).count() == 4
    twice = df.unionByName(df)
    assert restore_rows(twice, df, "id", [F.col("dtv")]).count() == 7
    with pytest.raises(ValueError):
        restore_rows(df.where("id <> 'a'"), df, "id", [F.col("dtv")])


def severity_rows(spark):
    rows = [(str(i), 100.0, 100, "unverified", [(5.0,), (50.0,)]) for i in range(20)]
    rows += [
        ("verified_extreme", 9000.0, 10, "verified", [(5.0,)]),
        ("critical", 9000.0, 10, "unverified", [(5.0,)]),
        ("no_volume", 100.0, 0, "unverified", [(0.0,), (3.0,)]),
        ("null_volume", 100.0, None, "unverified", None),
        ("ambiguous", 100.0, 100, "unverified", [(9.0,), (5.0,)]),
        ("bias", 100.0, 150, "carryover", [(5.0,)]),
        ("carryover", 100.0, 100, "carryover", []),
    ]
    return spark.createDataFrame(rows, "counter_id string, dtv double, count bigint, verification_status string, candidate_edges array<struct<distance:double>>")


def test_severities(spark):
    df = severity_rows(spark).unionByName(severity_rows(spark).where("counter_id = '0'").select(F.lit("spread").alias("counter_id"), F.lit(104.0).alias("dtv"), "count", "verification_status", "candidate_edges"))
    flagged, fences = outliers.detect_all(df)
    got = values(flagged, "counter_id", "flag_severity")
    assert got["verified_extreme"] == "verified" and got["critical"] == "critical" and got["ambiguous"] == "ambiguous"
    assert got["no_volume"] == "no_volume" and got["null_volume"] == "no_volume" and got["carryover"] == "carryover" and got["0"] == "ok"
    assert fences.n_valid == 26
    summary = outliers.detection_summary(flagged, fences).first()
    assert summary["n_counters"] == 28 and summary["n_flagged"] == sum(v not in ("ok", "verified") for v in got.values())


def test_outliers_without_ratios(spark):
    df = severity_rows(spark).where("count is null")
    flagged, fences = outliers.detect_all(df)
    assert fences.n_valid == 0 and [r["flag_severity"] for r in flagged.collect()] == ["no_volume"]
    with pytest.raises(ValueError):
        outliers.fit_fences(df, "dtv", "nonsense")


def test_station_flags(spark):
    rows = [(1, None, 1.0), (2, 10.0, 10.0), (3, 20000.0, 1.0), (4, 100.0, 10.0), (5, 100.0, 90.0), (6, 100.0, None)]
    out = outliers.flag_stations(spark.createDataFrame(rows, "id int, dtv double, p double"), predicted="p")
    assert list(values(out, "id", "flag_severity").values()) == ["critical", "warning", "warning", "warning", "ok", "ok"]
    assert values(out, "id", "flag_reason")[3].startswith("Very high")


def test_metrics_edge_cases(spark):
    none = spark.createDataFrame([], "y_true double, y_pred double")
    assert regression_metrics(none).first().asDict() == dict.fromkeys(("r2", "rmse", "mae", "mape", "max_error", "sqv"), 0.0) | {"n_samples": 0}
    flat = spark.createDataFrame([(5.0, 5.0), (5.0, 5.0)], "y_true double, y_pred double")
    assert regression_metrics(flat).first()["r2"] == 1.0 and residual_stats(flat).first()["residual_std"] == 0.0


def test_hierarchy(spark):
    units = spark.createDataFrame(
        [("01", "Land"), ("02", "Land"), ("01001", "Kreis"), ("01002", "Kreis"), ("010010001", "Verwaltungsgemeinschaft")], "a string, admin_level string"
    ).select(F.rpad("a", 12, "0").alias("ars"), "admin_level")
    got = {r["ars"] for r in admin_units.units_at_level(units, "Verwaltungsgemeinschaft").collect()}
    assert got == {"010010001000", "010020000000", "020000000000"}
    communes = spark.createDataFrame([("010010001001", 1), ("010010001002", 2), ("010020007001", 4), ("010020008001", 8)], "ars string, n_users int")
    out = values(admin_units.rollup_statistics(communes, "Verwaltungsgemeinschaft", units), "ars", "n_users")
    assert out == {"010010001000": 3, "010020000000": 12}
    with pytest.raises(ValueError):
        admin_units.units_at_level(units, "Planet")


def test_changes_and_lookup(spark):
    table = spark.createDataFrame([("a", 1, 10, "unverified"), ("b", 2, 20, "unverified")], "counter_id string, base_id int, count int, verification_status string")
    changes = spark.createDataFrame([("a", 9, None, 0), ("a", 8, None, 1), ("zz", 1, 1, 2)], "counter_id string, base_id int, count int, position int")
    rows = {r["counter_id"]: r for r in joins.apply_changes(table, changes, "2024-01-01 00:00:00").collect()}
    assert len(rows) == 2 and rows["a"]["base_id"] == 8 and rows["a"]["count"] == 10 and rows["a"]["verification_status"] == "verified"
    assert rows["b"]["verification_status"] == "unverified" and rows["b"]["verified_at"] is None
    merged = joins.merge_verifications(table, None).collect()
    assert {r["verification_status"] for r in merged} == {"unverified"}
    found = joins.lookup_padded(spark.createDataFrame([("7",), ("1007",), ("x",)], "id string"), spark.createDataFrame([("007", 1), ("1007", 2)], "k string, v int"), "id", "k", "v")
    assert values(found, "id", "v") == {"7": 1, "1007": 2, "x": None}


def test_contracts(spark):
    good = spark.createDataFrame([("001", "A", 50.0, 8.0)], "id string, name string, latitude double, longitude double")
    assert contracts.check_contract(good, "counter_location").isEmpty()
    bad = spark.createDataFrame([("001", None, 100.0, 200.0), (None, "B", None, 8.0)], "id string, name string, latitude double, longitude double")
    got = {(r["column"], r["rule"]): r["n_failed"] for r in contracts.check_contract(bad, "counter_location").collect()}
    assert got == {("latitude", "at_most_90"): 1, ("longitude", "at_most_180"): 1, ("id", "not_null"): 1, ("latitude", "not_null"): 1}
    edges = spark.createDataFrame([(1, 1, -10), (1, 2, 3)], "edge_id int, base_id int, count int")
    got = {(r["column"], r["rule"]): r["n_failed"] for r in contracts.check_contract(edges, "traffic_volume").collect()}
    assert got == {("count", "at_least_0"): 1, ("edge_id", "unique"): 2}
    with pytest.raises(ValueError):
        contracts.validate(edges, "traffic_volume")
    text = spark.createDataFrame([("1", "2", "3.0"), ("2", "x", "4")], "edge_id string, base_id string, count string")
    got = {(r["column"], r["rule"]) for r in contracts.check_contract(text, "traffic_volume_raw").collect()}
    assert got == {("base_id", "type")}
    assert "demographics" in contracts.list_contracts("source") and contracts.contract_table(spark).count() == 13
    with pytest.raises(KeyError):
        contracts.get_contract("nope")
    with pytest.raises(ValueError):
        contracts.require_valid_stations(spark.createDataFrame([("a", 50.0, 8.0, -1.0)], "id string, latitude double, longitude double, dtv double"))


def test_assessment(spark):
    rate = spark.createDataFrame([(0.95,), (0.8,), (0.79,)], "r double")
    assert [r[0] for r in rate.select(assessment.status_of(F.col("r"))).collect()] == ["pass", "warn", "fail"]
    hub = spark.createDataFrame([(100.0,), (-1.0,), (200000.0,)], "HubDist double")
    row = assessment.check_hub_distances(hub).first()
    assert (row["n_checked"], row["n_passed"], row["status"]) == (3, 1, "fail")
    derived = spark.createDataFrame([(10, 1000, 50, 0.01, 0.5), (20, 0, 1, None, None)], "n_users int, population int, Erh_SR int, TN_SR_relativ double, Streckengewicht_SR double")
    assert assessment.check_derived(derived).first()["n_passed"] == 4
    assert assessment.check_derived(hub).first()["status"] == "skip"
    ranges = spark.createDataFrame([(100.0, 30.0), (-5.0, 50.0), (None, 50.0)], "DZS_mean_SR double, lat double")
    row = assessment.check_ranges(ranges).first()
    assert (row["n_checked"], row["n_passed"]) == (5, 3)
    near = spark.createDataFrame([(847.0, 847.0000001), (847.0, 850.0)], "a double, b double")
    assert [r[0] for r in near.select(is_close(F.col("a"), F.col("b"))).collect()] == [True, False]
    none = assessment.compare_with_reference(spark.createDataFrame([("a", 1)], "id string, x int"), spark.createDataFrame([("b", 1)], "id string, x int"))
    assert none.first()["status"] == "fail"
    checks = assessment.assess(hub)
    assert assessment.overall_status(checks).first()["overall_status"] == "fail"
    assert assessment.overall_status(checks.where("status = 'skip'")).first()["overall_status"] == "skip"
