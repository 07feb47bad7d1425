import json

import pytest
from pyspark.sql import functions as F

from veloflow.operators.outliers import Fences
from veloflow.sources import readers, writers
from veloflow.sources.training_data import feature_columns, prepare_curated_data, prepare_training_data, target_column


def write(path, text, encoding="utf-8"):
    path.write_bytes(text.encode(encoding))
    return str(path)


@pytest.mark.parametrize("sep", [";", ","])
def test_counter_locations(spark, tmp_path, sep):
    path = write(tmp_path / "c.csv", sep.join(["Counter_ID_orig", "Counter_Name", "lat", "lon", "DZS_mean_SR"]) + "\n" + sep.join(["7", "A", "50.1", "8.6", "x"]) + "\n")
    row = readers.read_counter_locations(spark, path).first()
    assert (row["id"], row["name"], row["latitude"], row["longitude"], row["dtv"]) == ("007", "A", 50.1, 8.6, None)


@pytest.mark.parametrize("days", [("Mo. 1. Mai 2023", "Di. 2. Mai 2023"), ("2023-05-01 00:00:00", "2023-05-02 00:00:00"), ("01-05-2023 00:00:00", "02-05-2023 00:00:00")])
def test_measurements(spark, tmp_path, days):
    text = "made by,some tool\nunit,per day\nZeit,001,064b\n" + f"{days[0]},12.9,\n{days[1]},abc,7\nnonsense,1,1\n"
    rows = readers.read_counter_measurements(spark, write(tmp_path / "m.csv", text)).orderBy("counter_id").collect()
    assert [(r["counter_id"], str(r["timestamp"])[:10], r["count"]) for r in rows] == [("001", "2023-05-01", 12), ("064b", "2023-05-02", 7)]


def test_measurements_without_time(spark, tmp_path):
    with pytest.raises(ValueError):
        readers.read_counter_measurements(spark, write(tmp_path / "m.csv", "a\nb\nfoo,bar\n1,2\n"))


def test_traffic(spark, tmp_path):
    path = write(tmp_path / "t.csv", 'KantenId;GrundlagenId;Verkehrsmenge;GeschwIn;x;geometry\n1;2;3;4.5;q;"LINESTRING (8 50, 8.1 50.1)"\n')
    df = readers.read_traffic_volumes(spark, path)
    assert df.columns == ["edge_id", "base_id", "count", "speed_forward_kmh", "line"]
    assert df.first()["line"][1]["x"] == 8.1
    with pytest.warns(UserWarning):
        readers.traffic_volumes(df.drop("count"))


def test_regional_tables(spark, tmp_path):
    path = write(tmp_path / "r.csv", "gemrs_22;RegioStaR5;RegioStaR7;Ort\n10010000000;51;71;K\u00f6ln \u201eMitte\n", "cp1252")
    assert readers.read_csv(spark, path, ";", "windows-1252").first()["Ort"] == "K\u00f6ln \u201eMitte"
    assert readers.read_regiostar(spark, path).first().asDict() == {"ars": "010010000000", "regiostar5": 51, "regiostar7": 71}
    path = write(tmp_path / "k.csv", "ags;year;start;end\n1;2024;2024-05-01;bad\n2;2023;2023-05-01;2023-05-21\n", "cp1252")
    row = readers.read_campaign_metadata(spark, path, 2024).first()
    assert row["ars"] == "000000000001" and str(row["start_date"])[:10] == "2024-05-01" and row["end_date"] is None
    data = [{"ars": "10010000000", "name": "A", "users_n": 5, "trips_n": 6, "distance_km": 7.5, "extra": "x"}, {"ars": "020010000000", "name": "B", "users_n": 1, "trips_n": 1, "distance_km": 1.0, "extra": "y"}]
    path = write(tmp_path / "d.json", json.dumps(data))
    rows = readers.read_demographics(spark, path, "010000000000").collect()
    assert [(r["ars"], r["n_users"], r["total_km"], r["extra"]) for r in rows] == [("010010000000", 5, 7.5, "x")]
    path = write(tmp_path / "d.csv", "ARS,N_USERS,N_TRIPS,TOTAL_KM\n10010000000,5,6,7.5\n")
    assert readers.read_demographics(spark, path).first()["ars"] == "010010000000"
    places = spark.createDataFrame([("A", "city", "POINT (8.5 50.5)")], "Name string, place string, geometry string")
    assert readers.city_centroids(places).first()["latitude"] == 50.5
    towns = spark.createDataFrame([("06", "061", "A", 5), ("07", "071", "B", 6)], "Land string, ARS string, GEN string, EWZ int")
    assert [r["name"] for r in readers.municipalities(towns, "06").collect()] == ["A"]


def test_generic_reader(spark, tmp_path):
    path = write(tmp_path / "g.csv", "ags;v\n03000;1\n04;2;surplus\n05\n06;\n07;1;\n")
    rows = [(r["ars"], r["v"]) for r in readers.read_dataset(spark, path).collect()]
    assert rows == [("030000000000", "1"), ("050000000000", None), ("060000000000", None), ("070000000000", "1")]
    assert readers.read_delimited(spark, path)[1].first()["n_surplus"] == 1
    (tmp_path / "w.csv").write_bytes("ags;v\n03000;K\u00f6ln \u20ac\n".encode("cp1252"))
    assert readers.read_dataset(spark, str(tmp_path / "w.csv")).first()["v"] == "K\u00f6ln \u20ac"
    assert readers.read_dataset(spark, str(tmp_path / "none.csv")) is None
    assert readers.read_osm_infrastructure(spark, str(tmp_path / "none.csv")) is None


def test_calibration_stations(spark, tmp_path):
    path = write(tmp_path / "s.csv", "id,latitude,longitude,dtv,infra_category\nCAL001,51.3,12.4,150,no\n")
    assert readers.read_calibration_stations(spark, path).first()["dtv"] == 150.0
    for bad in ("", "-100"):
        with pytest.raises(ValueError):
            readers.read_calibration_stations(spark, write(tmp_path / "b.csv", f"id,latitude,longitude,dtv\nA,51,12,{bad}\n"))


def test_verified_round_trip(spark, tmp_path):
    df = spark.createDataFrame([("b", 1, 2, "verified", None), ("a", 3, None, "carryover", True)], "counter_id string, base_id int, count int, verification_status string, is_discarded boolean")
    root = str(tmp_path)
    writers.write_verified_counters(df, root, 2024, project="p", etl_version="abc")
    back = readers.read_verified_counters(spark, root, 2024, "p")
    assert {r["counter_id"]: r["is_discarded"] for r in back.collect()} == {"a": True, "b": False} and "etl_version" in back.columns
    writers.write_verified_counters(df, root, 2023, single_file=True)
    assert readers.read_verified_counters(spark, root, 2023, "other").count() == 2  # falls back to the shared table
    assert readers.read_verified_counters(spark, root, 1999) is None
    with pytest.raises(FileNotFoundError):
        readers.read_verified_counters(spark, root, 1999, must_exist=True)
    writers.write_verified_calibration(df.withColumn("dtv", F.lit(1.0)), root, "Bad Homburg", 2024, "2024-01-01 00:00:00")
    assert readers.read_verified_calibration(spark, root, "bad homburg", 2024).count() == 2


def test_exports(spark, tmp_path):
    df = spark.createDataFrame(
        [("a", "A", 50.0, 8.0, 10.0, float("nan"), "ok"), ("b", None, 50.0, 8.0, 20.0, 3.0, "critical"), ("c", "C", 50.0, 8.0, 20.0, 5.0, "critical")],
        "counter_id string, name string, latitude double, longitude double, dtv double, dtv_volume_ratio double, flag_severity string",
    )
    records = writers.counter_records(df).collect()
    assert [r["counter_id"] for r in records] == ["c", "b", "a"] and records[2]["ratio"] is None and records[1]["name"] == ""
    path = writers.write_verification_data(df, str(tmp_path / "v"), 2024, Fences(3, 0.1, 9.0, 4.0))
    meta = spark.read.json(f"{path}/metadata").first()
    assert meta["n_flagged"] == 2 and meta["n_by_severity"]["critical"] == 2 and meta["median_ratio"] == 4.0
    path = writers.write_calibration_data(df, str(tmp_path / "c"), 2024, "x")
    assert spark.read.json(f"{path}/counters").count() == 3 and spark.read.json(f"{path}/metadata").first()["mode"] == "calibration"
    feature = json.loads(writers.geojson_features(df).first()["value"])
    assert feature["geometry"]["coordinates"] == [8.0, 50.0] and feature["properties"]["dtv_volume_ratio"] is None
    writers.write_geojson(df, str(tmp_path / "g"))
    assert spark.read.text(str(tmp_path / "g")).count() == 3


def test_prediction_writers(spark, tmp_path):
    df = spark.createDataFrame([(1, 2.5, [(1.0, 2.0), (3.0, 4.0)])], "edge_id int, predicted_dtv double, line array<struct<x:double,y:double>>")
    assert spark.read.parquet(writers.write_predictions(df, str(tmp_path / "p"))).count() == 1
    assert spark.read.option("header", True).csv(writers.write_predictions(df, str(tmp_path / "c"), "csv")).first()["geometry"].startswith("LINESTRING")
    with pytest.raises(ValueError):
        writers.write_predictions(df, str(tmp_path / "x"), "nope")
    rows = spark.createDataFrame([("m", "train", 1.0, 2.0), ("m", "test", 1.0, 2.0)], "model string, split string, y_true double, y_pred double")
    assert spark.read.option("header", True).csv(writers.write_prediction_tables(rows, str(tmp_path / "t"))).where("split = 'test'").count() == 1
    assert spark.read.option("header", True).csv(writers.write_training_table(df.drop("line"), str(tmp_path / "w"))).count() == 1


ETL = "OSM_Radinfra string, TN_SR_relativ double, Streckengewicht_SR double, RegioStaR7 int, Erh_SR bigint, HubDist double, id string, base_id bigint, DZS_mean_SR double"
ETL_ROWS = [("no", 0.01, 0.5, 71, 50, 100.0, "a", 1, 150.0), ("mit_road", 0.02, 0.5, 72, 60, 200.0, "b", 1, 80.0), ("no", 0.01, None, 71, 50, 1.0, "c", 2, 250.0), ("no", 0.01, 0.5, 73, 0, 1.0, "d", -1, 30.0), ("no", 0.01, 0.5, 73, 5, 1.0, "e", -1, 12.0)]


def test_training_data(spark):
    df = spark.createDataFrame(ETL_ROWS, ETL)
    data = prepare_training_data(df, min_dtv=25, min_ratio=0.1, max_ratio=10, test_size=0)
    assert {r["id"] for r in data.train.collect()} == {"a", "d"} and data.target == "dtv"
    assert data.features == ["stadtradeln_volume", "route_intensity", "participation_rate", "infra_category", "regiostar7", "dist_to_center_m"]
    stats = data.stats.first()
    assert (stats["mean"], stats["max"]) == (90.0, 150.0)
    assert feature_columns(df.columns, "DZS_mean_SR", "baseline") == ["Erh_SR"]
    assert feature_columns(["foo", "dtv", "id"], "dtv") == ["foo"]
    with pytest.raises(ValueError):
        target_column(["x"])
    with pytest.raises(ValueError):
        feature_columns(["x"], "y", "baseline")


def test_curated_data(spark):
    rows = [("bicycle_lane_left", 100, 1000, 5, 150.0, 2024, 50.1, 8.1), ("Mixed_Way_Both", 0, 1000, 5, 80.0, 2024, 50.2, 8.2), ("no", 7, 0, 5, 80.0, 2024, 50.2, 8.2), ("no", 7, 10, 5, 80.0, 2023, 50.2, 8.2)]
    df = spark.createDataFrame(rows, "OSM_Radinfra_Simple string, Erh_SR int, Bev_insg int, N_USERS int, DZS_mean_SR double, year int, lat double, lon double").withColumn("RegioStaR7", F.lit(72))
    places = spark.createDataFrame([(8.1, 50.1)], "longitude double, latitude double")
    data = prepare_curated_data(df, places, year=2024, test_size=0)
    row = data.train.first()
    assert data.train.count() == 1 and row["infra_category"] == "bicycle_lane" and row["dist_to_center_m"] == 0.0 and row["participation_rate"] == 0.005
