"""Sources and sinks on the driver tables: tables are shaped as delivered, written to a new folder and read back."""

from __future__ import annotations

from pyspark.sql import functions as F

from ..functions.numeric import ratio
from ..operators import calibration as cal
from ..operators.additive import Additive, RatioOfSums
from ..operators.columns import INTERNAL_NAMES, detect_station_columns, keep_columns, missing_columns, rename
from ..operators.contracts import Contract, Rule, list_contracts, rule_names
from ..operators.features import CAMPAIGN_FEATURES, Feature, FeatureRegistry, derive_features
from ..session import scratch_path
from ..sources import readers, writers
from ..sources.checked import write_checked
from . import stand_ins as t
from .registry import query, rounded, table


@query("counter_locations_csv", "SELECT lpad(CAST(s_suppkey AS VARCHAR), CAST(greatest(3, length(CAST(s_suppkey AS VARCHAR))) AS INTEGER), '0') AS id, s_name AS name, round(s_acctbal, 2) AS dtv FROM supplier")
def counter_locations_csv(spark, sf):
    """A delivered list with semicolons, read back under internal names."""
    path = scratch_path(spark, "locations")
    s = table(spark, sf, "supplier").select(F.col("s_suppkey").alias("Counter_ID_orig"), F.col("s_name").alias("name"), F.round("s_acctbal", 2).alias("DZS_mean_SR"))
    s.write.option("header", True).option("sep", ";").csv(path)
    return readers.read_counter_locations(spark, path).select("id", "name", "dtv")


@query("traffic_csv", t.sql("SELECT edge_id, base_id, count FROM edge", "edge"))
def traffic_csv(spark, sf):
    """S3: German column names, one column too many, lines as text."""
    path = scratch_path(spark, "traffic")
    e = t.edge(spark, sf).select(F.col("edge_id").alias("KantenId"), F.col("base_id").alias("GrundlagenId"), F.col("count").alias("Verkehrsmenge"), F.lit("x").alias("rest"))
    e.write.option("header", True).option("sep", ";").csv(path + ".csv")
    return readers.read_traffic_volumes(spark, path + ".csv").select("edge_id", "base_id", "count")


@query("regiostar_csv", "SELECT lpad(CAST(c_custkey * 1000003 AS VARCHAR), CAST(greatest(12, length(CAST(c_custkey * 1000003 AS VARCHAR))) AS INTEGER), '0') AS ars, CAST(51 + c_custkey % 5 AS BIGINT) AS regiostar5, CAST(71 + c_custkey % 7 AS BIGINT) AS regiostar7 FROM customer")
def regiostar_csv(spark, sf):
    """Windows-1252 file with semicolons."""
    path = scratch_path(spark, "regiostar")
    k = F.col("c_custkey")
    rows = table(spark, sf, "customer").select((k * 1000003).alias("gemrs_22"), (k % 5 + 51).alias("RegioStaR5"), (k % 7 + 71).alias("RegioStaR7"), F.lit("Köln").alias("name"))
    rows.write.option("header", True).option("sep", ";").option("encoding", "ISO-8859-1").csv(path)
    out = readers.read_regiostar(spark, path)
    return out.select("ars", F.col("regiostar5").cast("bigint"), F.col("regiostar7").cast("bigint"))


@query("demographics_json", t.sql("SELECT ars, n_users, n_trips, total_km FROM commune WHERE starts_with(ars, '03')", "commune"))
def demographics_json(spark, sf):
    """Records under delivered names; the region key keeps the members of one land."""
    path = scratch_path(spark, "communes") + ".json"
    c = t.commune(spark, sf).select("ars", F.col("n_users").alias("users_n"), F.col("n_trips").alias("trips_n"), F.col("total_km").alias("distance_km"), F.col("k").alias("extra"))
    c.write.json(path)
    return readers.demographics(readers.commune_records(spark.read.json(path)), "030000000000").select("ars", "n_users", "n_trips", "total_km")


@query("campaign_csv", "SELECT o_orderkey AS k, CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) AS start_date, CASE WHEN o_orderkey % 3 = 0 THEN NULL ELSE CAST(date_trunc('day', o_orderdate) AS TIMESTAMP) END AS end_date FROM orders WHERE extract(year FROM o_orderdate) = 1997")
def campaign_csv(spark, sf):
    """Dates in two notations, some unreadable; the campaigns of one year."""
    path = scratch_path(spark, "campaign")
    day = F.to_date("o_orderdate")
    rows = table(spark, sf, "orders").select(
        F.col("o_orderkey").alias("k"), F.year(day).alias("year"), F.date_format(day, "dd.MM.yyyy").alias("start_date"),
        F.when(F.col("o_orderkey") % 3 == 0, F.lit("soon")).otherwise(F.date_format(day, "yyyy-MM-dd")).alias("end_date"),
    )
    rows.write.option("header", True).option("sep", ";").csv(path)
    out = readers.read_campaign_metadata(spark, path, 1997)
    return out.select(F.col("k").cast("bigint").alias("k"), "start_date", "end_date")


@query("training_csv", t.sql('SELECT id, base_id, round("DZS_mean_SR", 6) AS "DZS_mean_SR", "OSM_Radinfra" FROM training', "training"))
def training_csv(spark, sf):
    """K1, and S18 to read it back."""
    path = writers.write_training_table(t.training(spark, sf), scratch_path(spark, "training") + ".csv")
    back = readers.read_any(spark, path)
    return rounded(back.select("id", F.col("base_id").cast("bigint").alias("base_id"), F.col("DZS_mean_SR").cast("double").alias("DZS_mean_SR"), "OSM_Radinfra"))


@query("predictions_parquet", t.sql("SELECT edge_id, base_id, count FROM edge", "edge"))
def predictions_parquet(spark, sf):
    """K2."""
    return spark.read.parquet(writers.write_predictions(t.edge(spark, sf), scratch_path(spark, "predictions"))).select("edge_id", "base_id", "count")


@query("predictions_wkt", t.sql("SELECT edge_id, TRUE AS is_line, round(lon1, 6) AS x1, round(lat1, 6) AS y1, round(lon2, 6) AS x2, round(lat2, 6) AS y2 FROM edge", "edge"))
def predictions_wkt(spark, sf):
    """K3: lines as text, and their coordinates in it."""
    back = spark.read.option("header", True).csv(writers.write_predictions(t.edge(spark, sf), scratch_path(spark, "predictions"), "csv"))
    numbers = F.regexp_extract_all("geometry", F.lit(r"[-+.\deE]*\d[-+.\deE]*"), F.lit(0))
    ends = [F.get(numbers, F.lit(i)).cast("double").alias(c) for i, c in enumerate(("x1", "y1", "x2", "y2"))]
    out = back.select(F.col("edge_id").cast("bigint").alias("edge_id"), F.col("geometry").startswith("LINESTRING").alias("is_line"), *ends)
    return rounded(out, 6)


@query("verified_csv", t.sql("SELECT counter_id, CAST(k * 3 AS BIGINT) AS base_id, k % 4 = 0 AS is_discarded, 'v1' AS etl_version FROM counter", "counter"))
def verified_csv(spark, sf):
    """Column order, version, flags that are missing count as kept."""
    k = F.col("k")
    checked = t.counter(spark, sf).select("counter_id", (k * 3).alias("base_id"), F.when(k % 4 == 0, True).when(k % 4 == 1, False).alias("is_discarded"), F.lit("unused").alias("other"))
    root = scratch_path(spark, "verified")
    writers.write_verified_counters(checked, root, 2024, "p", "v1")
    return readers.read_verified_counters(spark, root, 2024, "p").select("counter_id", "base_id", "is_discarded", "etl_version")


@query("verified_stations_csv", t.sql("SELECT counter_id, FALSE AS is_discarded, TIMESTAMP '2024-05-01 00:00:00' AS verified_at FROM counter", "counter"))
def verified_stations_csv(spark, sf):
    """K5: defaults are filled in."""
    root = scratch_path(spark, "stations")
    writers.write_verified_calibration(t.counter(spark, sf).select("counter_id"), root, "Some Land", 2024, "2024-05-01 00:00:00")
    return readers.read_verified_calibration(spark, root, "Some Land", 2024).select("counter_id", "is_discarded", "verified_at")


@query("prediction_tables", t.sql("SELECT CASE WHEN id % 5 = 0 THEN 'test' ELSE 'train' END AS split, CAST(count(*) AS BIGINT) AS n, round(sum(y_true), 2) AS actual FROM scored GROUP BY 1", "scored"))
def prediction_tables(spark, sf):
    """K6: one folder for each part of the split."""
    rows = t.scored(spark, sf).select(F.lit("m").alias("model"), F.when(F.col("id") % 5 == 0, "test").otherwise("train").alias("split"), "y_true", "y_pred")
    back = spark.read.option("header", True).csv(writers.write_prediction_tables(rows, scratch_path(spark, "tables")))
    return back.groupBy("split").agg(F.count("*").alias("n"), F.round(F.sum(F.col("actual").cast("double")), 2).alias("actual"))


FACTOR = "coalesce(least(greatest(median(CASE WHEN y_pred > 0 AND y_true >= 0 THEN y_true / y_pred END), 0.1::DOUBLE), 10), 1)"


@query(
    "calibrator_state_round_trip",
    t.sql(
        """SELECT stratum, CAST(count(*) AS BIGINT) AS n, round(coalesce(least(greatest(sum(CASE WHEN y_pred > 0 AND y_true >= 0 THEN y_true END)
             / sum(CASE WHEN y_pred > 0 AND y_true >= 0 THEN y_pred END), 0.1::DOUBLE), 10), 1), 8) AS factor FROM station GROUP BY 1 HAVING count(*) >= 40""",
        "station",
    ),
)
def calibrator_state_round_trip(spark, sf):
    """A state is saved and loaded, and takes in the stations that came later."""
    s = t.station(spark, sf)
    early, late = (Additive(RatioOfSums(), ("stratum",), 40).fit(s.where((F.col("id") % 3 == 0) == is_late)) for is_late in (False, True))
    loaded = writers.load_calibrator(spark, writers.save_calibrator(early, spark, scratch_path(spark, "calibrator")))
    return rounded(loaded.merge(late).strata(), 8)


@query("calibrator_round_trip", t.sql(f"SELECT id, round(y_pred * (SELECT {FACTOR} FROM station), 6) AS y_calibrated FROM station", "station"))
def calibrator_round_trip(spark, sf):
    """A calibrator is fitted, saved, loaded and applied."""
    s = t.station(spark, sf)
    loaded = writers.load_calibrator(spark, writers.save_calibrator(cal.GlobalMultiplicative().fit(s), spark, scratch_path(spark, "calibrator")))
    return rounded(loaded.apply(s).select("id", "y_calibrated"))


@query(
    "registered_feature",
    t.sql("SELECT k, round(CASE WHEN n_users > 0 THEN total_km / n_users END, 6) AS km_each, CAST(0 AS BIGINT) AS n_unmet FROM commune", "commune"),
)
def registered_feature(spark, sf):
    """A feature of one's own; the columns it needs are known before it is derived."""
    registry = FeatureRegistry(CAMPAIGN_FEATURES)
    registry.register(Feature("km_each", lambda: F.when(F.col("n_users") > 0, ratio(F.col("total_km"), F.col("n_users"))), ("total_km", "n_users"), "kilometres of each"))
    c = t.commune(spark, sf)
    unmet = len(registry.missing_needs(["km_each"], c.columns))
    out = derive_features(c, ["km_each"], registry).select("k", "km_each")
    return rounded(out).withColumn("n_unmet", F.lit(unmet).cast("bigint"))


@query("own_names", "SELECT c_custkey AS counter_id, c_acctbal AS dtv FROM customer")
def own_names(spark, sf):
    """A mapping of one's own, the columns wanted, the station's columns by their candidates."""
    named = rename(table(spark, sf, "customer"), {**INTERNAL_NAMES, "c_custkey": "counter_id", "c_acctbal": "DZS_mean_SR"})
    found = detect_station_columns(named.columns)
    missing_columns(named, [found["id"], found["dtv"]], raise_on_missing=True)
    return keep_columns(named, ["absent", found["id"], found["dtv"]]).withColumnRenamed(found["dtv"], "dtv")


@query("contract_roles", "SELECT CAST(count(*) AS BIGINT) AS n_regions, TRUE AS all_known FROM region")
def contract_roles(spark, sf):
    """V3: what the registry lists is what it can give."""
    from ..operators.contracts import get_contract

    known = all(get_contract(n).name for n in list_contracts())
    return table(spark, sf, "region").agg(F.count("*").alias("n_regions")).withColumn("all_known", F.lit(known))


ORDER_CONTRACT = Contract(
    "orders",
    (
        Rule("o_orderkey", "bigint", unique=True),
        Rule("o_custkey", "bigint"),
        Rule("o_totalprice", "double", at_least=20_000, at_most=200_000),
        Rule("o_orderstatus", "string", allowed=("F", "O")),
    ),
)
_ORDER_RULES = """SELECT o_orderkey, o_totalprice < 20000 AS low, o_totalprice > 200000 AS high, o_orderstatus NOT IN ('F', 'O') AS other,
                         o_orderkey IS NULL AS missing, count(*) OVER (PARTITION BY o_orderkey) > 1 AS twice
                  FROM (SELECT o_orderkey // 2 * (o_orderkey % 10 // 9) + o_orderkey * (1 - o_orderkey % 10 // 9) AS o_orderkey, o_totalprice, o_orderstatus FROM orders)"""


@query(
    "checked_write",
    f"""WITH r AS ({_ORDER_RULES}), s AS (SELECT *, low OR high OR other OR missing OR twice AS bad FROM r)
        SELECT 'rows' AS item, count(*) AS observed, count(*) AS stored FROM s
        UNION ALL SELECT 'kept', count(*) FILTER (WHERE NOT bad), count(*) FILTER (WHERE NOT bad) FROM s
        UNION ALL SELECT 'o_totalprice:at_least_20000', count(*) FILTER (WHERE low), count(*) FILTER (WHERE low) FROM s
        UNION ALL SELECT 'o_totalprice:at_most_200000', count(*) FILTER (WHERE high), count(*) FILTER (WHERE high) FROM s
        UNION ALL SELECT 'o_orderstatus:allowed', count(*) FILTER (WHERE other), count(*) FILTER (WHERE other) FROM s
        UNION ALL SELECT 'o_orderkey:unique', count(*) FILTER (WHERE twice), count(*) FILTER (WHERE twice) FROM s""",
)
def checked_write(spark, sf):
    """V1, V2: orders under a contract, some keys made equal; counts seen during the write beside those of the files."""
    k = F.col("o_orderkey")
    key = F.when(k % 10 == 9, F.floor(k / 2)).otherwise(k).cast("bigint")
    orders = table(spark, sf, "orders").select(key.alias("o_orderkey"), "o_custkey", "o_totalprice", "o_orderstatus")
    done = write_checked(orders, ORDER_CONTRACT, scratch_path(spark, "checked"))
    names = [n for n in rule_names(ORDER_CONTRACT, orders.columns) if n in done.failed]
    observed = [("rows", done.n_rows), ("kept", done.n_kept), *[(n, done.failed[n]) for n in names]]
    stored = (
        done.aside().select(F.explode("failed_rules").alias("item")).groupBy("item").agg(F.count("*").alias("stored"))
        .unionByName(done.kept().agg(F.count("*").alias("stored")).withColumn("item", F.lit("kept")))
        .unionByName(done.kept().select(F.lit(1)).unionAll(done.aside().select(F.lit(1))).agg(F.count("*").alias("stored")).withColumn("item", F.lit("rows")))
    )
    return spark.createDataFrame(observed, "item string, observed bigint").join(stored, "item", "full")


@query("infrastructure_csv", t.sql("SELECT edge_id AS osm_id, raw AS bicycle_infrastructure FROM edge_class", "edge_class"))
def infrastructure_csv(spark, sf):
    """Classified ways with a column too many; an absent class stays missing."""
    path = scratch_path(spark, "ways")
    ways = t.edge_class(spark, sf).select(F.col("edge_id").alias("osm_id"), F.col("raw").alias("bicycle_infrastructure"), F.lit("x").alias("other"))
    ways.write.option("header", True).csv(path)
    return readers.read_osm_infrastructure(spark, path).select(F.col("osm_id").cast("bigint").alias("osm_id"), "bicycle_infrastructure")


@query("centroids_csv", t.sql("SELECT k AS id, longitude, latitude FROM place", "place"))
def centroids_csv(spark, sf):
    """Places whose coordinates are only in a POINT text."""
    path = scratch_path(spark, "centroids") + ".csv"
    point = F.concat(F.lit("POINT ("), F.col("longitude").cast("string"), F.lit(" "), F.col("latitude").cast("string"), F.lit(")"))
    t.place(spark, sf).select(F.col("k").alias("ID"), F.lit("Köln").alias("Name"), point.alias("geometry")).write.option("header", True).csv(path)
    return readers.read_city_centroids(spark, path).select(F.col("id").cast("bigint").alias("id"), "longitude", "latitude")


@query("demographics_csv", t.sql("SELECT ars AS \"ARS\", n_users, total_km FROM commune", "commune"))
def demographics_csv(spark, sf):
    """Keys that lost their leading zeros get them back."""
    path = scratch_path(spark, "participation")
    rows = t.commune(spark, sf).select(F.regexp_replace("ars", "^0+", "").alias("ARS"), "n_users", "total_km")
    rows.write.option("header", True).option("sep", ";").csv(path)
    back = readers.read_demographics_csv(spark, path)
    return back.select("ARS", F.col("n_users").cast("bigint").alias("n_users"), F.col("total_km").cast("double").alias("total_km"))
