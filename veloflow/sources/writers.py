"""Writers. Each writes a folder in parallel; only tables bounded by the number of stations are
sorted before writing, and none is forced into one file unless asked."""

from __future__ import annotations

import json
from collections.abc import Mapping

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

from ..functions.geo import line_to_wkt
from ..functions.shapes import shape_to_wkt
from ..functions.numeric import finite_columns
from ..functions.order_stats import quantiles
from ..ml.training import TrainedModel
from ..ml.preprocessing import FeaturePrep, TargetTransform
from ..ml.trees import TreeModel
from ..operators.columns import STATION_CANDIDATES, keep_columns
from ..operators.outliers import Fences
from ..operators.ranking import SEVERITY_RANK, STATION_SEVERITY_RANK, severity_rank, sort_by_severity
from .readers import calibration_path, verified_path

VERIFIED_ORDER = (
    "counter_id",
    "name",
    "latitude",
    "longitude",
    "ars",
    "base_id",
    "count",
    "bicycle_infrastructure",
    "osm_source",
    "verification_status",
    "verified_at",
    "verification_metadata",
    "is_discarded",
    "etl_version",
)


def _as_table(df: DataFrame) -> DataFrame:
    """CSV has no arrays, so a shape or a vertex list is written as WKT text."""
    if "shape" in df.columns:
        return df.withColumn("geometry", shape_to_wkt(F.col("shape"))).drop("shape", "line", "rings")
    if "line" in df.columns:
        df = df.withColumn("geometry", line_to_wkt(F.col("line"))).drop("line")
    return df


def write_training_table(df: DataFrame, path: str, fmt: str = "csv") -> str:
    writer = finite_columns(df).write.mode("overwrite")
    writer.option("header", True).csv(path) if fmt == "csv" else writer.format(fmt).save(path)
    return path


def write_predictions(df: DataFrame, path: str, fmt: str = "parquet") -> str:
    """CSV (lines as WKT) or Parquet; other geometry formats fall back to CSV."""
    if fmt == "parquet":
        df.write.mode("overwrite").parquet(path)
    elif fmt in ("csv", "fgb", "gpkg"):
        _as_table(df).write.mode("overwrite").option("header", True).csv(path)
    else:
        raise ValueError(f"Unsupported format: {fmt}")
    return path


def write_verified_counters(
    df: DataFrame, root: str, year: int, project: str | None = None, etl_version: str | None = None, single_file: bool = False
) -> str:
    """Checked assignments in fixed column order, sorted by counter."""
    if etl_version is not None:
        df = df.withColumn("etl_version", F.lit(etl_version))
    out = keep_columns(df, VERIFIED_ORDER)
    out = (out.coalesce(1).sortWithinPartitions("counter_id") if single_file else out.orderBy("counter_id"))
    path = verified_path(root, year, project)
    out.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_verified_calibration(df: DataFrame, root: str, region: str, year: int, now: str | None = None) -> str:
    """Checked calibration stations; discarded ones stay in the table."""
    if "verified_at" not in df.columns:
        stamp = F.current_timestamp() if now is None else F.lit(now)
        df = df.withColumn("verified_at", stamp.cast("timestamp_ntz"))
    if "is_discarded" not in df.columns:
        df = df.withColumn("is_discarded", F.lit(False))
    path = calibration_path(root, region, year)
    df.write.mode("overwrite").option("header", True).csv(path)
    return path


def write_prediction_tables(predictions: DataFrame, path: str) -> str:
    """Actual and predicted values, one folder per split."""
    table = predictions.select("model", "split", F.col("y_true").alias("actual"), F.col("y_pred").alias("predicted"))
    table.write.mode("overwrite").partitionBy("split").option("header", True).csv(path)
    return path


def _text(df: DataFrame, column: str, default: str = "") -> Column:
    return F.coalesce(F.col(column).cast("string"), F.lit(default)) if column in df.columns else F.lit(default)


def _typed(df: DataFrame, column: str, kind: str) -> Column:
    return F.col(column).cast(kind) if column in df.columns else F.lit(None).cast(kind)


def _bool(df: DataFrame, column: str) -> Column:
    return F.coalesce(F.col(column), F.lit(False)) if column in df.columns else F.lit(False)


def counter_records(df: DataFrame, images: DataFrame | None = None) -> DataFrame:
    """One record per counter for a review tool, most urgent first."""
    df = finite_columns(df)
    if "flag_severity" not in df.columns:
        df = df.withColumn("flag_severity", F.lit("ok"))
    df = df.withColumn("original_id", _typed(df, "id", "string"))
    if images is not None:
        counts = images.groupBy(F.col("counter_id").cast("string").alias("original_id")).agg(F.count("*").alias("image_count"))
        df = df.drop("image_count").join(counts, "original_id", "left")
    candidates = F.col("candidate_edges") if "candidate_edges" in df.columns else F.array().cast("array<struct<distance:double>>")
    if "candidate_edges" in df.columns:
        kind = df.schema["candidate_edges"].dataType.simpleString()
        candidates = F.coalesce(candidates, F.array().cast(kind))
    record = df.select(
        F.col("counter_id").cast("string").alias("counter_id"),
        "original_id",
        _text(df, "name").alias("name"),
        *[_typed(df, c, "double").alias(c) for c in ("latitude", "longitude", "dtv")],
        *[_typed(df, c, "bigint").alias(c) for c in ("base_id", "count")],
        _text(df, "bicycle_infrastructure").alias("bicycle_infrastructure"),
        _typed(df, "dtv_volume_ratio", "double").alias("ratio"),
        _text(df, "flag_severity", "ok").alias("flag_severity"),
        _text(df, "verification_status", "unverified").alias("verification_status"),
        _text(df, "verification_metadata").alias("verification_metadata"),
        *[_bool(df, c).alias(c) for c in ("is_outlier", "has_no_volume", "has_campaign_bias", "is_ambiguous", "is_discarded")],
        candidates.alias("candidate_edges"),
        F.coalesce(_typed(df, "image_count", "bigint"), F.lit(0)).alias("image_count"),
    )
    return sort_by_severity(record, "ratio", tie=["counter_id"])


def export_metadata(df: DataFrame, year: int, fences: Fences, extra: Mapping[str, str] | None = None) -> DataFrame:
    """One row: sizes, severity counts and the fitted limits."""
    severity = F.coalesce(F.col("flag_severity"), F.lit("ok"))
    ranks = list(dict.fromkeys([*SEVERITY_RANK, *STATION_SEVERITY_RANK]))
    counts = df.agg(
        F.count("*").alias("n_counters"),
        F.count_if(~severity.isin("ok", "verified")).alias("n_flagged"),
        F.map_filter(
            F.map_from_arrays(F.array(*[F.lit(s) for s in ranks]), F.array(*[F.count_if(severity == s) for s in ranks])),
            lambda _, n: n > 0,
        ).alias("n_by_severity"),
    )
    return counts.withColumns(
        {
            "year": F.lit(year),
            "median_ratio": F.lit(float(fences.median)),
            "outlier_threshold_lower": F.lit(float(fences.lower)),
            "outlier_threshold_upper": F.lit(float(fences.upper)),
            **{k: F.lit(v) for k, v in (extra or {}).items()},
        }
    )


def write_verification_data(df: DataFrame, path: str, year: int, fences: Fences, images: DataFrame | None = None) -> str:
    """``metadata`` (one row) and ``counters`` (ordered records) as JSON lines."""
    export_metadata(df, year, fences).write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}/metadata")
    counter_records(df, images).write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}/counters")
    return path


STATION_EXTRAS = ("bicycle_infrastructure", "infra_category", "regiostar7")


def station_records(df: DataFrame, dtv: str = "dtv", id_column: str | None = None) -> DataFrame:
    """One record per calibration station, most urgent first, then by size."""
    df = finite_columns(df)

    def first_of(role: str) -> str | None:
        return next((c for c in STATION_CANDIDATES[role] if c in df.columns), None)

    key = id_column or first_of("id")
    if key is None:
        # no id at all: a content hash is stable, a running number would depend on partitions
        df, key = df.withColumn("id", F.xxhash64(*df.columns).cast("string")), "id"
    name, lon, lat = first_of("name"), first_of("longitude"), first_of("latitude")
    severity = _text(df, "flag_severity", "ok")
    record = df.select(
        F.col(key).cast("string").alias("counter_id"),
        (_text(df, name) if name else F.lit("")).alias("name"),
        (_typed(df, lat, "double") if lat else F.lit(None).cast("double")).alias("latitude"),
        (_typed(df, lon, "double") if lon else F.lit(None).cast("double")).alias("longitude"),
        _typed(df, dtv, "double").alias("dtv"),
        severity.alias("flag_severity"),
        _text(df, "flag_reason").alias("flag_reason"),
        _text(df, "verification_status", "unverified").alias("verification_status"),
        _text(df, "verification_metadata").alias("verification_metadata"),
        _bool(df, "is_discarded").alias("is_discarded"),
        *[_typed(df, c, "double").alias(c) for c in ("predicted_dtv", "dtv_pred_ratio")],
        *[_text(df, c).alias(c) for c in STATION_EXTRAS if c in df.columns],
    )
    order = [severity_rank(F.col("flag_severity"), STATION_SEVERITY_RANK)] if "flag_severity" in df.columns else []
    return record.orderBy(*order, F.col("dtv").desc_nulls_last(), "counter_id")


def write_calibration_data(df: DataFrame, path: str, year: int, region: str, dtv: str = "dtv", median_ratio: float | None = None) -> str:
    """Station records and metadata. The median ratio is that of the stations' own ratios, 1 without any."""
    if median_ratio is None:
        found = quantiles(df, "dtv_pred_ratio", {"median": 0.5})["median"] if "dtv_pred_ratio" in df.columns else None
        median_ratio = 1.0 if found is None else float(found)
    limits = Fences(1, 0.33, 3.0, median_ratio)
    flagged = df if "flag_severity" in df.columns else df.withColumn("flag_severity", F.lit("ok"))
    meta = export_metadata(flagged, year, limits, {"region": region, "mode": "calibration"})
    meta.write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}/metadata")
    station_records(df, dtv).write.mode("overwrite").option("ignoreNullFields", False).json(f"{path}/counters")
    return path


GEOJSON_PROPERTIES = (
    "counter_id",
    "name",
    "latitude",
    "longitude",
    "dtv",
    "base_id",
    "count",
    "bicycle_infrastructure",
    "dtv_volume_ratio",
    "is_outlier",
    "flag_severity",
    "verification_status",
)


def geojson_features(df: DataFrame, lon: str = "longitude", lat: str = "latitude") -> DataFrame:
    """One GeoJSON point feature per row as text."""
    df = finite_columns(df)
    point = F.struct(F.lit("Point").alias("type"), F.array(F.col(lon), F.col(lat)).alias("coordinates"))
    properties = F.struct(*[c for c in GEOJSON_PROPERTIES if c in df.columns])
    feature = F.struct(F.lit("Feature").alias("type"), point.alias("geometry"), properties.alias("properties"))
    return df.select(F.to_json(feature, {"ignoreNullFields": "false"}).alias("value"))


def write_geojson(df: DataFrame, path: str) -> str:
    """Newline-delimited features, which stay splittable."""
    geojson_features(df).write.mode("overwrite").text(path)
    return path


def save_calibrator(calibrator, spark: SparkSession, path: str, metrics: DataFrame | None = None) -> str:
    """Parameters as JSON, per-stratum parameters as a table, metrics beside them."""
    params = json.dumps(calibrator.params(), sort_keys=True)
    spark.createDataFrame([(params,)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/params")
    if hasattr(calibrator, "table"):
        calibrator.table.write.mode("overwrite").parquet(f"{path}/strata")
    if metrics is not None:
        metrics.coalesce(1).write.mode("overwrite").json(f"{path}/metrics")
    return path


def load_calibrator(spark: SparkSession, path: str):
    """Fitted calibrator from its parameters."""
    from ..operators.additive import Additive
    from ..operators.calibration import GlobalMultiplicative, LogLinear, Stratified

    saved = json.loads(spark.read.text(f"{path}/params").first()["value"])
    p, n = saved["params"], saved["n_stations"]

    def plain(values: Mapping) -> GlobalMultiplicative | LogLinear:
        if "factor" in values:
            return GlobalMultiplicative(factor=values["factor"], n_stations=n)
        return LogLinear(alpha=values["alpha"], a=values["a"], b=values["b"], n_stations=n)

    if saved["calibrator_type"] == "additive":
        return Additive.restored(p, spark.read.parquet(f"{path}/strata"))
    if saved["calibrator_type"] != "stratified":
        return plain(p)
    return Stratified(
        tuple(p["stratify_by"]),
        p["min_n_per_stratum"],
        p["base"],
        p["global_params"].get("alpha", 1.0),
        global_=plain(p["global_params"]),
        table=spark.read.parquet(f"{path}/strata"),
        n_stations=n,
    )


def save_model(trained: TrainedModel, spark: SparkSession, path: str) -> str:
    """Spark ML model plus a sidecar with features, scaler numbers and target transform."""
    if isinstance(trained.model, TreeModel):
        spark.createDataFrame([(trained.model.to_json(),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/model")
    else:
        trained.model.write().overwrite().save(f"{path}/model")
    side = {
        "name": trained.name,
        "class": f"{type(trained.model).__module__}.{type(trained.model).__name__}",
        "features": trained.features,
        "numbers": trained.prep.numbers,
        "target": {"kind": trained.target.kind, "clip_max": trained.target.clip_max},
        "best_params": trained.best_params,
        "training_time_s": trained.training_time_s,
    }
    spark.createDataFrame([(json.dumps(side),)], "value string").coalesce(1).write.mode("overwrite").text(f"{path}/sidecar")
    return path


MODEL_CLASSES = ("LinearRegressionModel", "GeneralizedLinearRegressionModel", "RandomForestRegressionModel", "GBTRegressionModel")


def load_model(spark: SparkSession, path: str) -> TrainedModel:
    from pyspark.ml import regression

    side = json.loads(spark.read.text(f"{path}/sidecar").first()["value"])
    kind = side["class"].rsplit(".", 1)[-1]
    if kind == "TreeModel":
        model = TreeModel.from_json(spark.read.text(f"{path}/model", wholetext=True).first()["value"])
    elif kind in MODEL_CLASSES:
        model = getattr(regression, kind).load(f"{path}/model")
    else:
        raise ValueError(f"Unknown model class: {kind}")
    return TrainedModel(
        side["name"],
        model,
        FeaturePrep(side["features"], side["numbers"]),
        TargetTransform(**side["target"]),
        side["features"],
        side["best_params"],
        side["training_time_s"],
    )
