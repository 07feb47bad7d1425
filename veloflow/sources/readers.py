"""Readers of the input tables. Paths are arguments; nothing is inferred beyond a header line."""

from __future__ import annotations

import warnings
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, functions as F
from pyspark.sql import types as T
from pyspark.errors import AnalysisException

from ..functions.geo import line_from_wkt
from ..functions.shapes import shape_from_wkt, shape_rings
from ..functions.numeric import finite, finite_columns
from ..functions.region_keys import pad_left
from ..operators.admin_units import filter_region, units_at_level
from ..operators.columns import keep_columns, normalize_region_keys, rename
from ..operators.contracts import require_valid_stations

# Delivery names -> internal names, per table.
LOCATION_NAMES = {
    "ID": "id",
    "Counter_ID_orig": "id",
    "Name": "name",
    "Counter_Name": "name",
    "Latitude": "latitude",
    "lat": "latitude",
    "Longitude": "longitude",
    "lon": "longitude",
    "ARS": "ars",
    "DZS_mean_SR": "dtv",
}
TRAFFIC_NAMES = {
    "KantenId": "edge_id",
    "GrundlagenId": "base_id",
    "Verkehrsmenge": "count",
    "VerkehrsmengeIn": "count_forward",
    "VerkehrsmengeGegen": "count_backward",
    "GeschwIn": "speed_forward_kmh",
    "GeschwGegen": "speed_backward_kmh",
}
TRAFFIC_COLUMNS = (*TRAFFIC_NAMES.values(), "bicycle_infrastructure", "line")
TRAFFIC_REQUIRED = ("edge_id", "base_id", "count")
MUNICIPALITY_NAMES = {
    "Regionalschlüssel_ARS": "ars",
    "ARS": "ars",
    "GeografischerName_GEN": "name",
    "GEN": "name",
    "Einwohnerzahl_EWZ": "population",
    "EWZ": "population",
    "Land": "land",
}
REGIOSTAR_NAMES = {"gemrs_22": "ars", "RegioStaR5": "regiostar5", "RegioStaR7": "regiostar7"}
CAMPAIGN_NAMES = {
    "ags": "ars",
    "AGS": "ars",
    "ARS": "ars",
    "Year": "year",
    "start": "start_date",
    "Start": "start_date",
    "end": "end_date",
    "Ende": "end_date",
    "End": "end_date",
}
DEMOGRAPHIC_NAMES = {
    "ARS": "ars",
    "N_USERS": "n_users",
    "N_TRIPS": "n_trips",
    "TOTAL_KM": "total_km",
    "BUNDESLAND": "bundesland",
}
COMMUNE_NAMES = {"ars": "ARS", "name": "GEN", "users_n": "N_USERS", "trips_n": "N_TRIPS", "distance_km": "TOTAL_KM"}
UNIT_NAMES = {"ARS": "ars", "Type": "admin_level", "Name": "name"}
# Names of the time column, month names.
TIME_COLUMNS = ("Zeit", "Time", "timestamp", "date", "Date")
GERMAN_MONTHS = {
    "Januar": "01",
    "Februar": "02",
    "März": "03",
    "April": "04",
    "Mai": "05",
    "Juni": "06",
    "Juli": "07",
    "August": "08",
    "September": "09",
    "Oktober": "10",
    "November": "11",
    "Dezember": "12",
}
GERMAN_DATE = r"^\S+\s+(\d{1,2})\.?\s+(\p{L}+)\s+(\d{4})"


def first_lines(spark: SparkSession, path: str, n: int, encoding: str = "UTF-8") -> list[str]:
    """First lines of a text file, for its header only."""
    lines = spark.read.option("encoding", _file_encoding(encoding)).text(path).head(n)
    return [r["value"].lstrip("﻿") for r in lines]


def sniff_separator(spark: SparkSession, path: str, encoding: str = "UTF-8") -> str:
    head = first_lines(spark, path, 1, encoding)
    return ";" if head and len(head[0].split(";")) > 1 else ","


WINDOWS_1252 = ("windows-1252", "cp1252")


def _windows_letters() -> tuple[str, str]:
    """Characters in which Windows-1252 differs from ISO-8859-1, as read and as meant."""
    pairs = []
    for code in range(0x80, 0xA0):
        try:
            pairs.append((chr(code), bytes([code]).decode("cp1252")))
        except UnicodeDecodeError:
            continue  # unassigned
    return "".join(a for a, _ in pairs), "".join(b for _, b in pairs)


def _file_encoding(encoding: str) -> str:
    """Spark reads ISO-8859-1 but not Windows-1252, see :func:`_windows_letters`."""
    return "ISO-8859-1" if encoding.lower() in WINDOWS_1252 else encoding


def read_csv(
    spark: SparkSession, path: str, sep: str | None = None, encoding: str = "UTF-8", schema: T.StructType | str | None = None
) -> DataFrame:
    """CSV with a header as text columns (cast later), or with a stated schema."""
    reader = spark.read.option("header", True).option("encoding", _file_encoding(encoding))
    reader = reader.option("sep", sep or sniff_separator(spark, path, encoding))
    df = (reader.schema(schema) if schema is not None else reader).csv(path)
    if encoding.lower() in WINDOWS_1252:
        texts = [f.name for f in df.schema.fields if isinstance(f.dataType, T.StringType)]
        df = df.withColumns({c: F.translate(F.col(f"`{c}`"), *_windows_letters()) for c in texts})
    return df


def _numbers(df: DataFrame, doubles: Sequence[str] = (), longs: Sequence[str] = ()) -> DataFrame:
    new: dict[str, Column] = {c: finite(F.col(c).cast("string").try_cast("double")) for c in doubles if c in df.columns}
    new.update({c: F.floor(F.col(c).cast("string").try_cast("double")).cast("bigint") for c in longs if c in df.columns})
    return df.withColumns(new) if new else df


def counter_locations(df: DataFrame) -> DataFrame:
    df = rename(df, LOCATION_NAMES)
    if "id" in df.columns:
        df = df.withColumn("id", pad_left(F.col("id"), 3))
    return _numbers(df, ("latitude", "longitude", "dtv"))


def read_counter_locations(spark: SparkSession, path: str) -> DataFrame:
    return counter_locations(read_csv(spark, path))


def measurement_timestamp(c: Column) -> Column:
    """Time of a measurement; whichever of the known notations a value has is read. NULL for anything else.

    ISO and day-first numbers carry a clock time; the German notation is a weekday, a day with a full stop, a month by
    name and a year.
    """
    month = F.element_at(F.create_map(*(F.lit(x) for pair in GERMAN_MONTHS.items() for x in pair)), F.regexp_extract(c, GERMAN_DATE, 2))
    german = F.concat_ws(" ", F.regexp_extract(c, GERMAN_DATE, 1), month, F.regexp_extract(c, GERMAN_DATE, 3))
    typed = (
        F.try_to_timestamp(c, F.lit("yyyy-MM-dd HH:mm:ss")),
        F.try_to_timestamp(c, F.lit("dd-MM-yyyy HH:mm:ss")),
        F.try_to_timestamp(F.when(month.isNotNull(), german), F.lit("d MM yyyy")),
    )
    return F.coalesce(*typed).cast("timestamp_ntz")


def measurements_to_long(wide: DataFrame, time_column: str | None = None) -> DataFrame:
    """One row per counter and time; cells that are not numbers are dropped."""
    time_column = time_column or next((c for c in TIME_COLUMNS if c in wide.columns), None)
    if time_column is None or time_column not in wide.columns:
        raise ValueError("Could not find timestamp column in counter measurements")
    counters = [c for c in wide.columns if c != time_column]
    is_text = isinstance(wide.schema[time_column].dataType, T.StringType)
    stamp = measurement_timestamp(F.col(time_column)) if is_text else F.col(time_column).cast("timestamp_ntz")
    typed = wide.select(stamp.alias("timestamp"), *[F.col(f"`{c}`").cast("string").alias(c) for c in counters])
    long = typed.unpivot("timestamp", [f"`{c}`" for c in counters], "counter_id", "count")
    value = finite(F.trim("count").try_cast("double"))
    return long.select(
        "timestamp", F.trim(F.replace("counter_id", F.lit("`"), F.lit(""))).alias("counter_id"), value.cast("bigint").alias("count")
    ).dropna(subset=["timestamp", "count"])


def read_counter_measurements(spark: SparkSession, path: str, encoding: str = "UTF-8") -> DataFrame:
    """Wide measurement file with two preamble lines above its header.

    The file is scanned in splits with the header's columns as schema. Preamble and header rows
    have no readable time and drop out with the other unreadable rows.
    """
    lines = first_lines(spark, path, 3, encoding)
    if len(lines) < 3:
        raise ValueError("Could not find timestamp column in counter measurements")
    names = [c.strip().strip('"') for c in lines[2].split(",")]
    schema = T.StructType([T.StructField(n, T.StringType()) for n in names])
    time_column = next((c for c in TIME_COLUMNS if c in names), None)
    if time_column is None:
        raise ValueError("Could not find timestamp column in counter measurements")
    rows = spark.read.schema(schema).option("header", False).option("encoding", _file_encoding(encoding)).csv(path)
    return measurements_to_long(rows, time_column)


def traffic_volumes(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Edges under internal names with only the needed columns; WKT of one or several lines becomes a vertex list."""
    if "geometry" in df.columns and "line" not in df.columns:
        df = df.withColumn("line", line_from_wkt(F.col("geometry")))
    if "KantenId" in df.columns:
        df = rename(df, TRAFFIC_NAMES)
    missing = [c for c in TRAFFIC_REQUIRED if c not in df.columns]
    if missing:
        warnings.warn(f"Traffic volumes lack required columns: {missing}", stacklevel=2)
    wanted = columns if columns is not None else TRAFFIC_COLUMNS
    df = keep_columns(df, wanted)
    return _numbers(df, ("speed_forward_kmh", "speed_backward_kmh"), ("edge_id", "base_id", "count", "count_forward", "count_backward"))


def read_traffic_volumes(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    return traffic_volumes(read_any(spark, path), columns)


def read_osm_infrastructure(spark: SparkSession, path: str) -> DataFrame | None:
    """Classified ways, or None when the table is absent or empty."""
    try:
        df = read_csv(spark, path, ",")
    except AnalysisException:
        return None
    df = keep_columns(df, ("osm_id", "bicycle_infrastructure", "surface_cat"))
    return None if df.isEmpty() else df


def _with_rings(df: DataFrame) -> DataFrame:
    """``shape`` and ``rings`` from a geometry text where the table brings no rings of its own."""
    if "geometry" not in df.columns or "rings" in df.columns:
        return df
    # a generator row keeps the optimizer from parsing the text again for each use
    shaped = df.select("*", F.inline(F.array(F.struct(shape_from_wkt(F.col("geometry")).alias("shape")))))
    return shaped.withColumn("rings", shape_rings(F.col("shape")))


def geometry_report(df: DataFrame, column: str = "geometry") -> DataFrame:
    """Rows by ``kind`` of a geometry text, in one pass: a kind of shape, ``EMPTY``, ``MISSING`` or ``UNREADABLE``.

    Only the last are a loss: rows whose text is there but gives no shape, so that spatial joins pass over them.
    """
    shape = shape_from_wkt(F.col(column))
    kind = (
        F.when(F.col(column).isNull() | (F.trim(column) == ""), "MISSING")
        .when(shape.isNull(), "UNREADABLE")
        .when(F.size(shape["parts"]) == 0, "EMPTY")
        .otherwise(shape["kind"])
    )
    return df.groupBy(kind.alias("kind")).agg(F.count("*").alias("n"))


def municipalities(df: DataFrame, land_code: str = "00") -> DataFrame:
    if land_code != "00":
        df = df.where(F.col("Land") == land_code)
    return keep_columns(rename(_with_rings(df), MUNICIPALITY_NAMES), ("ars", "name", "population", "land", "rings", "shape"))


def read_municipalities(spark: SparkSession, path: str, land_code: str = "00") -> DataFrame:
    return municipalities(read_any(spark, path), land_code)


def regiostar(df: DataFrame) -> DataFrame:
    df = rename(df, REGIOSTAR_NAMES)
    if "ars" in df.columns:
        df = df.withColumn("ars", pad_left(F.col("ars")))
    return _numbers(keep_columns(df, ("ars", "regiostar5", "regiostar7")), longs=("regiostar5", "regiostar7"))


def read_regiostar(spark: SparkSession, path: str, encoding: str = "windows-1252") -> DataFrame:
    return regiostar(read_csv(spark, path, ";", encoding))


def city_centroids(df: DataFrame) -> DataFrame:
    """Places with coordinates, taken from a POINT text where columns are missing."""
    df = rename(df, {"ID": "id", "Name": "name"})
    if "geometry" in df.columns:
        for column, part in (("longitude", 1), ("latitude", 2)):
            if column not in df.columns:
                number = F.regexp_extract("geometry", r"(?i)POINT\s*\(\s*([-+.\deE]+)\s+([-+.\deE]+)\s*\)", part)
                df = df.withColumn(column, number.try_cast("double"))
    return _numbers(df, ("longitude", "latitude"))


def read_city_centroids(spark: SparkSession, path: str) -> DataFrame:
    return city_centroids(read_any(spark, path))


def admin_units(df: DataFrame, level: str, land_code: str = "00") -> DataFrame:
    picked = units_at_level(rename(df, UNIT_NAMES), level, land_code)
    return keep_columns(_with_rings(picked), ("ars", "admin_level", "name", "rings", "shape"))


def read_admin_units(spark: SparkSession, path: str, level: str, land_code: str = "00") -> DataFrame:
    return admin_units(read_any(spark, path), level, land_code)


def campaign_metadata(df: DataFrame, year: int | None = None) -> DataFrame:
    """Campaigns of a year; dates that cannot be read become NULL."""
    df = rename(df, CAMPAIGN_NAMES)
    if "year" in df.columns:
        df = df.withColumn("year", F.col("year").cast("string").try_cast("int"))
        df = df if year is None else df.where(F.col("year") == year)
    if "ars" in df.columns:
        df = df.withColumn("ars", pad_left(F.col("ars")))
    for c in ("start_date", "end_date"):
        if c in df.columns:
            text = F.trim(F.col(c).cast("string"))
            day = F.coalesce(text.try_cast("timestamp_ntz"), F.try_to_timestamp(text, F.lit("dd.MM.yyyy")).cast("timestamp_ntz"))
            df = df.withColumn(c, day)
    return df


def read_campaign_metadata(
    spark: SparkSession, path: str, year: int, encoding: str | None = None, sep: str | None = None
) -> DataFrame:
    """Campaign table; encoding and separator are the file's own unless stated."""
    return campaign_metadata(read_csv(spark, path, sep, encoding or text_encoding(spark, path)), year)


def read_demographics_csv(spark: SparkSession, path: str, encoding: str | None = None) -> DataFrame:
    df = read_csv(spark, path, encoding=encoding or text_encoding(spark, path))
    return df.withColumn("ARS", pad_left(F.col("ARS"))) if "ARS" in df.columns else df


def commune_records(df: DataFrame) -> DataFrame:
    df = df.withColumnsRenamed({k: v for k, v in COMMUNE_NAMES.items() if k in df.columns})
    return df.withColumn("ARS", pad_left(F.col("ARS"))) if "ARS" in df.columns else df


def read_demographics_json(spark: SparkSession, path: str, schema: T.StructType | str | None = None) -> DataFrame:
    """Array of records; fields beyond the known ones are kept."""
    reader = spark.read.option("multiLine", True).option("primitivesAsString", schema is None)
    return commune_records((reader.schema(schema) if schema is not None else reader).json(path))


def demographics(df: DataFrame, region_key: str = "00") -> DataFrame:
    """Participation of a region under internal names."""
    key = "ARS" if "ARS" in df.columns else "ars"
    df = rename(filter_region(df, region_key, key), DEMOGRAPHIC_NAMES)
    return _numbers(df, ("total_km",), ("n_users", "n_trips"))


def read_demographics(spark: SparkSession, path: str, region_key: str = "00") -> DataFrame:
    reader = read_demographics_json if path.lower().endswith(".json") else read_demographics_csv
    return demographics(reader(spark, path), region_key)


def read_calibration_stations(spark: SparkSession, path: str, validate: bool = True) -> DataFrame:
    df = read_csv(spark, path)
    df = _numbers(df, ("latitude", "longitude", "dtv"), ("regiostar5", "regiostar7"))
    return require_valid_stations(df) if validate else df


def _checked_table(df: DataFrame) -> DataFrame:
    df = _numbers(df, ("latitude", "longitude", "dtv"), ("base_id", "count"))
    if "verified_at" in df.columns:
        df = df.withColumn("verified_at", F.col("verified_at").cast("string").try_cast("timestamp_ntz"))
    flag = F.lower(F.trim(F.col("is_discarded").cast("string"))).isin("true", "1", "1.0") if "is_discarded" in df.columns else F.lit(False)
    return df.withColumn("is_discarded", F.coalesce(flag, F.lit(False)))


def _read_checked(spark: SparkSession, path: str, must_exist: bool) -> DataFrame | None:
    try:
        return _checked_table(read_csv(spark, path, ","))
    except AnalysisException as e:
        if must_exist:
            raise FileNotFoundError(path) from e
        return None


def verified_path(root: str, year: int, project: str | None = None) -> str:
    folder = f"{root}/verified/{project}" if project else f"{root}/verified"
    return f"{folder}/counters_verified_{year}"


def calibration_path(root: str, region: str, year: int) -> str:
    return f"{root}/verified/calibration_{region.lower().replace(' ', '_')}_{year}"


def read_verified_counters(
    spark: SparkSession, root: str, year: int, project: str | None = None, must_exist: bool = False
) -> DataFrame | None:
    """Checked assignments of a year: the project's table, else the shared one."""
    found = _read_checked(spark, verified_path(root, year, project), must_exist and not project)
    if found is None and project:
        found = _read_checked(spark, verified_path(root, year), must_exist)
    return found


def read_verified_calibration(spark: SparkSession, root: str, region: str, year: int, must_exist: bool = False) -> DataFrame | None:
    return _read_checked(spark, calibration_path(root, region, year), must_exist)


KEY_COLUMNS = ("ars", "ARS", "ags")


def text_encoding(spark: SparkSession, path: str) -> str:
    """UTF-8 if every line of a text file is, else Windows-1252."""
    broken = spark.read.text(path).where(~F.is_valid_utf8("value")).limit(1)
    return "UTF-8" if broken.isEmpty() else WINDOWS_1252[0]


def read_delimited(spark: SparkSession, path: str, encoding: str | None = None) -> tuple[DataFrame, DataFrame]:
    """A CSV as text columns, and one row with ``n_surplus``, the rows left out.

    Rows with fewer cells than the header have NULL for what is missing. Rows with more cells are left out and counted;
    an empty cell beyond the last column is no surplus.
    Without a stated encoding the file's own is found.
    """
    encoding = encoding or text_encoding(spark, path)
    sep = sniff_separator(spark, path, encoding)
    names = [c.strip().strip('"') for c in first_lines(spark, path, 1, encoding)[0].split(sep)]
    schema = T.StructType([T.StructField(c, T.StringType()) for c in [*names, "_surplus"]])
    reader = spark.read.schema(schema).option("header", True).option("encoding", _file_encoding(encoding)).option("sep", sep)
    rows = reader.csv(path)
    kept = rows.where("_surplus is null").drop("_surplus")
    if encoding.lower() in WINDOWS_1252:
        kept = kept.withColumns({c: F.translate(F.col(f"`{c}`"), *_windows_letters()) for c in names})
    return kept, rows.agg(F.count("_surplus").alias("n_surplus"))


def read_any(spark: SparkSession, path: str, encoding: str | None = None) -> DataFrame:
    """Table by suffix: Parquet, ORC, JSON or CSV; see :func:`read_delimited` for rows of uneven length."""
    name = path.rstrip("/").lower()
    if name.endswith(".json"):
        return spark.read.option("multiLine", True).json(path)
    if name.endswith((".jsonl", ".ndjson")):
        return spark.read.json(path)
    if name.endswith(".orc"):
        return spark.read.orc(path)
    if name.endswith((".csv", ".txt")):
        return read_delimited(spark, path, encoding)[0]
    return spark.read.parquet(path)


def read_dataset(spark: SparkSession, path: str, encoding: str | None = None) -> DataFrame | None:
    """Generic input with normalised region keys; None when it does not exist."""
    try:
        df = read_any(spark, path, encoding)
    except (AnalysisException, IndexError):
        return None
    return finite_columns(normalize_region_keys(df))


def image_counts(images: DataFrame, counters: DataFrame, key: str = "counter_id") -> DataFrame:
    """Counters with the number of their images, 0 without any."""
    counts = images.groupBy(key).agg(F.count("*").alias("image_count"))
    return counters.drop("image_count").join(counts, key, "left").withColumn("image_count", F.coalesce("image_count", F.lit(0)))
