"""Administrative hierarchy: level selection, independent cities, roll-ups."""

from __future__ import annotations

from pyspark.sql import DataFrame, functions as F

from ..functions.region_keys import in_region, level_digits, level_key, pad_left

LAND = "Land"
KREIS = "Kreis"
VG = "Verwaltungsgemeinschaft"


def without_children(parents: DataFrame, children: DataFrame, digits: int, key: str = "ars") -> DataFrame:
    """Parents that no child shares the first ``digits`` digits with."""
    taken = children.select(F.substring(key, 1, digits).alias("_p")).distinct()
    return parents.withColumn("_p", F.substring(key, 1, digits)).join(taken, "_p", "left_anti").drop("_p")


def units_at_level(units: DataFrame, level: str, land_code: str = "00") -> DataFrame:
    """Units of one level. At community level, cities and city states without parts stand in."""
    level_digits(level)
    units = units.withColumn("ars", pad_left(F.col("ars")))
    if level.lower() == VG.lower():
        vg = units.where(F.col("admin_level") == VG)
        kreis = units.where(F.col("admin_level") == KREIS)
        land = units.where(F.col("admin_level") == LAND)
        picked = vg.unionByName(without_children(kreis, vg, 5)).unionByName(without_children(land, kreis, 2))
    else:
        picked = units.where(F.lower("admin_level") == level.lower())
    return picked if land_code == "00" else picked.where(F.col("ars").startswith(land_code))


def filter_region(df: DataFrame, region_key: str, key: str = "ars") -> DataFrame:
    """Rows inside a region; the key is padded first."""
    if key not in df.columns:
        return df
    return df.withColumn(key, pad_left(F.col(key))).where(in_region(F.col(key), region_key))


def rollup_population(municipalities: DataFrame, level: str) -> DataFrame:
    key = level_key(F.col("ars"), level_digits(level))
    return municipalities.groupBy(key.alias("ars")).agg(F.sum("population").alias("population"))


def rollup_statistics(communes: DataFrame, level: str, units: DataFrame | None = None, land_code: str = "00") -> DataFrame:
    """Campaign statistics per unit; absent measures count as 0.

    At community level with a unit table, communes of a city without communities are summed for
    the whole city.
    """
    for measure in ("n_users", "n_trips", "total_km"):
        if measure not in communes.columns:
            communes = communes.withColumn(measure, F.lit(0))
    digits = level_digits(level)
    if units is not None and level.lower() == VG.lower():
        units = units.withColumn("ars", pad_left(F.col("ars")))
        kreis = units.where(F.col("admin_level") == KREIS)
        if land_code != "00":
            kreis = kreis.where(F.col("ars").startswith(land_code))
        cities = without_children(kreis, units.where(F.col("admin_level") == VG), 5)
        cities = cities.select(F.substring("ars", 1, 5).alias("_p")).distinct().withColumn("_city", F.lit(True))
        communes = communes.withColumn("_p", F.substring("ars", 1, 5)).join(cities, "_p", "left")
        key = F.when(F.col("_city"), level_key(F.col("ars"), 5)).otherwise(level_key(F.col("ars"), digits))
    else:
        key = level_key(F.col("ars"), digits)
    return communes.groupBy(key.alias("ars")).agg(
        F.sum("n_users").alias("n_users"), F.sum("n_trips").alias("n_trips"), F.sum("total_km").alias("total_km")
    )


def missing_codes(df: DataFrame, known: DataFrame, key: str = "ars", known_key: str = "ars") -> DataFrame:
    """Distinct 12-character codes of ``df`` that the other table does not list."""
    codes = df.select(F.substring(key, 1, 12).alias("code")).where("code is not null").distinct()
    return codes.join(known.select(F.substring(known_key, 1, 12).alias("code")), "code", "left_anti")


def total_population(df: DataFrame, column: str = "population") -> DataFrame:
    """Replace each population by the total of all rows (one shared value)."""
    total = df.agg(F.sum(column).alias("t"))
    return df.withColumn(column, total.scalar())
