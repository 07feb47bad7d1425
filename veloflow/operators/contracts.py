"""Schema contracts: declarative column rules checked in one pass over the data."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, SparkSession, functions as F

REGISTRY_VERSION = "1.0.0"


@dataclass(frozen=True)
class Rule:
    """Requirements of one column; ``optional`` columns may be absent."""

    column: str
    kind: str
    optional: bool = False
    nullable: bool = False
    at_least: float | None = None
    at_most: float | None = None
    length: tuple[int, int] | None = None
    unique: bool = False
    allowed: tuple[str, ...] | None = None


@dataclass(frozen=True)
class Contract:
    name: str
    rules: tuple[Rule, ...]
    role: str = "source"
    version: str = "1.0.0"
    description: str = ""


def _text(column: str, **kw) -> Rule:
    return Rule(column, "string", **kw)


def _key(column: str, **kw) -> Rule:
    return Rule(column, "string", length=(12, 12), **kw)


def _int(column: str, **kw) -> Rule:
    return Rule(column, "bigint", **kw)


def _num(column: str, **kw) -> Rule:
    return Rule(column, "double", **kw)


def _time(column: str, **kw) -> Rule:
    return Rule(column, "timestamp_ntz", **kw)


_EDGE = (_int("edge_id", unique=True), _int("base_id"), _int("count", at_least=0))
_DIRECTIONS = tuple(
    rule(name, at_least=0, nullable=True, optional=True)
    for rule, name in (
        (_int, "count_forward"),
        (_int, "count_backward"),
        (_num, "speed_forward_kmh"),
        (_num, "speed_backward_kmh"),
    )
)

CONTRACTS: dict[str, Contract] = {
    c.name: c
    for c in (
        Contract(
            "counter_location",
            (
                _text("id", length=(1, 10)),
                _text("name", nullable=True),
                _num("latitude", at_least=-90, at_most=90),
                _num("longitude", at_least=-180, at_most=180),
                _key("ars", nullable=True, optional=True),
            ),
            description="positions of counting stations",
        ),
        Contract(
            "counter_measurement",
            (_time("timestamp"), _text("counter_id"), _int("count", at_least=0)),
            description="daily counts of stations",
        ),
        Contract(
            "campaign_metadata",
            (
                _key("ags"),
                _int("year", at_least=2018, at_most=2030),
                _time("start_date", nullable=True, optional=True),
                _time("end_date", nullable=True, optional=True),
            ),
            description="campaign dates per municipality",
        ),
        Contract(
            "demographics",
            (
                _key("ars"),
                _int("n_users", at_least=0),
                _int("n_trips", at_least=0),
                _num("total_km", at_least=0),
                _text("bundesland", nullable=True, optional=True),
            ),
            description="participation per municipality",
        ),
        Contract(
            "traffic_volume",
            (*_EDGE, *_DIRECTIONS),
            role="feature",
            version="1.1.0",
            description="campaign volume per edge",
        ),
        Contract(
            "traffic_volume_german",
            (
                _int("KantenId", unique=True),
                _int("GrundlagenId"),
                _int("Verkehrsmenge", at_least=0),
                _int("VerkehrsmengeIn", at_least=0, nullable=True),
                _int("VerkehrsmengeGegen", at_least=0, nullable=True),
                _num("GeschwIn", at_least=0, nullable=True),
                _num("GeschwGegen", at_least=0, nullable=True),
            ),
            description="campaign volume per edge, delivery names",
        ),
        Contract("traffic_volume_raw", _EDGE, description="campaign volume before the infrastructure join"),
        Contract(
            "osm_infrastructure",
            (
                _int("way_id"),
                *(
                    _text(c, nullable=True, optional=True)
                    for c in ("highway", "cycleway", "cycleway_left", "cycleway_right", "bicycle")
                ),
                _text("bicycle_infrastructure"),
            ),
            description="cycling infrastructure class per way",
        ),
        Contract("municipality", (_key("ARS"), _text("GEN")), description="municipal areas and population"),
        Contract(
            "regiostar",
            (_key("ars"), _int("RegioStaR5", at_least=51, at_most=59)),
            description="regional typology",
        ),
        Contract("city_centroid", (_text("name"), _text("place")), description="centres of places"),
        Contract(
            "commune_statistics",
            (
                _text("ars"),
                _text("name", nullable=True),
                _int("users_n", at_least=0),
                _int("trips_n", at_least=0),
                *(
                    _num(c, at_least=0)
                    for c in (
                        "distance_km",
                        "avg_distance_km",
                        "median_distance_km",
                        "average_speed",
                        "average_duration",
                    )
                ),
            ),
            description="trip statistics per municipality",
        ),
        Contract("gebietseinheiten", (_key("ARS"), _text("Type"), _text("Name")), description="administrative units"),
    )
}

# Outside the registry: shapes of what the pipelines write.
OUTPUT_CONTRACTS: dict[str, Contract] = {
    c.name: c
    for c in (
        Contract(
            "prediction_output",
            (
                _int("edge_id", optional=True, nullable=True),
                _num("predicted_dtv", at_least=0),
                _num("prediction_lower", optional=True, nullable=True),
                _num("prediction_upper", optional=True, nullable=True),
            ),
            role="output",
        ),
        Contract(
            "training_output",
            (_num("stadtradeln_volume", at_least=0), _num("population", at_least=0), _num("dtv", at_least=0)),
            role="output",
        ),
    )
}

# Input dataset -> contract; others (wide measurement files) have none.
DATASET_CONTRACTS = {
    "counter_locations": "counter_location",
    "traffic_volumes": "traffic_volume_raw",
    "municipalities": "municipality",
    "regiostar": "regiostar",
    "city_centroids": "city_centroid",
    "campaign_stats": "campaign_metadata",
    "kommunen_stats": "commune_statistics",
    "gebietseinheiten": "gebietseinheiten",
}


def get_contract(name: str) -> Contract:
    known = {**CONTRACTS, **OUTPUT_CONTRACTS}
    if name not in known:
        raise KeyError(f"Unknown contract {name!r}; known: {sorted(known)}")
    return known[name]


def list_contracts(role: str | None = None) -> list[str]:
    return [n for n, c in CONTRACTS.items() if role is None or c.role == role]


def contract_table(spark: SparkSession) -> DataFrame:
    """The registry as a table."""
    rows = [(c.name, c.version, c.role, c.description, len(c.rules)) for c in CONTRACTS.values()]
    return spark.createDataFrame(rows, "name string, version string, role string, description string, n_rules int")


def _checks(rule: Rule) -> list[tuple[str, Column]]:
    raw = F.col(f"`{rule.column}`")
    value = raw.cast("string") if rule.kind == "string" else raw.cast("string").try_cast(rule.kind)
    if rule.kind == "bigint":
        # text such as "3.0" is a whole number too
        number = raw.cast("string").try_cast("double")
        value = F.coalesce(value, F.when(number == F.floor(number), F.floor(number).cast("bigint")))
    missing = raw.isNull()
    checks = [("type", ~missing & value.isNull())]
    if not rule.nullable:
        checks.append(("not_null", missing))
    if rule.at_least is not None:
        checks.append((f"at_least_{rule.at_least:g}", value < rule.at_least))
    if rule.at_most is not None:
        checks.append((f"at_most_{rule.at_most:g}", value > rule.at_most))
    if rule.length is not None:
        checks.append(("length", ~F.length(value).between(*rule.length)))
    if rule.allowed is not None:
        checks.append(("allowed", ~value.isin(*rule.allowed)))
    return checks


def failed_rules(contract: Contract, columns: Sequence[str]) -> list[Column]:
    """Per rule on a column that is there: its name as ``column:rule`` where a row breaks it, else NULL. Not uniqueness."""
    return [
        F.when(F.coalesce(bad, F.lit(False)), F.lit(f"{r.column}:{name}"))
        for r in contract.rules
        if r.column in columns
        for name, bad in _checks(r)
    ]


def rule_names(contract: Contract, columns: Sequence[str]) -> list[str]:
    """Names of all rules on the columns that are there."""
    own = [r for r in contract.rules if r.column in columns]
    return [f"{r.column}:{name}" for r in own for name, _ in _checks(r)] + [f"{r.column}:unique" for r in own if r.unique]


def check_contract(df: DataFrame, contract: Contract | str) -> DataFrame:
    """Failure counts per rule: ``(column, rule, n_failed)``, only rules that fail.

    All row rules share one aggregate. Uniqueness is one count per key, combined before the
    shuffle. Extra columns pass.
    """
    spec = get_contract(contract) if isinstance(contract, str) else contract
    absent = [r for r in spec.rules if r.column not in df.columns]
    present = [r for r in spec.rules if r.column in df.columns]
    cells = [
        F.struct(F.lit(r.column).alias("column"), F.lit(name).alias("rule"), F.count_if(F.coalesce(bad, F.lit(False))).alias("n_failed"))
        for r in present
        for name, bad in _checks(r)
    ]
    cells += [
        F.struct(F.lit(r.column).alias("column"), F.lit("required").alias("rule"), F.lit(1).cast("bigint").alias("n_failed"))
        for r in absent
        if not r.optional
    ]
    empty = df.sparkSession.createDataFrame([], "column string, rule string, n_failed bigint")
    found = df.agg(F.array(*cells).alias("c")).select(F.inline("c")) if cells else empty
    for r in present:
        if r.unique:
            groups = df.groupBy(F.col(f"`{r.column}`").cast("string").alias("k")).agg(F.count("*").alias("n"))
            repeats = groups.agg(F.coalesce(F.sum(F.when(F.col("n") > 1, F.col("n"))), F.lit(0)).alias("n_failed"))
            found = found.unionByName(repeats.select(F.lit(r.column).alias("column"), F.lit("unique").alias("rule"), "n_failed"))
    return found.where("n_failed > 0")


def violation_sample(df: DataFrame, contract: Contract | str, n: int = 5) -> DataFrame:
    """First offending cells with their rule, in a stable order."""
    spec = get_contract(contract) if isinstance(contract, str) else contract
    cells = [
        F.when(
            F.coalesce(bad, F.lit(False)),
            F.struct(
                F.lit(r.column).alias("column"),
                F.lit(name).alias("rule"),
                F.col(f"`{r.column}`").cast("string").alias("value"),
            ),
        )
        for r in spec.rules
        if r.column in df.columns
        for name, bad in _checks(r)
    ]
    bad_cells = df.select(F.explode(F.array_compact(F.array(*cells))).alias("f")).select("f.*")
    return bad_cells.orderBy("column", "rule", "value").limit(n)


def validate(df: DataFrame, contract: Contract | str, strict: bool = True) -> DataFrame:
    """The table with rule types applied; with ``strict`` any failed rule raises."""
    spec = get_contract(contract) if isinstance(contract, str) else contract
    if strict:
        failed = check_contract(df, spec).collect()  # at most one row per rule
        if failed:
            text = ", ".join(f"{r['column']}: {r['rule']} ({r['n_failed']})" for r in failed)
            raise ValueError(f"Contract {spec.name} failed: {text}")
    return df.withColumns(
        {
            r.column: F.col(f"`{r.column}`").cast(r.kind) if r.kind == "string" else F.col(f"`{r.column}`").try_cast(r.kind)
            for r in spec.rules
            if r.column in df.columns
        }
    )


def validate_datasets(spark: SparkSession, datasets: dict[str, DataFrame | None]) -> DataFrame:
    """One row per dataset: exists, valid (NULL without a contract), rows, failed rules."""
    out: DataFrame | None = None
    for name, df in datasets.items():
        contract = DATASET_CONTRACTS.get(name)
        if df is None:
            row = spark.range(1).select(
                F.lit(name).alias("dataset"),
                F.lit(False).alias("exists"),
                F.lit(None).cast("boolean").alias("schema_valid"),
                F.lit(None).cast("bigint").alias("row_count"),
                F.lit("file not found").alias("error"),
            )
        else:
            rows = df.agg(F.count("*").alias("row_count"))
            if contract is None:
                verdict = rows.select("row_count", F.lit(None).cast("boolean").alias("schema_valid"), F.lit(None).cast("string").alias("error"))
            else:
                failed = check_contract(df, contract).agg(
                    F.array_join(F.array_sort(F.collect_list(F.concat_ws(":", "column", "rule"))), ",").alias("e")
                )
                verdict = rows.select("row_count", failed.scalar().alias("e")).select(
                    "row_count", (F.col("e") == "").alias("schema_valid"), F.nullif(F.col("e"), F.lit("")).alias("error")
                )
            row = verdict.select(F.lit(name).alias("dataset"), F.lit(True).alias("exists"), "schema_valid", "row_count", "error")
        out = row if out is None else out.unionByName(row)
    if out is None:
        raise ValueError("No datasets given")
    return out


STATION_REQUIRED = ("id", "latitude", "longitude", "dtv")


def check_stations(df: DataFrame, required: Sequence[str] = STATION_REQUIRED) -> DataFrame:
    """Calibration station counts: missing and negative targets, positions outside Germany."""
    gaps = [c for c in required if c not in df.columns]
    if gaps:
        raise ValueError(f"Missing required columns: {sorted(gaps)}")
    outside = ~(F.col("latitude").between(47.0, 56.0) & F.col("longitude").between(5.5, 15.5))
    return df.agg(
        F.count("*").alias("n_stations"),
        F.count_if(F.col("dtv").isNull() | F.isnan(F.col("dtv").cast("double"))).alias("n_missing_dtv"),
        F.count_if(F.col("dtv") < 0).alias("n_negative_dtv"),
        F.count_if(F.coalesce(outside, F.lit(True))).alias("n_outside"),
    )


def require_valid_stations(df: DataFrame) -> DataFrame:
    """Raise on missing or negative targets; positions outside the country only count as a warning."""
    counts = check_stations(df).first()
    if counts["n_missing_dtv"]:
        raise ValueError(f"DTV column contains {counts['n_missing_dtv']} missing values")
    if counts["n_negative_dtv"]:
        raise ValueError(f"DTV column contains {counts['n_negative_dtv']} negative values")
    return df
