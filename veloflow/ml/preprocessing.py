"""Splits, scalers and the target transform as expressions with fitted numbers."""

from __future__ import annotations

import math
from collections.abc import Sequence
from dataclasses import dataclass, field

from pyspark import StorageLevel
from pyspark.ml.feature import VectorAssembler
from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import clip, finite
from ..functions.order_stats import QUARTILES, quantiles
from ..operators.infrastructure import CATEGORIES

# Which scaler a feature gets.
POWER_FEATURES = ("stadtradeln_volume",)
STANDARD_FEATURES = ("dist_to_center_m", "population", "total_km")
ROBUST_FEATURES = ("participation_rate", "route_intensity", "volume_per_trip")
INFRA_FEATURE = "infra_category"
REGION_FEATURES = ("regiostar7", "regiostar5")
UNKNOWN_CODE = -1.0

LAMBDA_RANGE = (-5.0, 5.0)
LAMBDA_LIMIT = 100.0  # powers beyond it overflow
LAMBDA_STEPS = 20
LAMBDA_TOLERANCE = 1e-3


def hash_bucket(columns: Sequence[str], seed: int, buckets: int) -> Column:
    """Repeatable bucket of a row, the same whatever the partitioning."""
    return F.pmod(F.xxhash64(F.lit(seed), *columns), F.lit(buckets))


def train_test_split(
    df: DataFrame, test_size: float = 0.2, seed: int = 42, key: Sequence[str] = ("id",)
) -> tuple[DataFrame, DataFrame]:
    """Seeded split; with ``test_size`` 0 both parts are the whole table (cross-validation only)."""
    if test_size <= 0:
        return df, df
    in_test = hash_bucket(key, seed, 1000) < round(test_size * 1000)
    return df.where(~in_test), df.where(in_test)


def power_transform(x: Column, lam: float) -> Column:
    if abs(lam) < 1e-12:
        return F.log(x)
    return (F.pow(x, F.lit(lam)) - 1) / F.lit(lam)


def fit_power_lambda(df: DataFrame, column: str) -> float:
    """Box-Cox exponent of highest likelihood.

    Each pass evaluates a row of candidates in one aggregate and narrows around the best. Values
    are divided by their geometric mean, which makes the likelihood a variance alone.
    """
    # every candidate only asks for the values and how often each comes; repeated values are worked out once
    values = df.select(finite(F.col(column)).alias("_x")).where("_x is not null").groupBy("_x").agg(F.count("*").alias("_n")).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        return _best_lambda(values)
    finally:
        values.unpersist()


def _best_lambda(values: DataFrame) -> float:
    x, n = F.col("_x"), F.col("_n")
    low_row = values.agg(F.min(x).alias("lo"), (F.sum(n * F.log(F.when(x > 0, x))) / F.sum(F.when(x > 0, n))).alias("g")).first()
    if low_row["lo"] is None or low_row["lo"] <= 0:
        raise ValueError("The Box-Cox transformation can only be applied to strictly positive data")
    z = x / F.lit(math.exp(low_row["g"]))
    low, high = LAMBDA_RANGE
    while True:
        step = (high - low) / LAMBDA_STEPS
        grid = [low + step * i for i in range(LAMBDA_STEPS + 1)]
        powers = [power_transform(z, lam) for lam in grid]
        means = values.agg(*[(F.sum(n * p) / F.sum(n)).alias(f"m{i}") for i, p in enumerate(powers)]).first()
        off = [p - F.lit(means[i]) for i, p in enumerate(powers)]
        row = values.agg(*[(F.sum(n * o * o) / F.sum(n)).alias(f"v{i}") for i, o in enumerate(off)]).first()
        scored = [(row[i], lam) for i, lam in enumerate(grid) if row[i] is not None and row[i] > 0]
        if not scored:
            return 1.0  # constant column
        best = min(scored)[1]
        if best in (grid[0], grid[-1]) and abs(best) < LAMBDA_LIMIT:  # the best lies at an end: look further
            low, high = (low - 2 * (high - low), best + step) if best == grid[0] else (best - step, high + 2 * (high - low))
            continue
        if step < LAMBDA_TOLERANCE:
            return best
        low, high = best - step, best + step


@dataclass
class FeaturePrep:
    """Scaled feature columns and their vector; features without a rule are dropped."""

    features: Sequence[str]
    numbers: dict[str, dict[str, float]] = field(default_factory=dict)

    def plan(self) -> list[tuple[str, str]]:
        """(feature, scaler) in vector order."""
        picked: list[tuple[str, str]] = []
        for kind, group in (("power", POWER_FEATURES), ("standard", STANDARD_FEATURES), ("robust", ROBUST_FEATURES)):
            picked += [(f, kind) for f in self.features if f in group]
        if INFRA_FEATURE in self.features:
            picked.append((INFRA_FEATURE, "ordinal"))
        region = next((f for f in REGION_FEATURES if f in self.features), None)
        if region is not None:
            picked.append((region, "keep"))
        return picked

    def fit(self, df: DataFrame) -> "FeaturePrep":
        for feature, kind in self.plan():
            if kind == "robust":
                q = quantiles(df, feature, QUARTILES)
                spread = (q["q75"] - q["q25"]) if q["n"] else 0.0
                self.numbers[feature] = {"center": q["median"] or 0.0, "scale": spread or 1.0}
            elif kind == "power":
                self.numbers[feature] = {"lambda": fit_power_lambda(df, feature)}
        moments = [f for f, kind in self.plan() if kind in ("power", "standard")]
        if moments:
            row = df.agg(
                *[f(self._raw(c)).alias(f"{n}_{c}") for c in moments for n, f in (("m", F.avg), ("s", F.stddev_pop))]
            ).first()
            for c in moments:
                self.numbers.setdefault(c, {}).update(center=row[f"m_{c}"] or 0.0, scale=row[f"s_{c}"] or 1.0)
        return self

    def _raw(self, feature: str) -> Column:
        v = finite(F.col(feature))
        return power_transform(v, self.numbers[feature]["lambda"]) if feature in POWER_FEATURES else v

    def column(self, feature: str, kind: str) -> Column:
        """Scaled value of one feature."""
        if kind == "ordinal":
            return ordinal_code(F.col(feature))
        if kind == "keep":
            return F.col(feature).cast("double")
        n = self.numbers[feature]
        return (self._raw(feature) - F.lit(n["center"])) / F.lit(n["scale"])

    def transform(self, df: DataFrame, output: str = "features") -> DataFrame:
        plan = self.plan()
        scaled = df.withColumns({f"_x_{f}": self.column(f, kind) for f, kind in plan})
        names = [f"_x_{f}" for f, _ in plan]
        # a missing value gives a vector of NaN, which scores as a failure instead of an error
        assembler = VectorAssembler(inputCols=names, outputCol=output, handleInvalid="keep")
        return assembler.transform(scaled).drop(*names)


def ordinal_code(c: Column) -> Column:
    """Position of a category in the fixed order, -1 for anything else."""
    at = F.array_position(F.array(*[F.lit(x) for x in CATEGORIES]), c).cast("double") - 1
    return F.coalesce(at, F.lit(UNKNOWN_CODE))


def standard_scale(df: DataFrame, column: str, output: str) -> DataFrame:
    """Zero mean and unit population deviation."""
    v = finite(F.col(column))
    row = df.agg(F.avg(v).alias("m"), F.stddev_pop(v).alias("s")).first()
    return df.withColumn(output, (v - F.lit(row["m"])) / F.lit(row["s"] or 1.0))


def robust_scale(df: DataFrame, column: str, output: str) -> DataFrame:
    """Distance from the median in units of the interquartile range."""
    q = quantiles(df, column, QUARTILES)
    spread = (q["q75"] - q["q25"]) if q["n"] else 0.0
    return df.withColumn(output, (finite(F.col(column)) - F.lit(q["median"])) / F.lit(spread or 1.0))


@dataclass(frozen=True)
class TargetTransform:
    """``log1p`` with an inverse bounded to [0, clip_max], or ``none``."""

    kind: str = "log1p"
    clip_max: float | None = None

    def __post_init__(self) -> None:
        if self.kind not in ("log1p", "none"):
            raise ValueError(f"Unknown target transformation: {self.kind}")

    def forward(self, c: Column) -> Column:
        return F.log1p(c.cast("double")) if self.kind == "log1p" else c.cast("double")

    def inverse(self, c: Column) -> Column:
        if self.kind == "none":
            return c
        raw = F.expm1(c)
        return F.greatest(raw, F.lit(0.0)) if self.clip_max is None else clip(raw, 0.0, self.clip_max)

    @classmethod
    def fitted(cls, df: DataFrame, target: str, kind: str = "log1p") -> "TargetTransform":
        """Predictions may reach twice the largest target."""
        top = df.agg(F.max(finite(F.col(target))).alias("t")).first()["t"]
        return cls(kind, None if top is None else 2.0 * top)
