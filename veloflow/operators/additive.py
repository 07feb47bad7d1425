"""Calibrators whose fit follows from sums over stations, so that a state can be merged and taken apart.

A rule names each station's share of the sums, solves the sums for parameters and applies these. All else follows from
the sums: fitting is one partial aggregation, strata are the same sums per group, states of regions or years are merged
without reading their stations again, a withdrawn year is subtracted, and leaving one station out subtracts its share.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import clip
from ..session import reuse
from .calibration import MAX_FACTOR, MIN_FACTOR, PRED, TRUE, _back, _d, _null_safe_join, _require_fit

ROWS = "n_rows"
RULES: dict[str, type] = {}


class Rule(Protocol):
    """What to implement for a calibrator of one's own; register the class so that saved states can be loaded."""

    name: str

    def options(self) -> dict: ...

    def share(self, pred: Column, true: Column) -> dict[str, Column]:
        """What one station adds to each sum; NULL adds nothing."""

    def solve(self, sums: Mapping[str, Column]) -> dict[str, Column]:
        """Parameters from the sums."""

    def value(self, pred: Column, params: Mapping[str, Column]) -> Column:
        """The calibrated value of a prediction."""


def register_rule(cls: type) -> type:
    """Make a rule known by its name; ``cls(**options)`` must give the rule again."""
    if RULES.setdefault(cls.name, cls) is not cls:
        raise ValueError(f"Calibration rule already registered: {cls.name}")
    return cls


@register_rule
class RatioOfSums:
    """One factor: all counted traffic over all predicted traffic of usable stations, kept inside [0.1, 10]; 1 without any."""

    name = "ratio_of_sums"

    def options(self) -> dict:
        return {}

    def share(self, pred: Column, true: Column) -> dict[str, Column]:
        usable = (pred > 0) & (true >= 0)
        return {"pred": F.when(usable, pred), "true": F.when(usable, true)}

    def solve(self, sums: Mapping[str, Column]) -> dict[str, Column]:
        factor = F.when(sums["pred"] > 0, sums["true"] / sums["pred"])
        return {"factor": F.coalesce(clip(factor, MIN_FACTOR, MAX_FACTOR), F.lit(1.0))}

    def value(self, pred: Column, params: Mapping[str, Column]) -> Column:
        return pred * params["factor"]


@register_rule
class LogRidge:
    """Ridge line in log space with a free intercept, from sums; NULL without a station that has both values."""

    name = "log_ridge"

    def __init__(self, alpha: float = 1.0):
        self.alpha = float(alpha)

    def options(self) -> dict:
        return {"alpha": self.alpha}

    def share(self, pred: Column, true: Column) -> dict[str, Column]:
        x, y = F.log1p(pred), F.log1p(true)
        both = x.isNotNull() & y.isNotNull()
        return {k: F.when(both, v) for k, v in {"n": F.lit(1.0), "x": x, "y": y, "xx": x * x, "xy": x * y}.items()}

    def solve(self, sums: Mapping[str, Column]) -> dict[str, Column]:
        n = F.when(sums["n"] > 0.5, sums["n"])
        sxx, sxy = sums["xx"] - sums["x"] * sums["x"] / n, sums["xy"] - sums["x"] * sums["y"] / n
        slope = F.when(n.isNotNull(), F.coalesce(F.try_divide(sxy, F.greatest(sxx, F.lit(0.0)) + F.lit(self.alpha)), F.lit(0.0)))
        return {"a": slope, "b": (sums["y"] - slope * sums["x"]) / n}

    def value(self, pred: Column, params: Mapping[str, Column]) -> Column:
        return _back(params["a"] * F.log1p(pred) + params["b"])


@dataclass
class Additive:
    """A rule fitted over all stations and per stratum; strata below ``min_n`` stations use all. NULL is a stratum.

    ``table`` holds the state: a row per stratum with its station count and sums. ``totals`` is its sum, one row.
    """

    rule: Rule
    stratify_by: Sequence[str] = ()
    min_n: int = 3
    name: str = "additive"
    table: DataFrame | None = None
    totals: dict = field(default_factory=dict)

    @property
    def n_stations(self) -> int:
        return self.totals.get(ROWS, 0)

    def _share(self) -> dict[str, Column]:
        share = self.rule.share(_d(PRED), _d(TRUE))
        return {f"sum_{k}": F.coalesce(v.cast("double"), F.lit(0.0)) for k, v in share.items()}

    def _with_state(self, table: DataFrame) -> "Additive":
        table = reuse(table)
        names = [c for c in table.columns if c.startswith("sum_")]
        row = table.agg(F.coalesce(F.sum(ROWS), F.lit(0)).alias(ROWS), *[F.coalesce(F.sum(c), F.lit(0.0)).alias(c) for c in names], F.min(ROWS).alias("least")).first()
        if row["least"] is not None and row["least"] < 0:
            table.unpersist()
            raise ValueError("More stations subtracted from a stratum than it holds")
        totals = {c: row[c] for c in (ROWS, *names)}
        return Additive(self.rule, tuple(self.stratify_by), self.min_n, self.name, table, totals)

    def fit(self, df: DataFrame) -> "Additive":
        missing = sorted(set(self.stratify_by) - set(df.columns))
        if missing:
            raise ValueError(f"Meta missing stratification columns: {missing}")
        sums = [F.sum(v).alias(k) for k, v in self._share().items()]
        fitted = self._with_state(df.groupBy(*self.stratify_by).agg(F.count(F.lit(1)).alias(ROWS), *sums).where(F.col(ROWS) > 0))
        self.table, self.totals = fitted.table, fitted.totals
        return self

    def _combined(self, other: "Additive", sign: int) -> "Additive":
        _require_fit(self.table)
        _require_fit(other.table)
        if (self.rule.name, self.rule.options(), list(self.stratify_by)) != (other.rule.name, other.rule.options(), list(other.stratify_by)):
            raise ValueError("States of different rules, options or strata cannot be combined")
        numbers = [c for c in self.table.columns if c not in self.stratify_by]
        signed = other.table.select(*self.stratify_by, *[(F.col(c) * sign).alias(c) for c in numbers])
        both = self.table.unionByName(signed).groupBy(*self.stratify_by).agg(*[F.sum(c).alias(c) for c in numbers])
        return self._with_state(both.where(F.col(ROWS) != 0))

    def merge(self, other: "Additive") -> "Additive":
        """The fit over the stations of both, which must not overlap; reads the two states only."""
        return self._combined(other, 1)

    def subtract(self, other: "Additive") -> "Additive":
        """The fit without the stations of ``other``, which must be among those of this one."""
        return self._combined(other, -1)

    def _total(self) -> dict[str, Column]:
        return {k.removeprefix("sum_"): F.lit(float(v)) for k, v in self.totals.items() if k != ROWS}

    def _joined(self, df: DataFrame) -> tuple[DataFrame, dict[str, Column], Column]:
        """Rows with the sums of their stratum, these sums, and the stratum's station count."""
        state = self.table.withColumnsRenamed({c: f"_state_{c}" for c in self.table.columns if c not in self.stratify_by})
        joined = _null_safe_join(df, state, list(self.stratify_by))
        own = {k: F.col(f"`_state_sum_{k}`") for k in self._total()}
        return joined, own, F.coalesce(F.col(f"_state_{ROWS}"), F.lit(0))

    def strata(self) -> DataFrame:
        """Parameters of the strata that are large enough."""
        _require_fit(self.table)
        solved = self.rule.solve({k: F.col(f"`sum_{k}`") for k in self._total()})
        rows = self.table.where(F.col(ROWS) >= self.min_n)
        return rows.select(*self.stratify_by, F.col(ROWS).alias("n"), *[v.alias(k) for k, v in solved.items()])

    def apply(self, df: DataFrame, column: str = PRED, output: str = "y_calibrated") -> DataFrame:
        _require_fit(self.table)
        value = self.rule.value(_d(column), self.rule.solve(self._total()))
        if not self.stratify_by:
            return df.withColumn(output, value)
        joined, own, n = self._joined(df)
        value = F.when(n >= self.min_n, self.rule.value(_d(column), self.rule.solve(own))).otherwise(value)
        return joined.withColumn(output, value).select(*[c for c in df.columns if c != output], output)

    def leave_one_out(self, df: DataFrame) -> DataFrame:
        """``y_loo`` from the sums less the row's share: its stratum's while that stays large enough, else all; NULL if none is left."""
        _require_fit(self.table)
        share = {k.removeprefix("sum_"): v for k, v in self._share().items()}

        def without(sums: Mapping[str, Column]) -> Column:
            return self.rule.value(_d(PRED), self.rule.solve({k: v - share[k] for k, v in sums.items()}))

        value = without(self._total())
        if not self.stratify_by:
            return df.withColumn("y_loo", value)
        joined, own, n = self._joined(df)
        value = F.when(n - 1 >= self.min_n, without(own)).otherwise(value)
        return joined.withColumn("y_loo", value).select(*[c for c in df.columns if c != "y_loo"], "y_loo")

    def params(self) -> dict:
        _require_fit(self.table)
        held = {"rule": self.rule.name, "options": self.rule.options(), "stratify_by": list(self.stratify_by), "min_n_per_stratum": self.min_n, "totals": self.totals}
        return {"calibrator_type": self.name, "params": held, "n_stations": self.n_stations}

    @staticmethod
    def restored(params: Mapping, table: DataFrame) -> "Additive":
        """A fitted calibrator from ``params`` and the stored state; its rule must be registered."""
        if params["rule"] not in RULES:
            raise ValueError(f"Unknown calibration rule: {params['rule']}")
        rule = RULES[params["rule"]](**params["options"])
        return Additive(rule, tuple(params["stratify_by"]), params["min_n_per_stratum"], table=table, totals=dict(params["totals"]))
