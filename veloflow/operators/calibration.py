"""Calibrators: parameters as small tables, application as a join or a literal.

A calibrator fits ``(y_pred, y_true)`` rows and yields a params table, so user-defined ones only
need ``fit`` and ``apply``. Leave-one-out errors are computed from global statistics per row
instead of one fit per row.
"""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass, field
from typing import Protocol

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import clip, finite, ratio
from ..functions.order_stats import grouped_order_statistics, order_statistics
from .metrics import METRICS, metric_columns

MIN_FACTOR = 0.1
MAX_FACTOR = 10.0
PRED, TRUE = "y_pred", "y_true"


class Calibrator(Protocol):
    """What a calibrator offers; implement it to plug in another one."""

    name: str

    def fit(self, df: DataFrame) -> "Calibrator": ...

    def apply(self, df: DataFrame, column: str, output: str) -> DataFrame: ...

    def leave_one_out(self, df: DataFrame) -> DataFrame: ...

    def params(self) -> dict: ...


def _d(name: str) -> Column:
    return F.col(name).cast("double")


def _valid_ratio() -> Column:
    """True/predicted ratio of usable rows, else NULL."""
    return F.when((_d(PRED) > 0) & (_d(TRUE) >= 0), ratio(_d(TRUE), _d(PRED)))


def _require_fit(fitted: object) -> None:
    if fitted is None:
        raise RuntimeError("Calibrator has not been fitted. Call fit() first.")


@dataclass
class GlobalMultiplicative:
    """One factor: the median ratio, kept inside [0.1, 10]."""

    name: str = "global_multiplicative"
    factor: float | None = None
    n_stations: int = 0
    _middle: dict = field(default_factory=dict)

    def fit(self, df: DataFrame) -> "GlobalMultiplicative":
        rows = df.select(_valid_ratio().alias("r"))
        # the values around the middle also serve the leave-one-out medians
        ranks = {f"m{k}": (lambda n, k=k: n // 2 + k) for k in (-1, 0, 1)}
        self._middle = order_statistics(rows, "r", ranks)
        self.factor = _median_of(self._middle)
        self.n_stations = df.count()
        return self

    def apply(self, df: DataFrame, column: str = PRED, output: str = "y_calibrated") -> DataFrame:
        _require_fit(self.factor)
        return df.withColumn(output, _d(column) * F.lit(self.factor))

    def leave_one_out(self, df: DataFrame) -> DataFrame:
        """``y_loo``: each row predicted with the factor of all others."""
        _require_fit(self.factor)
        m = self._middle
        mids = {k: F.lit(m[k]).cast("double") for k in ("m-1", "m0", "m1")}
        return df.withColumn("y_loo", _d(PRED) * _median_without(_valid_ratio(), F.lit(m["n"]), mids))

    def params(self) -> dict:
        _require_fit(self.factor)
        return {"calibrator_type": self.name, "params": {"factor": self.factor}, "n_stations": self.n_stations}


def _median_of(m: dict) -> float:
    n = m["n"]
    if not n:
        return 1.0
    median = m["m0"] if n % 2 else (m["m-1"] + m["m0"]) / 2
    return min(max(median, MIN_FACTOR), MAX_FACTOR)


def _median_column(n: Column, m: dict[str, Column]) -> Column:
    median = F.when(n % 2 == 1, m["m0"]).otherwise((m["m-1"] + m["m0"]) / 2)
    return F.when(n > 0, clip(median, MIN_FACTOR, MAX_FACTOR)).otherwise(1.0)


def _median_without(r: Column, n: Column, m: dict[str, Column]) -> Column:
    """Factor after taking one ratio ``r`` out of ``n`` sorted ones.

    With ``m0`` the value at rank n//2: for odd n the two new middle values are the neighbours on
    the side of ``r`` (both outer ones when ``r`` is the middle itself); for even n the new middle
    is ``m0`` when ``r`` was in the lower half and ``m-1`` otherwise. Equal values can stand in
    for each other, so comparing values is enough.
    """
    odd = (
        F.when(r < m["m0"], (m["m0"] + m["m1"]) / 2)
        .when(r > m["m0"], (m["m-1"] + m["m0"]) / 2)
        .otherwise((m["m-1"] + m["m1"]) / 2)
    )
    even = F.when(r <= m["m-1"], m["m0"]).otherwise(m["m-1"])
    left = clip(F.when(n % 2 == 1, odd).otherwise(even), MIN_FACTOR, MAX_FACTOR)
    return F.when(r.isNull(), _median_column(n, m)).when(n > 1, left).otherwise(1.0)


@dataclass
class LogLinear:
    """Ridge line in log space with a free intercept."""

    alpha: float = 1.0
    name: str = "log_linear"
    a: float | None = None
    b: float | None = None
    n_stations: int = 0
    _sums: dict = field(default_factory=dict)

    def fit(self, df: DataFrame) -> "LogLinear":
        x, y = F.log1p(_d(PRED)), F.log1p(_d(TRUE))
        row = df.agg(
            F.regr_count(y, x).alias("n"),
            F.regr_avgx(y, x).alias("mx"),
            F.regr_avgy(y, x).alias("my"),
            F.regr_sxx(y, x).alias("sxx"),
            F.regr_sxy(y, x).alias("sxy"),
        ).first()
        if not row["n"]:
            raise ValueError("No rows to fit")
        self._sums = row.asDict()
        self.a = (row["sxy"] or 0.0) / ((row["sxx"] or 0.0) + self.alpha) if (row["sxx"] or 0.0) + self.alpha else 0.0
        self.b = row["my"] - self.a * row["mx"]
        self.n_stations = row["n"]
        return self

    def apply(self, df: DataFrame, column: str = PRED, output: str = "y_calibrated") -> DataFrame:
        _require_fit(self.a)
        return df.withColumn(output, _back(F.lit(self.a) * F.log1p(_d(column)) + F.lit(self.b)))

    def leave_one_out(self, df: DataFrame) -> DataFrame:
        """Centred sums without one row follow from the full ones, so no row needs its own fit."""
        _require_fit(self.a)
        s = {k: F.lit(float(v or 0.0)) for k, v in self._sums.items()}
        return df.withColumn("y_loo", _ridge_without(s, F.log1p(_d(PRED)), F.log1p(_d(TRUE)), self.alpha))

    def params(self) -> dict:
        _require_fit(self.a)
        return {
            "calibrator_type": self.name,
            "params": {"a": self.a, "b": self.b, "alpha": self.alpha},
            "n_stations": self.n_stations,
        }


def _back(log_value: Column) -> Column:
    return F.when(log_value.isNotNull(), F.greatest(F.expm1(log_value), F.lit(0.0)))


def _ridge_without(s: dict[str, Column], x: Column, y: Column, alpha: float) -> Column:
    n, rest = s["n"], s["n"] - 1
    dx, dy = x - s["mx"], y - s["my"]
    shrink = n / F.when(rest > 0, rest)
    sxx, sxy = s["sxx"] - dx * dx * shrink, s["sxy"] - dx * dy * shrink
    mx, my = s["mx"] - dx / F.when(rest > 0, rest), s["my"] - dy / F.when(rest > 0, rest)
    a = F.try_divide(sxy, sxx + F.lit(float(alpha)))
    return _back(my + F.coalesce(a, F.lit(0.0)) * (x - mx))


@dataclass
class Stratified:
    """A calibrator per stratum with enough rows, the global one elsewhere. NULL is a stratum."""

    stratify_by: Sequence[str]
    min_n: int = 3
    base: str = "global_multiplicative"
    alpha: float = 1.0
    name: str = "stratified"
    global_: GlobalMultiplicative | LogLinear | None = None
    table: DataFrame | None = None
    n_stations: int = 0

    def _new_base(self) -> GlobalMultiplicative | LogLinear:
        if self.base == "global_multiplicative":
            return GlobalMultiplicative()
        if self.base == "log_linear":
            return LogLinear(self.alpha)
        raise ValueError(f"Unknown base calibrator: {self.base}")

    def _check(self, df: DataFrame) -> None:
        missing = sorted(set(self.stratify_by) - set(df.columns))
        if missing:
            raise ValueError(f"Meta missing stratification columns: {missing}")

    def fit(self, df: DataFrame) -> "Stratified":
        self._check(df)
        self.global_ = self._new_base().fit(df)
        keys = list(self.stratify_by)
        x, y = F.log1p(_d(PRED)), F.log1p(_d(TRUE))
        sums = df.groupBy(*keys).agg(
            F.count("*").alias("s_rows"),
            F.regr_count(y, x).cast("double").alias("s_n"),
            F.regr_avgx(y, x).alias("s_mx"),
            F.regr_avgy(y, x).alias("s_my"),
            F.coalesce(F.regr_sxx(y, x), F.lit(0.0)).alias("s_sxx"),
            F.coalesce(F.regr_sxy(y, x), F.lit(0.0)).alias("s_sxy"),
        )
        if self.base == "global_multiplicative":
            ranks = {f"s_m{k}": (lambda n, k=k: F.floor(n / 2) + k) for k in (-1, 0, 1)}
            rows = df.select(*keys, _valid_ratio().alias("_r"))
            middle = grouped_order_statistics(rows, "_r", ranks, keys).withColumnRenamed("n", "s_valid")
            sums = _null_safe_join(sums, middle, keys)
            n = F.coalesce(F.col("s_valid"), F.lit(0))
            mids = {f"m{k}": F.col(f"`s_m{k}`") for k in (-1, 0, 1)}
            sums = sums.withColumn("s_valid", n).withColumn("factor", _median_column(n, mids))
        else:
            a = F.try_divide(F.col("s_sxy"), F.col("s_sxx") + F.lit(float(self.alpha)))
            sums = sums.withColumn("a", F.coalesce(a, F.lit(0.0))).withColumn("b", F.col("s_my") - F.col("a") * F.col("s_mx"))
        self.table = sums
        self.n_stations = self.global_.n_stations
        return self

    def strata(self) -> DataFrame:
        """Fitted parameters of the strata that are large enough."""
        _require_fit(self.table)
        fitted = ["factor"] if self.base == "global_multiplicative" else ["a", "b"]
        return self.table.where(F.col("s_rows") >= self.min_n).select(*self.stratify_by, F.col("s_rows").alias("n"), *fitted)

    def apply(self, df: DataFrame, column: str = PRED, output: str = "y_calibrated") -> DataFrame:
        _require_fit(self.table)
        self._check(df)
        strata = self.strata().drop("n")
        joined = _null_safe_join(df, strata, list(self.stratify_by))
        p = _d(column)
        if self.base == "global_multiplicative":
            value = p * F.coalesce(F.col("factor"), F.lit(self.global_.factor))
            return joined.withColumn(output, value).drop("factor")
        a = F.when(F.col("a").isNull(), self.global_.a).otherwise(F.col("a"))
        b = F.when(F.col("a").isNull(), self.global_.b).otherwise(F.col("b"))
        return joined.withColumn(output, _back(a * F.log1p(p) + b)).drop("a", "b")

    def leave_one_out(self, df: DataFrame) -> DataFrame:
        """Own stratum without the row while it stays large enough, else all others."""
        _require_fit(self.table)
        joined = _null_safe_join(self.global_.leave_one_out(df), self.table, list(self.stratify_by))
        if self.base == "global_multiplicative":
            mids = {f"m{k}": F.col(f"`s_m{k}`") for k in (-1, 0, 1)}
            own = _d(PRED) * _median_without(_valid_ratio(), F.col("s_valid"), mids)
        else:
            s = {k: F.col(f"s_{k}") for k in ("n", "mx", "my", "sxx", "sxy")}
            own = _ridge_without(s, F.log1p(_d(PRED)), F.log1p(_d(TRUE)), self.alpha)
        value = F.when(F.col("s_rows") - 1 >= self.min_n, own).otherwise(F.col("y_loo"))
        return joined.withColumn("y_loo", value).select(*df.columns, "y_loo")

    def params(self) -> dict:
        _require_fit(self.table)
        return {
            "calibrator_type": self.name,
            "params": {
                "stratify_by": list(self.stratify_by),
                "min_n_per_stratum": self.min_n,
                "base": self.base,
                "global_params": self.global_.params()["params"],
            },
            "n_stations": self.n_stations,
        }


def _null_safe_join(left: DataFrame, right: DataFrame, keys: Sequence[str]) -> DataFrame:
    renamed = right.withColumnsRenamed({k: f"_{k}_r" for k in keys})
    on = [F.col(k).eqNullSafe(F.col(f"_{k}_r")) for k in keys]
    return left.join(renamed, on, "left").drop(*[f"_{k}_r" for k in keys])


def create_calibrator(
    kind: str, stratify_by: Sequence[str] | None = None, min_n: int = 3, alpha: float = 1.0, base: str = "global_multiplicative"
) -> GlobalMultiplicative | LogLinear | Stratified:
    """Calibrator by name."""
    if kind == "global_multiplicative":
        return GlobalMultiplicative()
    if kind == "log_linear":
        return LogLinear(alpha)
    if kind == "stratified":
        if not stratify_by:
            raise ValueError("stratify_by is required for the stratified calibrator")
        return Stratified(tuple(stratify_by), min_n, base, alpha)
    if kind == "spatially_weighted":
        raise NotImplementedError("The spatially weighted calibrator has no defined behaviour")
    raise ValueError(f"Unknown calibrator type: {kind}")


def loocv_errors(calibrator: Calibrator, df: DataFrame) -> DataFrame:
    """Rows with the absolute leave-one-out error; where no fit is left the raw error counts."""
    loo = calibrator.leave_one_out(df)
    usable = finite(F.col("y_loo"))
    return loo.withColumn("abs_error", F.abs(F.coalesce(usable, _d(PRED)) - _d(TRUE)))


def loocv(calibrator: Calibrator, df: DataFrame) -> DataFrame:
    """Summary of the leave-one-out errors in one row."""
    e = F.col("abs_error")
    return loocv_errors(calibrator, df).agg(
        F.avg(e).alias("mae_mean"),
        F.stddev_pop(e).alias("mae_std"),
        F.sqrt(F.avg(e * e)).alias("rmse_mean"),
        F.stddev_pop(e).alias("rmse_std"),
        F.count(e).alias("n_folds"),
    )


def _metric_struct(pred: str) -> Column:
    return F.struct(*metric_columns(_d(TRUE), _d(pred)))


def improvement(df: DataFrame, pred: str = PRED, calibrated: str = "y_calibrated") -> DataFrame:
    """Metrics before and after in one pass, with the gains."""
    both = df.agg(_metric_struct(pred).alias("raw"), _metric_struct(calibrated).alias("cal"))

    def cut(metric: str) -> Column:
        before, after = F.col(f"raw.{metric}"), F.col(f"cal.{metric}")
        return F.when(before > 0, F.try_divide(before - after, before)).otherwise(0.0)

    return both.select(
        *[F.col(f"raw.{m}").alias(f"raw_{m}") for m in METRICS],
        *[F.col(f"cal.{m}").alias(f"cal_{m}") for m in METRICS],
        F.col("raw.n_samples").alias("n_stations"),
        cut("mae").alias("mae_reduction"),
        cut("rmse").alias("rmse_reduction"),
        (F.col("cal.r2") - F.col("raw.r2")).alias("r2_gain"),
        (F.col("cal.sqv") - F.col("raw.sqv")).alias("sqv_gain"),
    )


def calibrate_and_evaluate(calibrator: Calibrator, df: DataFrame, run_loocv: bool = True) -> tuple[Calibrator, DataFrame]:
    """Fit, then one row with metrics before/after, gains, and leave-one-out (NULL below 3 rows)."""
    calibrator.fit(df)
    result = improvement(calibrator.apply(df))
    cols = ("mae_mean", "mae_std", "rmse_mean", "rmse_std")
    if run_loocv and calibrator.n_stations >= 3:
        scores = loocv(calibrator, df).select(F.struct(*cols)).scalar()
        return calibrator, result.withColumns({f"loocv_{c}": scores[c] for c in cols})
    return calibrator, result.withColumns({f"loocv_{c}": F.lit(None).cast("double") for c in cols})


def apply_to_edges(calibrator: Calibrator, edges: DataFrame, column: str = "predicted_dtv") -> DataFrame:
    """Replace the prediction and keep the old one beside it."""
    raw = f"{column}_uncalibrated"
    return calibrator.apply(edges.withColumnRenamed(column, raw), raw, column)


def params_table(calibrator: Calibrator, spark, fitted_at: str | None = None) -> DataFrame:
    """Fitted parameters as one row."""
    import json

    p = calibrator.params()
    row = [(p["calibrator_type"], json.dumps(p["params"], sort_keys=True), p["n_stations"])]
    table = spark.createDataFrame(row, "calibrator_type string, params string, n_stations long")
    stamp = F.current_timestamp() if fitted_at is None else F.lit(fitted_at).cast("timestamp")
    return table.withColumn("fitted_at", stamp)
