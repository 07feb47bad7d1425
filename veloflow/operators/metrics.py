"""Regression quality as single aggregates."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, functions as F

from ..functions.numeric import finite
from ..functions.order_stats import quantiles

SQV_SCALE = 10_000.0
EPSILON = 2.220446049250313e-16  # smallest denominator of the percentage error
COUNT_FLOOR = 1e-10
BANDS = (0.10, 0.20, 0.30, 0.50)
METRICS = ("r2", "rmse", "mae", "mape", "max_error", "sqv")


def sqv_expr(y: Column, p: Column, scale: float = SQV_SCALE) -> Column:
    """Scalable quality value of one pair, 1 for a perfect prediction."""
    diff = p - y
    return F.lit(1.0) / (F.lit(1.0) + F.sqrt(diff * diff / (F.lit(scale) * F.greatest(y, F.lit(COUNT_FLOOR)))))


def sqv(df: DataFrame, y: str = "y_true", p: str = "y_pred", scale: float = SQV_SCALE) -> DataFrame:
    return df.agg(F.coalesce(F.avg(sqv_expr(_d(y), _d(p), scale)), F.lit(0.0)).alias("sqv"))


def _d(name: str) -> Column:
    return F.col(name).cast("double")


def metric_columns(y: Column, p: Column, scale: float = SQV_SCALE) -> list[Column]:
    """Aggregates of all metrics over the pairs that are complete, zero without any. Usable in any ``agg``."""
    both = y.isNotNull() & p.isNotNull()
    y, p = F.when(both, y), F.when(both, p)
    err = y - p
    sse = F.sum(err * err)
    # central second moment, stable for large values
    sst = F.var_pop(y) * F.count(y)
    r2 = F.when(sst > 0, 1 - sse / F.when(sst > 0, sst)).when(sse == 0, 1.0).otherwise(0.0)

    def filled(c: Column, name: str) -> Column:
        return F.coalesce(c, F.lit(0.0)).alias(name)

    return [
        filled(F.when(F.count(y) > 0, r2), "r2"),
        filled(F.sqrt(F.avg(err * err)), "rmse"),
        filled(F.avg(F.abs(err)), "mae"),
        filled(F.avg(F.abs(err) / F.greatest(F.abs(y), F.lit(EPSILON))), "mape"),
        filled(F.max(F.abs(err)), "max_error"),
        filled(F.avg(sqv_expr(y, p, scale)), "sqv"),
        F.count(y).alias("n_samples"),
    ]


def regression_metrics(
    df: DataFrame, y: str = "y_true", p: str = "y_pred", by: Sequence[str] = (), scale: float = SQV_SCALE
) -> DataFrame:
    """r2, rmse, mae, mape, max_error, sqv and size, overall or per group."""
    return df.groupBy(*by).agg(*metric_columns(_d(y), _d(p), scale))


def _band_name(limit: float) -> str:
    return f"within_{round(limit * 100)}pct"


def accuracy_bands(df: DataFrame, y: str = "y_true", p: str = "y_pred", bands: Sequence[float] = BANDS) -> DataFrame:
    """Share of rows whose relative error stays inside each band."""
    rel = F.abs(_d(p) - _d(y)) / F.greatest(_d(y), F.lit(COUNT_FLOOR))
    return df.agg(*[F.coalesce(F.avg((rel <= b).cast("double")), F.lit(0.0)).alias(_band_name(b)) for b in bands])


def residual_stats(df: DataFrame, y: str = "y_true", p: str = "y_pred") -> DataFrame:
    """Mean, population deviation, median and range of the residuals."""
    res = df.select((_d(y) - _d(p)).alias("r"))
    median = quantiles(res, "r", {"median": 0.5})["median"]
    return res.agg(
        F.avg("r").alias("residual_mean"),
        F.stddev_pop("r").alias("residual_std"),
        F.min("r").alias("residual_min"),
        F.max("r").alias("residual_max"),
    ).withColumn("residual_median", F.lit(median).cast("double"))


def linear_fit(df: DataFrame, y: str, x: str) -> DataFrame:
    """Slope, intercept and squared correlation."""
    vy, vx = _d(y), _d(x)
    r = F.corr(vy, vx)
    return df.agg(F.regr_slope(vy, vx).alias("slope"), F.regr_intercept(vy, vx).alias("intercept"), (r * r).alias("r2"))


def range_table(predictions: DataFrame, y: str = "y_true", p: str = "y_pred", model: str = "model") -> DataFrame:
    """Predicted and actual range per model."""
    return predictions.groupBy(model).agg(
        F.min(p).alias("min_predicted"),
        F.max(p).alias("max_predicted"),
        F.avg(_d(p)).alias("mean_predicted"),
        F.min(y).alias("min_actual"),
        F.max(y).alias("max_actual"),
    )


def metrics_table(scores: DataFrame) -> DataFrame:
    """Report columns of cross-validation scores, errors with a negative sign."""
    return scores.select(
        "model",
        F.col("r2_cv").alias("R2"),
        (-F.col("mape")).alias("neg_MAPE"),
        (-F.col("mae")).alias("neg_MAE"),
        F.col("max_error").alias("max_error"),
        F.col("sqv").alias("SQV"),
        F.col("r2_no_cv").alias("R2_no_CV"),
        *[F.col(c) for c in ("training_time_s", "prediction_time_s") if c in scores.columns],
    )


def prediction_summary(df: DataFrame, count: str = "count", p: str = "predicted_dtv") -> DataFrame:
    """Valid rows, correlation with the volume, median and range of the predictions."""
    valid = df.where(finite(F.col(p)).isNotNull())
    median = quantiles(valid, p, {"median": 0.5})["median"]
    return valid.agg(
        F.count("*").alias("n_valid"), F.corr(_d(count), _d(p)).alias("correlation"), F.min(p).alias("min"), F.max(p).alias("max")
    ).withColumn("median", F.lit(median).cast("double"))


def _bin(v: Column, low: Column, high: Column, bins: int) -> Column:
    """Equal-width bin from 0; the top edge belongs to the last bin."""
    width = high - low
    at = F.when(width > 0, F.floor((v - low) / F.when(width > 0, width) * bins)).otherwise(F.lit(0))
    return F.least(at, F.lit(bins - 1)).cast("int")


def histogram(df: DataFrame, column: str, bins: int = 50) -> DataFrame:
    """Counts of equal-width bins between the extremes (empty bins are left out)."""
    data = df.select(finite(F.col(column)).alias("v")).where("v is not null")
    box = data.agg(F.struct(F.min("v").alias("lo"), F.max("v").alias("hi")).alias("s")).scalar()
    return data.groupBy(_bin(F.col("v"), box["lo"], box["hi"], bins).alias("bin")).agg(F.count("*").alias("n"))


def density(df: DataFrame, x: str, y: str, bins: int = 50) -> DataFrame:
    """Counts of a two-dimensional equal-width grid."""
    data = df.select(finite(F.col(x)).alias("x"), finite(F.col(y)).alias("y")).where("x is not null and y is not null")
    box = data.agg(
        F.struct(*[f(c).alias(f"{c}{e}") for c in ("x", "y") for f, e in ((F.min, "lo"), (F.max, "hi"))]).alias("s")
    ).scalar()
    return data.groupBy(
        _bin(F.col("x"), box["xlo"], box["xhi"], bins).alias("x_bin"), _bin(F.col("y"), box["ylo"], box["yhi"], bins).alias("y_bin")
    ).agg(F.count("*").alias("n"))


def content_hash(df: DataFrame, columns: Sequence[str] | None = None) -> DataFrame:
    """Row count and an order-free hash of the content."""
    cols = [F.col(c) for c in (columns or sorted(df.columns))]
    h = F.xxhash64(*cols)
    # the sum tells repeated rows apart, which cancel out in the xor
    return df.agg(
        F.count("*").alias("n_rows"),
        F.coalesce(F.bit_xor(h), F.lit(0)).alias("hash_xor"),
        F.coalesce(F.sum(F.pmod(h, F.lit(2_147_483_647))), F.lit(0)).alias("hash_sum"),
    )
