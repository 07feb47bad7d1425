"""Null policy and tolerant arithmetic. Missing is NULL; NaN and infinities become NULL."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, functions as F
from pyspark.sql import types as T


def finite(c: Column) -> Column:
    """NULL for NaN and infinities, the value as DOUBLE otherwise."""
    d = c.cast("double")
    # NaN orders above infinity, so one comparison drops both
    return F.when(F.abs(d) < F.lit(float("inf")), d)


def finite_columns(df: DataFrame) -> DataFrame:
    """Apply :func:`finite` to each floating point column."""
    floats = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.DoubleType, T.FloatType))]
    return df.withColumns({c: finite(F.col(c)) for c in floats}) if floats else df


def ratio(num: Column, den: Column) -> Column:
    """Division that yields NULL, never infinity, for a zero or missing denominator."""
    return finite(F.try_divide(num.cast("double"), den.cast("double")))


def is_close(actual: Column, expected: Column, rtol: float = 1e-5, atol: float = 1e-8) -> Column:
    """|actual - expected| <= atol + rtol * |expected|."""
    a, e = actual.cast("double"), expected.cast("double")
    return F.abs(a - e) <= F.lit(atol) + F.lit(rtol) * F.abs(e)


def clip(c: Column, low: float, high: float) -> Column:
    """Bound a value on both sides; NULL stays NULL."""
    return F.when(c.isNotNull(), F.least(F.greatest(c, F.lit(low)), F.lit(high)))


def half_even(c: Column, digits: int = 0) -> Column:
    """Banker's rounding as a DOUBLE."""
    return F.bround(c, digits).cast("double")
