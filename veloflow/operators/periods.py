"""Campaign, counter and holiday periods. Both ends are compared at midnight."""

from __future__ import annotations

from datetime import date

from pyspark.sql import Column, DataFrame, functions as F


def _midnight(day: date | str) -> Column:
    return F.lit(str(day)).cast("date").cast("timestamp_ntz")


def in_period(ts: Column, start: date | str, end: date | str) -> Column:
    return ts.cast("timestamp_ntz").between(_midnight(start), _midnight(end))


def filter_period(df: DataFrame, start: date | str, end: date | str, date_column: str = "timestamp") -> DataFrame:
    """Rows inside a period; a table without the column passes unchanged."""
    return df.where(in_period(F.col(date_column), start, end)) if date_column in df.columns else df


def with_holiday_flag(
    df: DataFrame,
    start: date | str | None,
    end: date | str | None,
    date_column: str = "timestamp",
    output: str = "is_holiday",
) -> DataFrame:
    """Boolean flag for a holiday interval; without one every row is false."""
    if start is None or end is None or date_column not in df.columns:
        return df.withColumn(output, F.lit(False))
    return df.withColumn(output, F.coalesce(in_period(F.col(date_column), start, end), F.lit(False)))


def period_days(start: date | str, end: date | str) -> int:
    """Number of days with both ends counted."""
    first, last = (date.fromisoformat(str(d)) for d in (start, end))
    return (last - first).days + 1


def with_period_days(df: DataFrame, start: str, end: str, output: str = "campaign_days") -> DataFrame:
    """Inclusive day count per row, for tables of campaigns; bad dates give NULL."""
    return df.withColumn(output, F.datediff(F.col(end), F.col(start)) + 1)
