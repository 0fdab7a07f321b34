"""Column expressions shared by the operators. All of them are built-in and JVM-side."""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.spec import window_millis, window_months

# Milliseconds per day, and 1990-01-01 UTC, the origin of scaled times.
DAY_MILLIS = 86_400_000
SCALE_ORIGIN_MILLIS = 631_152_000_000

_WHOLE_DOUBLE = float(2**53)


def as_date(value: str | dt.date | Column) -> Column:
    return value if isinstance(value, Column) else F.lit(str(value)).cast("date")


def as_time(value: str | dt.date | Column) -> Column:
    """A zone-less timestamp literal."""
    return value if isinstance(value, Column) else F.lit(str(value)).cast("timestamp_ntz")


def flag_case(column: str, value: object) -> Column:
    """True where the column equals ``value``; a null is False."""
    return F.when(F.col(column) == value, True).otherwise(False)


def epoch_millis(time: str | Column) -> Column:
    """UTC epoch milliseconds; zone-less times are taken as UTC (session zone)."""
    column = F.col(time) if isinstance(time, str) else time
    return F.unix_millis(column.cast("timestamp"))


def as_of_millis(as_of: str | dt.date | Column, zone: str = "UTC") -> Column:
    """Local midnight of the snapshot date in ``zone``, as UTC epoch milliseconds."""
    return F.unix_millis(F.to_utc_timestamp(as_date(as_of).cast("timestamp"), zone))


def window_flags(
    time_ms: Column, as_of_ms: Column, windows: Iterable[str], zone: str = "UTC"
) -> dict[str, Column]:
    """One boolean per look-back window, both ends inclusive.

    Months and years go back by the calendar of ``zone``, to the last day of a
    month that is too short.
    """

    def start(window: str) -> Column:
        months = window_months(window)
        if months is None:
            return as_of_ms - F.lit(window_millis(window))
        local = F.from_utc_timestamp(F.timestamp_millis(as_of_ms), zone)
        return F.unix_millis(F.to_utc_timestamp(local - F.make_ym_interval(F.lit(0), F.lit(months)), zone))

    return {w: time_ms.between(start(w), as_of_ms) for w in windows}


def scaled_time(time_ms: Column, as_of_ms: Column) -> Column:
    origin = F.lit(SCALE_ORIGIN_MILLIS)
    return (time_ms - origin) / (as_of_ms - origin)


def days_since(created_ms: Column, as_of_ms: Column) -> Column:
    return (as_of_ms - created_ms) / F.lit(float(DAY_MILLIS))


def stamp_date(df: DataFrame, run_date: str | dt.date, name: str = "etl_date") -> DataFrame:
    return df.withColumn(name, as_date(run_date))


def month_start(time: str | Column) -> Column:
    """First day of the month as a date; four bytes, so it is the grouping key."""
    return F.trunc(time, "month")


def month_key(time: str | Column) -> Column:
    """Month as ``yyyy-MM`` text, the form that reports show."""
    return F.date_format(time, "yyyy-MM")


def to_time(df: DataFrame, column: str) -> Column:
    """The column as a timestamp; text that is not a date fails the job."""
    if isinstance(df.schema[column].dataType, (T.TimestampType, T.TimestampNTZType)):
        return F.col(column)
    return F.col(column).cast("timestamp_ntz")


def ceil_cents(value: Column) -> Column:
    """Round up to two decimals as a double.

    ``ceil`` gives a long, so values that are already whole at that size, as
    well as NaN and infinities, bypass it.
    """
    cents = value.cast("double") * F.lit(100.0)
    return F.when(F.abs(cents) < _WHOLE_DOUBLE, F.ceil(cents) / F.lit(100.0)).otherwise(cents / F.lit(100.0))


def present_double(column: str) -> Column:
    """The column as a double, with NaN treated as missing."""
    value = F.col(column).cast("double")
    return F.when(~F.isnan(value), value)
