"""Scans. Filters and column lists stay declarative so they reach the files."""

from __future__ import annotations

import datetime as dt
from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.functions.columns import as_date

LOOKBACK_DAYS = 90
PARTITION_KEY_FORMAT = "yyyyMMdd"


def scan_parquet(spark: SparkSession, path: str, columns: Sequence[str] | None = None) -> DataFrame:
    df = spark.read.parquet(path)
    return df.select(*columns) if columns else df


def scan_table(spark: SparkSession, table: str, renames: Mapping[str, str]) -> DataFrame:
    """Catalogue table with ``{new name: source column}``; other columns are not read."""
    return spark.table(table).select(*(F.col(source).alias(name) for name, source in renames.items()))


def lookback_range(key: str | Column, as_of: str | dt.date, days: int = LOOKBACK_DAYS) -> Column:
    """``[as_of - days, as_of)`` on a text day key; the bounds fold, so partitions are pruned."""
    column = F.col(key) if isinstance(key, str) else key
    until = as_date(as_of)
    first = F.date_format(F.date_sub(until, days), PARTITION_KEY_FORMAT)
    return (column >= first) & (column < F.date_format(until, PARTITION_KEY_FORMAT))


def lookback_time_range(time: str | Column, as_of: str | dt.date, days: int = LOOKBACK_DAYS) -> Column:
    """The same days on an event time, for tables that are not partitioned by day."""
    column = F.col(time) if isinstance(time, str) else time
    until = as_date(as_of)
    return (column >= F.date_sub(until, days).cast("timestamp_ntz")) & (column < until.cast("timestamp_ntz"))


def filter_equal(df: DataFrame, values: Mapping[str, object]) -> DataFrame:
    """Rows where every named column equals its value."""
    for column, value in values.items():
        df = df.filter(F.col(column) == F.lit(value))
    return df
