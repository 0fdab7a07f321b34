"""Preprocessing of a training table: narrow transforms, no shuffle."""

from __future__ import annotations

from collections.abc import Iterable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.functions.columns import ceil_cents, to_time
from cohortloom.operators.quality import validate
from cohortloom.spec import PipelineSpec

# Fixed value: stands for a missing value.
SENTINEL = -999999

_FLOATING = (T.FloatType, T.DoubleType)
_DECIMAL_DIGITS = 38
_INTEGER_RANGES = (("tinyint", 2**7), ("smallint", 2**15), ("int", 2**31))


def project_roles(df: DataFrame, spec: PipelineSpec) -> DataFrame:
    """IDs, target and date first, then the features that are not ignored."""
    return df.select(*spec.required, *spec.features(df.columns))


def fill_sentinel(df: DataFrame, value: int = SENTINEL) -> DataFrame:
    """Fill null and NaN in numeric columns, and null in text columns.

    Integers and decimals too narrow for the value are widened; booleans become
    integers 0 and 1 first. Dates cannot hold the sentinel and keep their nulls.
    """
    wider = {f.name: _wide_enough(f.dataType, value) for f in df.schema.fields}
    df = df.withColumns({c: F.col(c).cast(t) for c, t in wider.items() if t is not None})

    def filled(name: str, kind: T.DataType) -> Column:
        column = F.nanvl(F.col(name), F.lit(None)) if isinstance(kind, _FLOATING) else F.col(name)
        return F.coalesce(column, F.lit(value).cast(kind))

    numbers = [f for f in df.schema.fields if isinstance(f.dataType, T.NumericType)]
    return df.withColumns({f.name: filled(f.name, f.dataType) for f in numbers}).fillna(str(value))


def _wide_enough(kind: T.DataType, value: int) -> T.DataType | None:
    """The type that a column needs to hold the sentinel, or None if it is wide enough."""
    if isinstance(kind, (T.BooleanType, T.ByteType, T.ShortType)):
        return T.IntegerType()
    whole = len(str(abs(value)))
    if isinstance(kind, T.DecimalType) and kind.precision - kind.scale < whole:
        if whole + kind.scale > _DECIMAL_DIGITS:
            return T.DoubleType()
        return T.DecimalType(whole + kind.scale, kind.scale)
    return None


def ceil_2dp(df: DataFrame, columns: Iterable[str]) -> DataFrame:
    """Round the numeric ones of ``columns`` up to two decimals, as doubles."""
    numeric = set(numeric_columns(df))
    return df.withColumns({c: ceil_cents(F.col(c)) for c in columns if c in numeric})


def coerce_date(df: DataFrame, column: str) -> DataFrame:
    return df.withColumn(column, to_time(df, column))


def preprocess(df: DataFrame, spec: PipelineSpec, check: bool = True) -> DataFrame:
    """Validate, order columns by role, fill, round features up and parse the date."""
    if check:
        validate(df, spec)
    ordered = project_roles(df, spec)
    filled = fill_sentinel(coerce_date(ordered, spec.date))
    return ceil_2dp(filled, spec.features(ordered.columns))


def numeric_columns(df: DataFrame) -> list[str]:
    """Integer and floating columns; decimals are exact and left alone."""
    kinds = (T.IntegralType, T.FloatType, T.DoubleType)
    return [f.name for f in df.schema.fields if isinstance(f.dataType, kinds)]


def narrow_integers(df: DataFrame) -> DataFrame:
    """Cast each integer column to the smallest type that holds its range (one row is read back)."""
    columns = [f.name for f in df.schema.fields if isinstance(f.dataType, (T.LongType, T.IntegerType, T.ShortType))]
    if not columns:
        return df
    edges = df.agg(*(F.min(c).alias(f"{c}_min") for c in columns), *(F.max(c).alias(f"{c}_max") for c in columns))
    row = edges.first()

    def narrowest(column: str) -> str | None:
        low, high = row[f"{column}_min"], row[f"{column}_max"]
        if low is None:
            return None
        return next((name for name, limit in _INTEGER_RANGES if -limit <= low and high < limit), None)

    targets = {c: narrowest(c) for c in columns}
    return df.withColumns({c: F.col(c).cast(t) for c, t in targets.items() if t})
