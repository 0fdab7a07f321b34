"""Windowed conditional features: count, min, max, avg and stddev per entity."""

from __future__ import annotations

import time
from collections.abc import Mapping, Sequence
from itertools import pairwise

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.spec import Condition, Feature, FeatureSpec, is_fixed_window, window_millis, window_months

CATALOGUE_SCHEMA = T.StructType(
    [
        T.StructField("feature_name", T.StringType(), False),
        T.StructField("feature_type", T.StringType()),
        T.StructField("feature_data_type", T.StringType()),
        T.StructField("query", T.StringType()),
        T.StructField("created_time", T.LongType()),
        T.StructField("updated_time", T.LongType()),
        T.StructField("created_by", T.StringType()),
        T.StructField("entities_mapping", T.MapType(T.StringType(), T.StringType())),
        T.StructField("last_updated_by", T.StringType()),
        T.StructField("approved_by", T.StringType()),
        T.StructField("status", T.StringType()),
        T.StructField("description", T.StringType()),
    ]
)


def catalogue(spark: SparkSession, spec: FeatureSpec, created_ms: int | None = None) -> DataFrame:
    """One descriptive row per feature."""
    now = int(time.time() * 1000) if created_ms is None else created_ms
    rows = [
        (
            f"{spec.category}:{feature.name}",
            spec.feature_type,
            spec.data_type,
            "",
            now,
            now,
            spec.created_by,
            dict(spec.entity_map),
            spec.last_updated_by,
            spec.approved_by,
            spec.status,
            feature.description,
        )
        for feature in spec.features()
    ]
    return spark.createDataFrame(rows, CATALOGUE_SCHEMA)


def check_columns(df: DataFrame, spec: FeatureSpec) -> None:
    """Every column the spec names must be in the prepared table."""
    named = [*spec.entities, *spec.columns, *spec.windows]
    missing = [c for c in dict.fromkeys(named) if c not in df.columns]
    if missing:
        raise ValueError(f"the prepared table lacks columns {missing}")


def conditional_features(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """All features in one wide aggregate, for windows of any shape."""
    check_columns(df, spec)
    values = _Values(df)
    calls = {"COUNT": "count", "MIN": "min", "MAX": "max", "AVG": "avg", "STDDEV": "stddev_samp"}
    aggregates = [
        f"{calls[f.aggregation]}(CASE WHEN {_all_of(f.conditions)} AND `{f.window}` THEN {values.of(f)} END)"
        for f in spec.features()
    ]
    return _aggregate(df, spec.entities, {f.name: sql for f, sql in zip(spec.features(), aggregates, strict=True)})


def state_prefixes(spec: FeatureSpec) -> dict[tuple[str, tuple[Condition, ...]], str]:
    """A short name for each column and conditions that features share."""
    shared = dict.fromkeys((f.column, f.conditions) for f in spec.features())
    return {key: f"s{i}" for i, key in enumerate(shared)}


def partial_states(df: DataFrame, spec: FeatureSpec) -> dict[str, str]:
    """SQL of the aggregates, without windows, that all features are put together from: ``<prefix>_<part>``."""
    values = _Values(df)
    prefixes = state_prefixes(spec)
    states: dict[str, str] = {}
    for feature in spec.features():
        for part in _STATES[feature.aggregation]:
            value = values.number(feature.column) if part in _NUMERIC_STATES else f"`{feature.column}`"
            held = f"CASE WHEN {_all_of(feature.conditions)} THEN {value} END"
            states[f"{prefixes[feature.column, feature.conditions]}_{part}"] = _STATE_SQL[part].format(held)
    return states


def lookback_features(df: DataFrame, spec: FeatureSpec) -> DataFrame:
    """The same features for look-backs that end at one moment, so that they nest.

    Each row lies in one ring: the shortest window that holds it. The first
    aggregate keeps one state per (column, condition) and ring, which is few
    enough columns for generated code and is combined on the map side. The
    second adds up rings, at most one row per window for each entity; these
    narrow rows are moved to their entity first, as partial results of the
    second aggregate would be as wide as the output.
    """
    check_columns(df, spec)
    windows = sorted(spec.windows, key=_length)
    reach = {w: i for i, w in enumerate(windows)}
    # A row of a window that is not in the next longer one would be counted there: the job fails.
    nested = " ".join(
        f"WHEN `{a}` AND NOT coalesce(`{b}`, FALSE) "
        f"THEN CAST(raise_error('a row is in window {a} but not in {b}') AS INT)"
        for a, b in pairwise(windows)
    )
    ring = nested + " " + " ".join(f"WHEN `{w}` THEN {i}" for w, i in reach.items())
    features = spec.features()

    prefixes, states = state_prefixes(spec), partial_states(df, spec)
    ringed = df.withColumn("_ring", F.expr(f"CASE {ring} ELSE {len(windows)} END"))
    rings = _aggregate(ringed, [*spec.entities, "_ring"], states)

    merged: dict[str, str] = {}
    final: list[str] = []
    for feature in features:
        prefix = prefixes[feature.column, feature.conditions]
        last = reach[feature.window]

        def within(part: str, prefix: str = prefix, last: int = last) -> str:
            return f"CASE WHEN _ring <= {last} THEN {prefix}_{part} END"

        if feature.aggregation == "STDDEV":
            inner = range(last + 1)
            merged |= {f"_{prefix}_{i}": _RING_SQL.format(p=prefix, ring=i) for i in inner}
            rings_sql = ", ".join(f"_{prefix}_{i}" for i in inner)
            final.append(f"{_DEVIATION_SQL.format(rings=rings_sql)} AS `{feature.name}`")
            continue
        merged[feature.name] = {
            "COUNT": f"coalesce(sum({within('n')}), 0L)",
            "MIN": f"min({within('min')})",
            "MAX": f"max({within('max')})",
            "AVG": f"try_divide(sum({within('sum')}), sum({within('n')}))",
        }[feature.aggregation]
        final.append(f"`{feature.name}`")
    # One hash column, as a snapshot date is a constant that plans fold away from the keys.
    home = rings.withColumn("_home", F.xxhash64(*spec.entities)).repartition("_home")
    wide = _aggregate(home, ["_home", *spec.entities], merged)
    return wide.selectExpr(*(f"`{e}`" for e in spec.entities), *final)


def wide_features(df: DataFrame, spec: FeatureSpec, nested: bool | None = None) -> DataFrame:
    """All features of the spec per entity.

    ``nested`` says that the windows share their end, as look-backs do; unset,
    windows that are all named as look-backs are taken to. The nested form checks
    every row and fails where the windows do not nest.
    """
    if nested is None:
        nested = all(is_fixed_window(w) or window_months(w) is not None for w in spec.windows)
    return lookback_features(df, spec) if nested else conditional_features(df, spec)


# States kept per ring: what each aggregation needs to be put together again.
_STATES = {
    "COUNT": ("n",),
    "MIN": ("min",),
    "MAX": ("max",),
    "AVG": ("n", "sum"),
    "STDDEV": ("n", "mean", "var"),
}
_STATE_SQL = {
    "n": "count({})",
    "min": "min({})",
    "max": "max({})",
    "sum": "sum({})",
    "mean": "avg({})",
    "var": "var_pop({})",
}
_NUMERIC_STATES = ("sum", "mean", "var")

# One ring's (count, mean, squared deviation); an entity has one row per ring.
_RING_SQL = """named_struct(
  'n', coalesce(max(CASE WHEN _ring = {ring} THEN {p}_n END), 0L),
  'mean', max(CASE WHEN _ring = {ring} THEN {p}_mean END),
  'm2', max(CASE WHEN _ring = {ring} THEN {p}_var * {p}_n END))"""

# Means and squared deviations of two parts give those of their union.
_DEVIATION_SQL = """aggregate(
  array({rings}),
  named_struct('n', 0L, 'mean', 0D, 'm2', 0D),
  (a, r) -> CASE WHEN r.n = 0 THEN a ELSE named_struct(
    'n', a.n + r.n,
    'mean', a.mean + (r.mean - a.mean) * r.n / (a.n + r.n),
    'm2', a.m2 + r.m2 + (r.mean - a.mean) * (r.mean - a.mean) * a.n * r.n / (a.n + r.n)) END,
  a -> CASE WHEN a.n > 1 THEN sqrt(a.m2 / (a.n - 1)) END)"""


def _aggregate(df: DataFrame, keys: Sequence[str], aggregates: Mapping[str, str]) -> DataFrame:
    # SQL text, as a spec's conditions are: hundreds of columns are slow to build call by call.
    return df.groupBy(*keys).agg(*(F.expr(f"{sql} AS `{name}`") for name, sql in aggregates.items()))


def _length(window: str) -> int:
    """Sort key of look-backs: hours to weeks by length, months and years by their longest."""
    months = window_months(window)
    return window_millis(window) if months is None else months * 31 * 86_400_000


def _all_of(conditions: tuple[Condition, ...]) -> str:
    return " AND ".join(f"({c.sql})" for c in conditions) or "TRUE"


class _Values:
    """Column references; averages take doubles, so integers cannot overflow and a boolean counts as 0 or 1."""

    def __init__(self, df: DataFrame):
        types = {f.name: f.dataType for f in df.schema.fields}
        self._boolean = {n for n, t in types.items() if isinstance(t, T.BooleanType)}
        self._integer = {n for n, t in types.items() if isinstance(t, T.IntegralType)}

    def number(self, column: str) -> str:
        if column in self._boolean:
            return f"CAST(CAST(`{column}` AS INT) AS DOUBLE)"
        return f"CAST(`{column}` AS DOUBLE)" if column in self._integer else f"`{column}`"

    def of(self, feature: Feature) -> str:
        return self.number(feature.column) if feature.aggregation in ("AVG", "STDDEV") else f"`{feature.column}`"
