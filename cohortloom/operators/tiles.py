"""Features of many snapshot dates from one scan, by tiles of a day.

A run per snapshot reads the events of its longest look-back again and again.
Here events are summed once into tiles: one row of partial states per entity and
day. Tiles can be stored by day, so a new day reads and writes that day alone. A
snapshot's look-back is then a range of tiles, and one window pass over an
entity's tiles gives the features of all snapshots.

Look-backs include both of their ends, so an event at midnight belongs to the
look-backs that end there and to those that start there. Midnight therefore is a
tile of its own: even slots are midnights, odd slots the days between them.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Iterable, Sequence
from zoneinfo import ZoneInfo

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.columns import DAY_MILLIS
from cohortloom.operators.features import partial_states, state_prefixes
from cohortloom.plans.stages import StageStore
from cohortloom.spec import FeatureSpec, window_millis

SNAPSHOT = "partition_date"
_SLOT, _ROWS = "_slot", "_rows"


def snapshot_keys(spec: FeatureSpec, snapshot: str = SNAPSHOT) -> list[str]:
    """Entity columns but for the snapshot date."""
    if snapshot not in spec.entities:
        raise ValueError(f"the spec's entities {list(spec.entities)} lack the snapshot date {snapshot!r}")
    keys = [e for e in spec.entities if e != snapshot]
    if not keys:
        raise ValueError("an entity needs a column besides the snapshot date")
    return keys


def midnight_millis(date: dt.date | str, zone: str = "UTC") -> int:
    """Local midnight in ``zone`` as UTC epoch milliseconds."""
    day = dt.date.fromisoformat(str(date))
    return int(dt.datetime(day.year, day.month, day.day, tzinfo=ZoneInfo(zone)).timestamp() * 1000)


def day_phase(snapshots: Iterable[dt.date | str], zone: str = "UTC") -> int:
    """Where in a UTC day the snapshots' midnights lie; a change of clocks between them is an error."""
    phases = {midnight_millis(s, zone) % DAY_MILLIS for s in snapshots}
    if len(phases) != 1:
        raise ValueError(f"snapshots must share their hour in UTC; clocks of {zone} change between them, or there are none")
    return phases.pop()


def day_slot(time_ms: Column, phase: int) -> Column:
    """Even for a midnight, odd for the rest of the day that follows it."""
    since = time_ms - F.lit(phase)
    day = F.floor(since / F.lit(DAY_MILLIS))
    return (day * 2 + F.when(since > day * F.lit(DAY_MILLIS), 1).otherwise(0)).cast("int")


def day_tiles(df: DataFrame, spec: FeatureSpec, time_ms: Column, phase: int, snapshot: str = SNAPSHOT) -> DataFrame:
    """One row of partial states per entity and slot. Rows without a time are in no look-back and in no tile.

    States are combined on the map side, so an entity with a third of all rows
    sends one row per task and slot.
    """
    keys = snapshot_keys(spec, snapshot)
    missing = [c for c in dict.fromkeys([*keys, *spec.columns]) if c not in df.columns]
    if missing:
        raise ValueError(f"the prepared table lacks columns {missing}")
    states = partial_states(df, spec)
    slotted = df.withColumn(_SLOT, day_slot(time_ms, phase)).filter(F.col(_SLOT).isNotNull())
    return slotted.groupBy(*keys, _SLOT).agg(
        F.count(F.lit(1)).alias(_ROWS), *(F.expr(f"{sql} AS `{name}`") for name, sql in states.items())
    )


def stored_tiles(
    store: StageStore,
    name: str,
    df: DataFrame,
    spec: FeatureSpec,
    time_ms: Column,
    phase: int,
    snapshot: str = SNAPSHOT,
) -> DataFrame:
    """The tiles kept as a stage by days: days that are new or whose rows have changed are built, the rest is read."""
    day = F.floor(F.col(_SLOT) / 2)
    used = dict.fromkeys([*snapshot_keys(spec, snapshot), *_source_columns(df, spec, snapshot)])
    rows = df.select(*used, time_ms.alias("_time")).withColumn(_SLOT, day_slot(F.col("_time"), phase))
    return store.run_parts(
        name,
        rows.filter(F.col(_SLOT).isNotNull()),
        day,
        lambda part: day_tiles(part.drop(_SLOT), spec, F.col("_time"), phase, snapshot),
    )


def _source_columns(df: DataFrame, spec: FeatureSpec, snapshot: str) -> list[str]:
    """All columns but the snapshot and window flags: conditions are SQL text and may name any of them."""
    return [c for c in df.columns if c != snapshot and c not in spec.windows]


def tile_features(
    tiles: DataFrame,
    spec: FeatureSpec,
    snapshots: Sequence[dt.date | str],
    zone: str = "UTC",
    snapshot: str = SNAPSHOT,
) -> DataFrame:
    """All features of the spec for every entity and snapshot with an event in the longest look-back.

    Tiles are moved once, to their entity. Each tile brings the snapshots up to
    the next tile as rows without states, and look-backs are ranges of slots that end at
    such a row. An entity has two tiles a day at most, however many events it has.
    Sums of a range are added anew for each snapshot, never subtracted, and
    deviations are taken around the entity's mean, so no digits cancel.
    """
    keys = snapshot_keys(spec, snapshot)
    phase = day_phase(snapshots, zone)
    days = {w: _whole_days(w) for w in spec.windows}
    if not days:
        raise ValueError("the spec has no look-back")
    reach = 2 * max(days.values())
    ends = {2 * ((midnight_millis(s, zone) - phase) // DAY_MILLIS): dt.date.fromisoformat(str(s)) for s in snapshots}
    prefixes = state_prefixes(spec)

    # The snapshots from this tile on and before the next one, as far as the longest look-back sees it.
    per_key = ", ".join(f"`{k}`" for k in keys)
    in_order = f"PARTITION BY {per_key} ORDER BY {_SLOT}"
    marks = f"array({', '.join(map(str, sorted(ends)))})"
    seen = f"filter({marks}, s -> s >= {_SLOT} AND s <= {_SLOT} + {reach} AND (_next IS NULL OR s < _next))"
    with_marks = tiles.selectExpr("*", f"lead({_SLOT}) OVER ({in_order}) AS _next").selectExpr(
        "*", f"explode(concat(array(CAST(NULL AS INT)), {seen})) AS _end"
    )
    states = [c for c in tiles.columns if c not in keys and c != _SLOT]
    rows = with_marks.selectExpr(
        *(f"`{k}`" for k in keys),
        "_end",
        f"coalesce(_end, {_SLOT}) AS {_SLOT}",
        *(f"CASE WHEN _end IS NULL THEN {s} END AS {s}" for s in states),
    )
    deviating = sorted({prefixes[f.column, f.conditions] for f in spec.features() if f.aggregation == "STDDEV"})
    if deviating:
        whole = f"OVER (PARTITION BY {per_key})"
        centres = (f"try_divide(sum({p}_n * {p}_mean) {whole}, sum({p}_n) {whole}) AS {p}_centre" for p in deviating)
        rows = rows.selectExpr("*", *centres).selectExpr(
            "*",
            *(f"CASE WHEN {p}_n > 0 THEN {p}_n * ({p}_mean - {p}_centre) ELSE 0D END AS {p}_off" for p in deviating),
            *(
                f"CASE WHEN {p}_n > 0 THEN {p}_n * ({p}_var + pow({p}_mean - {p}_centre, 2)) ELSE 0D END AS {p}_sq"
                for p in deviating
            ),
        )

    sums: dict[str, str] = {}
    final: list[str] = []

    def over(call: str, state: str, window: str) -> str:
        name = f"_{call}_{state}_{window}"
        sums[name] = f"{call}({state}) OVER ({in_order} RANGE BETWEEN {2 * days[window]} PRECEDING AND CURRENT ROW)"
        return f"`{name}`"

    for f in spec.features():
        p, w = prefixes[f.column, f.conditions], f.window
        if f.aggregation == "COUNT":
            sql = f"coalesce({over('sum', f'{p}_n', w)}, 0L)"
        elif f.aggregation in ("MIN", "MAX"):
            call = f.aggregation.lower()
            sql = over(call, f"{p}_{call}", w)
        elif f.aggregation == "AVG":
            sql = f"try_divide({over('sum', f'{p}_sum', w)}, {over('sum', f'{p}_n', w)})"
        else:
            n, off, squares = (over("sum", f"{p}_{part}", w) for part in ("n", "off", "sq"))
            sql = f"CASE WHEN {n} > 1 THEN sqrt(greatest({squares} - {off} * {off} / {n}, 0D) / ({n} - 1)) END"
        final.append(f"{sql} AS `{f.name}`")

    longest = max(days, key=days.get)
    any_row = over("sum", _ROWS, longest)
    dates = ", ".join(f"{end}, DATE '{date}'" for end, date in ends.items())
    date_of = f"element_at(map({dates}), _end) AS `{snapshot}`"
    ranged = rows.selectExpr(*(f"`{k}`" for k in keys), "_end", *(f"{sql} AS `{name}`" for name, sql in sums.items()))
    entity = [date_of if e == snapshot else f"`{e}`" for e in spec.entities]
    return ranged.filter(f"_end IS NOT NULL AND {any_row} > 0").selectExpr(*entity, *final)


def snapshot_features(
    df: DataFrame,
    spec: FeatureSpec,
    time_ms: Column,
    snapshots: Sequence[dt.date | str],
    zone: str = "UTC",
    snapshot: str = SNAPSHOT,
) -> DataFrame:
    """Features of all snapshots from one scan of the events."""
    tiles = day_tiles(df, spec, time_ms, day_phase(snapshots, zone), snapshot)
    return tile_features(tiles, spec, snapshots, zone, snapshot)


def _whole_days(window: str) -> int:
    days, rest = divmod(window_millis(window), DAY_MILLIS)
    if rest:
        raise ValueError(f"look-back {window!r} is no number of whole days; tiles are days")
    return days

