"""Declarative inputs: column roles of a training table, and windowed features."""

from __future__ import annotations

import re
from collections.abc import Iterator, Mapping, Sequence
from dataclasses import dataclass, field
from itertools import product
from typing import Any

AGGREGATIONS = ("COUNT", "MIN", "MAX", "AVG", "STDDEV")
NO_CONDITION = "TRUE"
CONDITION_SLOTS = 3
MAX_NAME_LENGTH = 63

_WINDOW_NAME = re.compile(r"l(\d+)([hdwmy])")
_HOURS = {"h": 1, "d": 24, "w": 168}
_MONTHS = {"m": 1, "y": 12}
_WINDOW_UNITS = {"h": "hour", "d": "day", "w": "week", "m": "month", "y": "year"}


@dataclass(frozen=True)
class PipelineSpec:
    """Roles of a training table's columns; every unnamed column is a feature."""

    id_columns: tuple[str, ...]
    target: str
    date: str
    train_start: str
    ignored: tuple[str, ...] = ()
    oot_start: str | None = None
    train_end: str | None = None
    oot_end: str | None = None
    project: str = "pipeline"

    @classmethod
    def from_dict(cls, config: Mapping[str, Any]) -> PipelineSpec:
        """Read the upper-case keys of a pipeline configuration file.

        The end dates stay unset: they are descriptive there and bound nothing.
        """

        def text(key: str) -> str | None:
            return None if config.get(key) is None else str(config[key])

        return cls(
            id_columns=tuple(config["ID_COLUMNS"]),
            target=config["TARGET_COL"],
            date=config["DATE_COL"],
            train_start=str(config["TRAIN_START_DATE"]),
            ignored=tuple(config.get("IGNORED_FEATURES") or ()),
            oot_start=text("OOT_START_DATE"),
            project=config.get("PROJECT_NAME", "pipeline"),
        )

    @classmethod
    def from_yaml(cls, path: str) -> PipelineSpec:
        return cls.from_dict(_load_yaml(path))

    @property
    def required(self) -> tuple[str, ...]:
        return (*self.id_columns, self.target, self.date)

    def features(self, columns: Sequence[str]) -> list[str]:
        """Feature columns in source order."""
        skipped = {*self.required, *self.ignored}
        return [c for c in columns if c not in skipped]


@dataclass(frozen=True)
class Condition:
    name: str
    sql: str

    @property
    def applies(self) -> bool:
        return self.name != NO_CONDITION


@dataclass(frozen=True)
class Feature:
    """One output column: aggregation of a column under conditions in a window."""

    aggregation: str
    column: str
    conditions: tuple[Condition, ...]
    window: str

    @property
    def name(self) -> str:
        parts = [self.aggregation.lower(), *(c.name for c in self.conditions), self.column, self.window]
        return "_".join(parts)

    @property
    def description(self) -> str:
        words = [self.aggregation.lower(), self.column]
        if self.conditions:
            words += ["where", " and ".join(c.name for c in self.conditions)]
        return " ".join([*words, describe_window(self.window)])


@dataclass(frozen=True)
class ColumnPlan:
    slots: tuple[bool, ...]
    aggregations: tuple[str, ...]


@dataclass(frozen=True)
class FeatureSpec:
    """Windowed conditional features of one entity and snapshot date."""

    category: str
    entities: tuple[str, ...]
    columns: Mapping[str, ColumnPlan]
    conditions: tuple[tuple[Condition, ...], ...]
    windows: tuple[str, ...]
    feature_type: str = "batch"
    created_by: str = ""
    team: str = ""
    data_type: str = "float"
    last_updated_by: str = ""
    approved_by: str = ""
    status: str = "CREATED"
    entity_map: Mapping[str, str] = field(default_factory=dict)

    @classmethod
    def from_dict(cls, config: Mapping[str, Any]) -> FeatureSpec:
        lists = [config.get(f"condition_name_{i}", [NO_CONDITION]) for i in range(CONDITION_SLOTS)]
        # A name may be used in one list and get its SQL in another.
        known = {str(n): str(sql) for items in lists for x in items if isinstance(x, Mapping) for n, sql in x.items()}
        slots = tuple(tuple(_conditions(items, known)) for items in lists)
        columns = {}
        for column, plan in config["col_agg_dict"].items():
            flags = [bool(f) for f in plan["conditions"]]
            if len(flags) > CONDITION_SLOTS and not flags[CONDITION_SLOTS]:
                raise ValueError(f"{column}: look-back windows always apply, the fourth flag cannot be false")
            unknown = [a for a in plan["aggregations"] if a not in AGGREGATIONS]
            if unknown:
                raise ValueError(f"{column}: unknown aggregations {unknown}, expected {list(AGGREGATIONS)}")
            columns[column] = ColumnPlan(tuple(flags[:CONDITION_SLOTS]), tuple(plan["aggregations"]))
        spec = cls(
            category=config["feature_category"],
            entities=tuple(config["entities"]),
            columns=columns,
            conditions=slots,
            windows=tuple(config["time_cond_dict"]),
            feature_type=config["feature_type"],
            created_by=config["created_by"],
            team=config["team_name"],
            data_type=config.get("data_type", "FLOAT").lower(),
            last_updated_by=config.get("last_updated_by", ""),
            approved_by=config.get("approved_by", ""),
            status=config.get("status", "CREATED"),
            entity_map=dict(config.get("source_input_mapping") or {}),
        )
        spec.check_names()
        return spec

    @classmethod
    def from_yaml(cls, path: str) -> FeatureSpec:
        return cls.from_dict(_load_yaml(path))

    def condition_sets(self, plan: ColumnPlan) -> Iterator[tuple[Condition, ...]]:
        """Cross product of the enabled condition lists, without the no-op condition."""
        enabled = [c for c, on in zip(self.conditions, plan.slots, strict=False) if on]
        for chosen in product(*enabled):
            yield tuple(c for c in chosen if c.applies)

    def features(self) -> list[Feature]:
        return [
            Feature(aggregation, column, conditions, window)
            for column, plan in self.columns.items()
            for conditions, aggregation, window in product(self.condition_sets(plan), plan.aggregations, self.windows)
        ]

    def check_names(self) -> None:
        """Names must be within the limit and differ; ``name_report`` of an unchecked spec shows all that are not."""
        seen: set[str] = set()
        for feature in self.features():
            if len(feature.name) > MAX_NAME_LENGTH:
                raise ValueError(f"{feature.name} has {len(feature.name)} characters, {MAX_NAME_LENGTH} are allowed")
            if feature.name in seen:
                raise ValueError(f"two features are named {feature.name}")
            seen.add(feature.name)

    def name_report(self) -> dict[str, Any]:
        """Names and lengths, and those over the limit."""
        lengths = [(f.name, len(f.name)) for f in self.features()]
        sizes = [size for _, size in lengths]
        return {
            "total_features": len(lengths),
            "feature_names": [f.name for f in self.features()],
            "feature_lengths": lengths,
            "violations": [pair for pair in lengths if pair[1] > MAX_NAME_LENGTH],
            "max_length": max(sizes, default=0),
            "min_length": min(sizes, default=0),
            "avg_length": round(sum(sizes) / len(sizes), 2) if sizes else 0,
            "longest_feature": max(lengths, key=lambda pair: pair[1], default=None),
            "shortest_feature": min(lengths, key=lambda pair: pair[1], default=None),
        }


def is_fixed_window(name: str) -> bool:
    match = _WINDOW_NAME.fullmatch(name.lower())
    return match is not None and match[2] in _HOURS


def window_millis(name: str) -> int:
    """Length of a fixed look-back window; months and years have no fixed length."""
    if not is_fixed_window(name):
        raise ValueError(f"window {name!r} has no fixed length, as l<N>h, l<N>d or l<N>w have")
    match = _WINDOW_NAME.fullmatch(name.lower())
    return int(match[1]) * _HOURS[match[2]] * 3_600_000


def describe_window(name: str) -> str:
    match = _WINDOW_NAME.match(name.lower())
    if not match:
        return name
    plural = "s" if int(match[1]) > 1 else ""
    return f"last {match[1]} {_WINDOW_UNITS[match[2]]}{plural}"


def window_months(name: str) -> int | None:
    """Calendar months of a look-back by month or year, else None."""
    match = _WINDOW_NAME.fullmatch(name.lower())
    return int(match[1]) * _MONTHS[match[2]] if match and match[2] in _MONTHS else None


def _conditions(items: Sequence[Any], known: Mapping[str, str]) -> Iterator[Condition]:
    for item in items:
        if isinstance(item, Mapping):
            yield from (Condition(str(name), str(sql)) for name, sql in item.items())
        else:
            yield Condition(str(item), known.get(str(item), str(item)))


def _load_yaml(path: str) -> dict[str, Any]:
    try:
        import yaml
    except ImportError as error:
        raise ImportError("reading a YAML spec needs PyYAML; pass a dict instead") from error
    with open(path, encoding="utf-8") as file:
        return yaml.safe_load(file)
