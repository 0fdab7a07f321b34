"""Questions about experiment runs and model versions kept as plain tables."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

def valid_metrics(df: DataFrame, value: str = "value") -> DataFrame:
    """Rows with a finite metric value."""
    column = F.col(value).cast("double")
    return df.filter(column.isNotNull() & ~F.isnan(column) & (F.abs(column) < float("inf")))


def active_runs(df: DataFrame, experiment: object = None) -> DataFrame:
    """Runs that are not deleted (column ``lifecycle_stage``, where there is one), of one experiment if it is given."""
    if "lifecycle_stage" in df.columns:
        df = df.filter(F.col("lifecycle_stage") == "active")
    return df if experiment is None else df.filter(F.col("experiment_id") == experiment)


def best_run(
    df: DataFrame,
    metric: str,
    ascending: bool = False,
    run: str = "run_id",
    started: str = "start_time",
    experiment: object = None,
) -> DataFrame:
    """The active run with the greatest (or least) value of the metric; of equals the newest, then the greatest id.

    No row comes back when no run has the metric.
    """
    worth = -F.col("value") if ascending else F.col("value")
    best = F.max_by(F.struct(run, "value"), F.struct(worth, F.col(started), F.col(run)))
    rows = valid_metrics(active_runs(df, experiment).filter(F.col("metric") == metric))
    return rows.agg(best.alias("best")).filter(F.col("best").isNotNull()).select("best.*")


def recent_runs(
    df: DataFrame,
    limit: int | None = None,
    run: str = "run_id",
    started: str = "start_time",
    experiment: object = None,
) -> DataFrame:
    """Active runs, newest first; with a limit a top-k that never sorts the whole table in one place."""
    ordered = active_runs(df, experiment).orderBy(F.col(started).desc(), F.col(run))
    return ordered if limit is None else ordered.limit(limit)


def latest_per_key(
    df: DataFrame,
    key: str = "name",
    version: str = "version",
    stage: str | None = None,
    stage_column: str = "stage",
) -> DataFrame:
    """The record with the greatest version as a number, for each key.

    A version that is no number comes before all numbers; of equal numbers ("9", "09") the greater text wins.
    """
    rows = df.filter(F.col(stage_column) == stage) if stage is not None else df
    latest = F.max_by(F.struct(*df.columns), F.struct(F.col(version).try_cast("bigint"), F.col(version)))
    return rows.groupBy(key).agg(latest.alias("latest")).select("latest.*")


def model_version(df: DataFrame, name: str, version: str | None = None, stage: str | None = None) -> DataFrame:
    """One version of a model: the one asked for, or the latest; an error when there is none."""
    rows = df.filter(F.col("name") == name)
    if stage is None and version not in (None, "latest"):
        found = rows.filter(F.col("version") == version)
    else:
        found = latest_per_key(rows, stage=stage)
    if found.isEmpty():
        where = f"in stage '{stage}' " if stage else ""
        raise ValueError(f"No versions found {where}for model {name}")
    return found
