"""Session defaults, and the shared folder that stored results go to."""

from __future__ import annotations

import os
import uuid
from pathlib import Path

from pyspark.sql import SparkSession

SESSION_DEFAULTS = {
    # Look-back arithmetic is on UTC epoch milliseconds (see functions.columns).
    "spark.sql.session.timeZone": "UTC",
    "spark.sql.adaptive.enabled": "true",
    "spark.sql.adaptive.coalescePartitions.enabled": "true",
    "spark.sql.adaptive.skewJoin.enabled": "true",
    # Checkpoints go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def build_session(app: str = "cohortloom", master: str | None = None, **conf: str) -> SparkSession:
    """Create a session with the library's defaults; ``conf`` wins over them."""
    builder = SparkSession.builder.appName(app)
    if master:
        builder = builder.master(master)
    for key, value in {**SESSION_DEFAULTS, **conf}.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def use_utc(spark: SparkSession) -> SparkSession:
    """Pin the zone of a session made elsewhere, and let its Python workers find this package where the driver does."""
    spark.conf.set("spark.sql.session.timeZone", "UTC")
    home = str(Path(__file__).resolve().parents[1])
    paths = [p for p in spark.sparkContext.environment.get("PYTHONPATH", "").split(os.pathsep) if p]
    if home not in paths:
        spark.sparkContext.environment["PYTHONPATH"] = os.pathsep.join([*paths, home])
    return spark


def shared_folder(spark: SparkSession) -> str:
    """Folder for stored stages and checkpoints, named by ``spark.checkpoint.dir``.

    A local session without that setting uses a folder below its warehouse; on a
    cluster the setting is needed, as executors do not see each other's disks.
    """
    context = spark.sparkContext
    folder = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if folder:
        if not context.getCheckpointDir():
            context.setCheckpointDir(folder)
        return folder
    if not context.master.startswith("local"):
        raise ValueError("set spark.checkpoint.dir to a folder that all executors share")
    context.setCheckpointDir(f"{spark.conf.get('spark.sql.warehouse.dir')}/_cohortloom")
    return context.getCheckpointDir()


def fresh_folder(spark: SparkSession, label: str) -> str:
    """A path under the shared folder that no earlier run has used."""
    return f"{shared_folder(spark)}/{label}-{uuid.uuid4().hex}"


def shuffle_width(spark: SparkSession) -> int:
    return int(spark.conf.get("spark.sql.shuffle.partitions"))
