"""Named pipeline stages kept in a shared folder, with a small manifest beside them."""

from __future__ import annotations

import datetime as dt
import json
import re
import uuid
from collections.abc import Callable, Mapping, Sequence
from typing import Any

from pyspark.ml import PipelineModel
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

# The stages in the order in which they run.
STAGE_ORDER = (
    "preprocessed_data",
    "train_test_split",
    "selected_features",
    "shifting_features",
    "trained_model",
    "evaluation_results",
)
MANIFEST = "pipeline_state.json"
FINGERPRINT = "_fingerprint"

Result = DataFrame | PipelineModel | Mapping[str, Any] | list


class SharedFolder:
    """Files of a folder on any file system that Spark reads."""

    def __init__(self, spark: SparkSession, path: str):
        self._path = spark._jvm.org.apache.hadoop.fs.Path
        self._files = self._path(path).getFileSystem(spark._jsc.hadoopConfiguration())
        self._spark = spark
        self.path = path

    def at(self, name: str) -> str:
        return f"{self.path}/{name}"

    def exists(self, path: str) -> bool:
        return self._files.exists(self._path(path))

    def delete(self, path: str) -> None:
        self._files.delete(self._path(path), True)

    def size(self, path: str) -> int:
        return self._files.getContentSummary(self._path(path)).getLength()

    def read_text(self, path: str) -> str | None:
        if not self.exists(path):
            return None
        stream = self._files.open(self._path(path))
        try:
            return bytes(stream.readAllBytes()).decode("utf-8")
        finally:
            stream.close()

    def write_text(self, path: str, text: str) -> None:
        """Replace a small file; a reader never sees half of it."""
        draft = f"{path}.{uuid.uuid4().hex}"
        stream = self._files.create(self._path(draft), True)
        stream.write(bytearray(text, "utf-8"))
        stream.close()
        # A rename that overwrites is one step: the old file is there until the new one is.
        jvm = self._spark._jvm
        configuration = self._spark._jsc.hadoopConfiguration()
        context = jvm.org.apache.hadoop.fs.FileContext.getFileContext(self._files.getUri(), configuration)
        options = self._spark.sparkContext._gateway.new_array(jvm.org.apache.hadoop.fs.Options.Rename, 1)
        options[0] = jvm.org.apache.hadoop.fs.Options.Rename.OVERWRITE
        source, target = (self._files.makeQualified(self._path(p)) for p in (draft, path))
        context.rename(source, target, options)


class StageStore:
    """Results by stage name.

    Tables are Parquet and models are in Spark ML's format, written and read by
    the executors. Only short lists and reports are in the manifest itself. A
    stage enters the manifest after its data is complete, and each run of a
    stage writes to a new directory, so a lost job leaves no half-read result.
    """

    def __init__(self, spark: SparkSession, path: str):
        self.spark = spark
        self.folder = SharedFolder(spark, path)
        self._manifest = self.folder.at(MANIFEST)
        self.state: dict[str, dict] = self._read_state()

    def _read_state(self) -> dict[str, dict]:
        text = self.folder.read_text(self._manifest)
        try:
            return json.loads(text) if text else {}
        except json.JSONDecodeError as error:
            raise ValueError(f"{self._manifest} is not a stage manifest") from error

    def _write_state(self) -> None:
        self.folder.write_text(self._manifest, json.dumps(self.state, indent=2, default=str))

    def save(self, name: str, result: Result, metadata: Mapping[str, Any] | None = None) -> None:
        path = self.folder.at(f"{name}-{uuid.uuid4().hex}")
        entry: dict[str, Any] = {"metadata": dict(metadata or {})}
        if isinstance(result, DataFrame):
            result.write.parquet(path)
            entry |= {"kind": "table", "path": path}
        elif isinstance(result, PipelineModel):
            result.write().save(path)
            entry |= {"kind": "model", "path": path}
        elif isinstance(result, Mapping) and any(isinstance(v, DataFrame) for v in result.values()):
            tables = {k: v for k, v in result.items() if isinstance(v, DataFrame)}
            for key, table in tables.items():
                table.write.parquet(f"{path}/{key}")
            values = {k: v for k, v in result.items() if k not in tables}
            entry |= {"kind": "tables", "path": path, "tables": list(tables), "value": values}
        else:
            entry |= {"kind": "value", "value": result}
        entry["timestamp"] = dt.datetime.now(dt.UTC).isoformat()
        if "path" in entry:
            entry["size_mb"] = round(self.folder.size(path) / 2**20, 2)
        previous = self.state.get(name)
        self.state[name] = entry
        self._write_state()
        if previous:
            self._delete_data(previous)

    def save_bucketed(
        self,
        name: str,
        df: DataFrame,
        by: Sequence[str],
        buckets: int,
        accept: Callable[[DataFrame], Mapping[str, Any]] | None = None,
        hidden: Sequence[str] = (),
    ) -> None:
        """Store a table in buckets of ``by``, sorted in each, so that grouping or joining by it moves no rows.

        Rows should come partitioned by these columns into as many parts, else
        buckets are of several files; they are read alike. ``accept`` gets the written table before the
        stage enters the manifest; its result is the metadata, and if it raises, what was written goes. ``hidden``
        columns are for it alone: ``load`` leaves them out.
        """
        path, table = self.folder.at(f"{name}-{uuid.uuid4().hex}"), f"stage_{uuid.uuid4().hex}"
        try:
            writer = df.write.format("parquet").bucketBy(buckets, *by).sortBy(*by).option("path", path)
            writer.saveAsTable(table)
            metadata = dict(accept(self.spark.table(table)) if accept else {})
        except BaseException:
            self.spark.sql(f"DROP TABLE IF EXISTS {table}")
            self.folder.delete(path)
            raise
        previous = self.state.get(name)
        self.state[name] = {
            "metadata": metadata,
            "kind": "bucketed",
            "path": path,
            "table": table,
            "by": list(by),
            "buckets": buckets,
            "hidden": list(hidden),
            "schema": self.spark.table(table).schema.jsonValue(),
            "timestamp": dt.datetime.now(dt.UTC).isoformat(),
            "size_mb": round(self.folder.size(path) / 2**20, 2),
        }
        self._write_state()
        if previous:
            self._delete_data(previous)

    def _load_bucketed(self, entry: Mapping[str, Any]) -> DataFrame:
        """The table by its name; a session that does not know the name gets it from the files."""
        if not self.spark.catalog.tableExists(entry["table"]):
            columns = ", ".join(
                f"`{f.name}` {f.dataType.simpleString()}" for f in StructType.fromJson(entry["schema"]).fields
            )
            by = ", ".join(f"`{c}`" for c in entry["by"])
            path = entry["path"].replace("'", "\\'")
            self.spark.sql(
                f"CREATE TABLE {entry['table']} ({columns}) USING parquet "
                f"CLUSTERED BY ({by}) SORTED BY ({by}) INTO {entry['buckets']} BUCKETS LOCATION '{path}'"
            )
        return self.spark.table(entry["table"]).drop(*entry["hidden"])

    def load(self, name: str) -> Result | None:
        """The stored result, or None when there is none."""
        if not self.has(name):
            return None
        entry = self.state[name]
        if entry["kind"] == "table":
            return self.spark.read.parquet(entry["path"])
        if entry["kind"] == "bucketed":
            return self._load_bucketed(entry)
        if entry["kind"] == "model":
            return PipelineModel.load(entry["path"])
        if entry["kind"] == "tables":
            tables = {k: self.spark.read.parquet(f"{entry['path']}/{k}") for k in entry["tables"]}
            return {**tables, **entry["value"]}
        if entry["kind"] == "parts":
            schema = StructType.fromJson(entry["schema"])
            paths = [p["path"] for p in entry["parts"].values() if p["path"]]
            return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)
        return entry["value"]

    def has(self, name: str) -> bool:
        entry = self.state.get(name)
        return entry is not None and ("path" not in entry or self.folder.exists(entry["path"]))

    def claim(self, fingerprint: str) -> None:
        """Take the folder for a run of this fingerprint; stages of another one are an error."""
        known = self.state.get(FINGERPRINT, {}).get("value")
        if known is None and self.state:
            raise ValueError(f"{self.folder.path} holds stages of unknown origin; take another folder or clear it")
        if known not in (None, fingerprint):
            raise ValueError(
                f"{self.folder.path} holds stages of another table, spec or options; take another folder or clear it"
            )
        if known is None:
            self.state[FINGERPRINT] = {"kind": "value", "value": fingerprint}
            self._write_state()

    def info(self, name: str) -> dict | None:
        return self.state.get(name)

    def list(self) -> dict[str, dict]:
        return {name: entry for name, entry in self.state.items() if name != FINGERPRINT}

    def clear(self, name: str) -> bool:
        """Drop a stage; False when it is not stored."""
        entry = self.state.pop(name, None)
        if entry is None:
            return False
        self._write_state()
        self._delete_data(entry)
        return True

    def clear_all(self) -> bool:
        for name in list(self.state):
            self.clear(name)
        return True

    def _delete_data(self, entry: Mapping[str, Any]) -> None:
        if entry.get("kind") == "bucketed":
            self.spark.sql(f"DROP TABLE IF EXISTS {entry['table']}")  # its files are not the catalogue's
        for path in [entry.get("path"), *(p["path"] for p in entry.get("parts", {}).values())]:
            if path:
                self.folder.delete(path)

    def run_parts(self, name: str, source: DataFrame, part: Column, build: Callable[[DataFrame], DataFrame]) -> DataFrame:
        """A stage by parts (months, say): only parts that are new or whose rows have changed are built and written.

        ``part`` names a row's part, in ``source`` and in what ``build`` makes of it; ``build`` must work on each part by
        itself. A part's rows are told by their number and the sum of their hashes, from one pass over the source. All
        parts to be built are written by one job, each to a folder of its own; the manifest takes them in after that.
        Parts that the source no longer has go. Rows whose part is null are a part.
        """
        key = F.coalesce(part.cast("string"), F.lit("null"))
        hashed = F.sum(F.xxhash64(*source.columns).cast("decimal(38,0)"))
        rows = source.groupBy(key.alias("part")).agg(F.count(F.lit(1)).alias("n"), hashed.alias("sum")).collect()
        now = {r["part"]: f"{r['n']}:{r['sum']}" for r in rows}
        odd = [p for p in now if not re.fullmatch(r"[\w.-]+", p)]
        if odd:
            raise ValueError(f"parts of {name} cannot name folders: {odd[:5]}")
        entry = self.state.get(name, {})
        known = entry.get("parts", {}) if entry.get("kind") == "parts" else {}
        kept = {p: v for p, v in known.items() if now.get(p) == v["digest"] and (not v["path"] or self.folder.exists(v["path"]))}
        todo = sorted(set(now) - set(kept))
        if not todo and len(kept) == len(known) and known:
            return self.load(name)
        made = build(source.filter(key.isin(todo)))
        path, stamp = self.folder.at(f"{name}-{uuid.uuid4().hex}"), dt.datetime.now(dt.UTC).isoformat()
        if todo:
            made.withColumn("_part", key).write.partitionBy("_part").parquet(path)
        folders = {p: f"{path}/_part={p}" for p in todo}
        fresh = {
            p: {"digest": now[p], "path": f if self.folder.exists(f) else None, "timestamp": stamp} for p, f in folders.items()
        }
        self.state[name] = {
            "kind": "parts",
            "metadata": {"stage": name, "built": todo},
            "schema": made.schema.jsonValue(),
            "parts": {**kept, **fresh},
            "timestamp": stamp,
        }
        self._write_state()
        if entry:
            self._delete_data({**entry, "parts": {p: v for p, v in known.items() if p not in kept}})
        return self.load(name)

    def clear_part(self, name: str, part: str) -> bool:
        """Drop one part, so that the next run builds it again; False when it is not stored."""
        gone = self.state.get(name, {}).get("parts", {}).pop(part, None)
        if gone is None:
            return False
        self._write_state()
        self._delete_data({"parts": {part: gone}})
        return True

    def part_status(self, name: str) -> DataFrame:
        """One row per stored part: ``part, timestamp``, in the order of names."""
        parts = self.state.get(name, {}).get("parts", {})
        rows = [(p, v["timestamp"]) for p, v in sorted(parts.items())]
        return self.spark.createDataFrame(rows, "part string, timestamp string")

    def run_stage(
        self,
        name: str,
        build: Callable[[], Result],
        metadata: Callable[[Result], Mapping[str, Any]] | None = None,
    ) -> Result:
        """The stored result of a stage, else build, store and read it back."""
        if not self.has(name):
            result = build()
            self.save(name, result, metadata(result) if metadata else {"stage": name})
        return self.load(name)

    def restart_from(self, name: str) -> bool:
        """Drop a stage and all later ones; an unknown name changes nothing and gives False."""
        if name not in STAGE_ORDER:
            return False
        for later in STAGE_ORDER[STAGE_ORDER.index(name) :]:
            self.clear(later)
        return True

    def status(self) -> DataFrame:
        """One row per stage in running order: ``step, stage, completed, timestamp``."""
        rows = [
            (i, name, self.has(name), self.state.get(name, {}).get("timestamp"))
            for i, name in enumerate(STAGE_ORDER, start=1)
        ]
        return self.spark.createDataFrame(rows, "step int, stage string, completed boolean, timestamp string")
