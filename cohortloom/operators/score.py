"""Batch scoring with a stored model: the table goes through the model once."""

from __future__ import annotations

import json
from collections.abc import Mapping, Sequence

from pyspark.ml import PipelineModel
from pyspark.ml.functions import vector_to_array
from pyspark.ml.linalg import VectorUDT
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.operators.runlog import model_version
from cohortloom.operators.train import input_columns, score
from cohortloom.plans.stages import SharedFolder
from cohortloom.sources.writers import write_csv


SIGNATURE = "signature.json"
#: Whole and broken numbers, each of which holds all values of those before it.
_WIDENING = ("tinyint", "smallint", "int", "bigint", "double")


def check_signature(df: DataFrame, columns: Sequence[str], types: Mapping[str, str] | None = None) -> None:
    """Every model input must be there as a number or boolean; further columns are allowed.

    With the ``types`` of a stored signature an input must have its type, or a number type that goes into it.
    """
    found = {f.name: f.dataType for f in df.schema.fields}
    missing = [c for c in columns if c not in found]
    if missing:
        raise ValueError(f"model inputs are missing: {missing}")
    usable = (T.NumericType, T.BooleanType)
    wrong = {c: found[c].simpleString() for c in columns if not isinstance(found[c], usable)}
    if wrong:
        raise ValueError(f"model inputs are not numbers: {wrong}")
    names = {c: found[c].simpleString() for c in columns}
    other = {c: f"{names[c]}, not {types[c]}" for c in columns if types and c in types and not _fits(names[c], types[c])}
    if other:
        raise ValueError(f"model inputs have other types than in training: {other}")


def _fits(given: str, wanted: str) -> bool:
    if given == wanted or wanted == "double" and given == "float" or wanted.startswith("decimal") and given.startswith("decimal"):
        return True
    return given in _WIDENING and wanted in _WIDENING and _WIDENING.index(given) <= _WIDENING.index(wanted)


def save_model(model: PipelineModel, path: str, df: DataFrame) -> None:
    """Store a model, and beside it the types that its inputs have in ``df``."""
    columns = input_columns(model)
    check_signature(df, columns)
    model.write().save(path)
    types = {f.name: f.dataType.simpleString() for f in df.schema.fields if f.name in columns}
    folder = SharedFolder(df.sparkSession, path)
    folder.write_text(folder.at(SIGNATURE), json.dumps(types))


def stored_types(spark: SparkSession, path: str) -> dict[str, str] | None:
    """The types of a stored model's inputs; none where the model was stored without."""
    folder = SharedFolder(spark, path)
    text = folder.read_text(folder.at(SIGNATURE))
    return None if text is None else json.loads(text)


def predict_registered(
    df: DataFrame,
    versions: DataFrame,
    name: str,
    version: str | None = None,
    stage: str | None = None,
    output_path: str | None = None,
) -> DataFrame:
    """Score by a registered model: the version asked for, the latest of a stage, or the latest.

    ``versions`` has ``name, version, stage`` and ``source``, the model's folder.
    """
    found = model_version(versions, name, version, stage).first()
    return batch_predict(found["source"], df, output_path)


def batch_predict(model: PipelineModel | str, df: DataFrame, output_path: str | None = None) -> DataFrame:
    """All input columns with ``prediction`` and ``probability``; optionally stored.

    The table is scored once, into Parquet at ``<output_path>/parquet``, which
    is the result; the CSV at ``<output_path>/csv`` is written from that.
    """
    types = None
    if isinstance(model, str):
        types = stored_types(df.sparkSession, model)
        model = PipelineModel.load(model)
    check_signature(df, input_columns(model), types)
    scored = score(model, df)
    if output_path is None:
        return scored
    scored.write.parquet(f"{output_path}/parquet")
    stored = df.sparkSession.read.parquet(f"{output_path}/parquet")
    write_csv(stored, f"{output_path}/csv")
    return stored


def predict(model: PipelineModel, df: DataFrame) -> DataFrame:
    """Class and class probabilities of each row: ``predict, p0, p1``."""
    check_signature(df, input_columns(model))
    one = F.col("probability")
    return score(model, df).select(F.col("prediction").alias("predict"), (1 - one).alias("p0"), one.alias("p1"))


def predict_proba(scored: DataFrame, name: str = "probability") -> DataFrame:
    """Add the probability of class 1: column ``p1``, else a probability vector, else the first column."""
    vectors = [f.name for f in scored.schema.fields if isinstance(f.dataType, VectorUDT) and "probability" in f.name]
    if "p1" in scored.columns:
        value = F.col("p1")
    elif vectors:
        value = vector_to_array(F.col(vectors[-1]))[1]
    else:
        value = F.col(scored.columns[0])
    return scored.withColumn(name, value)
