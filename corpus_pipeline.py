"""A corpus pipeline: quality, exact copies, near copies (SimHash), benchmark passages, packing.

Every stage takes ``(spark, docs, sf_dir)`` and works on all rows of ``docs``; all
but the last return documents with the columns they came with.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cohortloom.llm import decontaminate, exact, packing, quality, simhash
from cohortloom.llm.queries import table
from cohortloom.plans.stages import SharedFolder
from cohortloom.session import fresh_folder


def accept_quality(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that the rule ensemble accepts, learned from the labels of ``docs``.

    Null texts are scored as empty ones. Rows that repeat an id, and rows without one, are judged each by its own text.
    """
    return quality.keep_quality(docs, quality.fit(docs, table(spark, sf_dir, "labels")))


def drop_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each group of equal texts.

    Null texts are empty ones. Of rows that repeat the smallest id one stays, a row without an id only where no other has its text.
    """
    return exact.exact_dedup(docs)


def drop_near_copies(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each component of near copies: fingerprints of three words, two bits apart.

    Null texts and texts without words have one fingerprint, so one of them stays. Of rows that repeat an id one stays, rows
    without an id last. An empty table stays empty.
    """
    return simhash.near_dedup(docs)


def drop_contaminated(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents without a window of a benchmark item; rows are judged one by one, null and empty texts stay."""
    return decontaminate.decontaminate(docs, table(spark, sf_dir, "benchmark"))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Pieces of the documents' tokens and their places in sequences; a null or empty text is a piece with the end alone."""
    return packing.pack(docs)


STAGES = [
    ("quality", accept_quality),
    ("exact", drop_copies),
    ("near", drop_near_copies),
    ("decontaminate", drop_contaminated),
    ("pack", pack_sequences),
]

#: Trees, fingerprints and tokens have no SQL form; tests hold the result against plain versions.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Apply the stages to ``documents``; each result but the last is stored, read again and then deleted.

    The last stage keeps what it needs in a checkpoint before it returns.
    """
    docs, stored = table(spark, sf_dir, "documents"), None
    for name, stage in STAGES[:-1]:
        path = fresh_folder(spark, f"corpus-{name}")
        stage(spark, docs, sf_dir).write.parquet(path)
        docs = spark.read.parquet(path)
        _delete(spark, stored)
        stored = path
    result = STAGES[-1][1](spark, docs, sf_dir)
    _delete(spark, stored)
    return result


def _delete(spark: SparkSession, path: str | None) -> None:
    if path:
        SharedFolder(spark, path).delete(path)
