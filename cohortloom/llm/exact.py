"""Exact deduplication by progressive refinement: length, then prefix hash, then full hash.

The first scan groups documents by the length of their normalised text and a
hash of its first characters. Only groups of two or more go on: the second scan
takes the full hash of their documents alone. What passes between the scans is
a filter of fixed size, so no text is shuffled to find the survivors; a document
that passes the filter by chance is hashed once more than needed, no more.

Texts are equal when identical after each run of ASCII white space is replaced
by one space. Null texts are empty texts. Rows without an id are documents;
the first stays only where no row with an id has their text. Of rows that repeat
the smallest id with an equal text, one stays; a decision holds for its row alone. Further columns are carried or ignored.
"""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import keep, numbered, stored_rows, text_of, texts_of, without

PREFIX_CHARS = 128
#: Bits of the survivors' filter, broadcast as at most 2^18 words of 64 bits.
SURVIVOR_BITS = 1 << 24


def normalised(text: str) -> Column:
    return F.regexp_replace(text_of(text), r"[\x20\x09-\x0D]+", " ")


def _level(norm: Column) -> Column:
    """One hash of the first two levels: length and first characters."""
    return F.xxhash64(F.octet_length(norm), F.substring(norm, 1, PREFIX_CHARS))


def _word(level: Column) -> tuple[Column, Column]:
    place = level.bitwiseAND(F.lit(SURVIVOR_BITS - 1))
    return F.shiftright(place, 6), place.bitwiseAND(F.lit(63)).cast("int")


def survivors(docs: DataFrame, text: str) -> DataFrame:
    """Filter of the (length, prefix) groups with two or more documents: ``_word, _bits``."""
    lengths = docs.select(normalised(text).alias("_norm")).select(
        F.octet_length("_norm").alias("length"), F.substring("_norm", 1, PREFIX_CHARS).alias("prefix")
    )
    groups = lengths.groupBy("length", F.xxhash64("length", "prefix").alias("level")).agg(F.count(F.lit(1)).alias("n"))
    word, bit = _word(F.col("level"))
    return (
        groups.filter("n > 1")
        .groupBy(word.alias("_word"))
        .agg(F.bit_or(F.call_function("shiftleft", F.lit(1).cast("bigint"), bit)).alias("_bits"))
    )


def with_full_hash(docs: DataFrame, text: str, extra: Mapping[str, Column] | None = None) -> DataFrame:
    """Add ``_full``: SHA-256 of the normalised text for documents of surviving groups, else null.

    ``extra`` columns may use ``_norm``, the normalised text.
    """
    level = docs.withColumn("_norm", normalised(text)).withColumn("_level", _level(F.col("_norm")))
    word, bit = _word(F.col("_level"))
    marked = level.withColumns({"_word": word, "_bit": bit}).join(F.broadcast(survivors(docs, text)), "_word", "left")
    hit = F.coalesce(F.call_function("shiftright", F.col("_bits"), F.col("_bit")).bitwiseAND(F.lit(1)), F.lit(0)) == 1
    full = F.when(hit, F.sha2("_norm", 256)).alias("_full")
    return marked.select(*docs.columns, full, *(c.alias(n) for n, c in (extra or {}).items()))


def exact_groups(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", extra: Mapping[str, Column] | None = None
) -> DataFrame:
    """One row per document: its id, ``keep_id, group_size, kept`` and the ``extra`` columns."""
    return _groups(numbered(docs, id_column, text), id_column, extra).drop("_row")


def _groups(slim: DataFrame, id_column: str, extra: Mapping[str, Column] | None = None) -> DataFrame:
    """The columns of ``exact_groups`` and ``_row`` for rows ``row, id, text``."""
    slim = slim.select(F.col("row").alias("_row"), F.col("id").alias("_id"), F.col("text").alias("_text"))
    names = list(extra or {})
    rows = keep(with_full_hash(slim, "_text", extra).drop("_text"))
    first = F.min(F.struct(F.col("_id").isNull(), "_id", "_row")).alias("_first")
    # Stored, so that nothing stands between the join and its shuffles: a hot group is then split between tasks.
    groups = rows.filter("_full IS NOT NULL").groupBy("_full").agg(first, F.count(F.lit(1)).alias("group_size"))
    shared = rows.join(keep(groups), "_full").select(
        "_row",
        F.col("_id").alias(id_column),
        F.col("_first._id").alias("keep_id"),
        "group_size",
        (F.col("_row") == F.col("_first._row")).alias("kept"),
        *names,
    )
    alone = rows.filter("_full IS NULL").select(
        "_row",
        F.col("_id").alias(id_column),
        F.col("_id").alias("keep_id"),
        F.lit(1).cast("bigint").alias("group_size"),
        F.lit(True).alias("kept"),
        *names,
    )
    return shared.unionByName(alone)


def exact_dedup(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """The rows that stay, one of each text, with their columns."""
    rows = stored_rows(docs)
    dropped = _groups(texts_of(rows, id_column, text), id_column).filter("NOT kept")
    return without(rows, keep(dropped.select(F.col("_row").alias("row"))))
