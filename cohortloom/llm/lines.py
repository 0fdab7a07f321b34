"""Substring deduplication by line or paragraph hashing.

A unit is a line, or a paragraph (lines between blank ones). Within units that do not
repeat as a whole, their sentences can be compared as well: a passage inside a longer line,
or a line of which one word was changed, is found by them. Units and sentences are
normalised (A-Z to lower case, runs of ASCII white space to one space, none at
the ends) and hashed to 128 bits; digests are grouped over all documents, the
occurrence that ranks first (smallest id, then place) stays and the others are
removed. Offsets are in characters of the original text. Every unit that is
not empty is compared, unless the caller sets a least number of words.

Digests are combined before the shuffle, so a line that a third of the corpus
has is a few rows per task. Null and empty texts have no units that count; rows
without an id rank last; rows that repeat an id rank by an arbitrary but fixed
order. Further columns are ignored, an empty table has no removed units.
"""

from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import keep, numbered, stored_rows, texts_of

MIN_WORDS = 1
_BLANK = re.compile(r"\n(?:[ \t]*\n)+")
#: A sentence ends before white space.
_SENTENCE = re.compile(r"[.!?]([ \t]+)")
_UNITS = "row bigint, id {kind}, unit int, part int, start bigint, end bigint, n_words int, digest binary"


def units(text: str, paragraphs: bool = False) -> Iterator[tuple[int, int, str]]:
    """Start, end and text of each unit."""
    if not paragraphs:
        at = 0
        for line in text.split("\n"):
            yield at, at + len(line), line
            at += len(line) + 1
        return
    at = 0
    for gap in [*_BLANK.finditer(text), None]:
        end = gap.start() if gap else len(text)
        yield at, end, text[at:end]
        at = gap.end() if gap else end


def sentences(unit: str) -> list[tuple[int, int]]:
    """Start and end of each sentence that is not blank."""
    cuts = [(m.start(1), m.end()) for m in _SENTENCE.finditer(unit)]
    starts = [0, *(end for _, end in cuts)]
    found = zip(starts, [*(stop for stop, _ in cuts), len(unit)], strict=True)
    return [(a, b) for a, b in found if unit[a:b].strip(" \t\r\x0b\x0c")]


def _unit_batches(paragraphs: bool, min_words: int, sentence_words: int | None):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found: list[tuple] = []
            rows: list[int] = []
            for r, value in enumerate(batch.column(2)):
                for k, (a, b, unit) in enumerate(units(value.as_py() or "", paragraphs)):
                    parts = [(0, a, b, unit, min_words)]
                    if sentence_words is not None and len(inner := sentences(unit)) > 1:
                        parts += [(p, a + x, a + y, unit[x:y], sentence_words) for p, (x, y) in enumerate(inner, 1)]
                    for part, start, end, piece, least in parts:
                        words = piece.encode("utf-8", "surrogatepass").lower().split()
                        if len(words) >= least:
                            rows.append(r)
                            found.append((k, part, start, end, len(words), hashlib.md5(b" ".join(words)).digest()))
                if len(found) > 50_000:
                    yield table(batch, rows, found)
                    found, rows = [], []
            yield table(batch, rows, found)

    def table(batch: pa.RecordBatch, rows: list[int], found: list[tuple]) -> pa.RecordBatch:
        take = pa.array(rows, pa.int64())
        kinds = (pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int32(), pa.binary())
        columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds)]
        return pa.RecordBatch.from_arrays(
            [batch.column(0).take(take), batch.column(1).take(take), *columns],
            ["row", "id", "unit", "part", "start", "end", "n_words", "digest"],
        )

    return run


def repeated_units(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    paragraphs: bool = False,
    min_words: int = MIN_WORDS,
    sentence_words: int | None = None,
) -> DataFrame:
    """One row per removed unit: its document, place and digest, and the document and unit that stay.

    ``part`` is 0 for a whole unit. With ``sentence_words``, sentences of so many words at least are removed too
    where their unit stays; they are numbered from 1 in it. Spans of one document never overlap.
    """
    return _repeated(numbered(docs, id_column, text), id_column, paragraphs, min_words, sentence_words)


def _repeated(
    slim: DataFrame, id_column: str, paragraphs: bool, min_words: int, sentence_words: int | None
) -> DataFrame:
    kind = slim.schema["id"].dataType.simpleString()
    rows = keep(slim.mapInArrow(_unit_batches(paragraphs, min_words, sentence_words), _UNITS.format(kind=kind)))
    rank = F.struct(F.col("id").isNull().alias("last"), "id", "row", "unit", "part")
    first = rows.groupBy("digest").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    # Stored, so that nothing stands between the join and its shuffles: a hot group is then split between tasks.
    first = keep(first)
    places = ("row", "unit", "part")
    later = F.lit(False)
    for c in places:
        later = later | (F.col(c) != F.col(f"first.{c}"))
    removed = rows.join(first, "digest").filter(later)
    if sentence_words is not None:
        removed = keep(removed)
        whole = removed.filter("part = 0").select("row", "unit")
        inside = removed.filter("part > 0").join(whole, ["row", "unit"], "left_anti")
        removed = removed.filter("part = 0").unionByName(inside)
    return removed.select(
        F.col("id").alias(id_column),
        *places,
        "start",
        "end",
        "n_words",
        F.lower(F.hex("digest")).alias("digest"),
        F.col("first.id").alias("keep_id"),
        F.col("first.unit").alias("keep_unit"),
        F.col("first.part").alias("keep_part"),
    )


def cut_repeats(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    paragraphs: bool = False,
    min_words: int = MIN_WORDS,
    sentence_words: int | None = None,
) -> DataFrame:
    """All documents, in the columns they came with, without their repeated units.

    Spans belong to rows, so rows that share an id, or have none, lose their own repeats and no others'.
    """
    stored = stored_rows(docs)
    spans = _repeated(texts_of(stored, id_column, text), id_column, paragraphs, min_words, sentence_words)
    return cut_spans(stored, spans, text)


def cut_spans(stored: DataFrame, spans: DataFrame, text: str = "text") -> DataFrame:
    """Documents of ``stored_rows`` without the spans ``start, end`` (characters) of their row, and without the line
    break behind whole units."""
    behind = F.when(F.col("part") == 0, F.col("end") + 1).otherwise(F.col("end")) if "part" in spans.columns else F.col("end") + 1
    ordered = F.sort_array(F.collect_list(F.struct("start", behind.alias("end"))))
    grouped = spans.groupBy("row").agg(ordered.alias("spans"))
    value = f"doc.`{text}`"
    begin = "CASE WHEN i = 0 THEN 0 ELSE spans[i - 1].end END"
    stop = f"CASE WHEN i = size(spans) THEN length({value}) ELSE spans[i].start END"
    piece = f"substring({value}, {begin} + 1, greatest(0, {stop} - ({begin})))"
    kept = F.expr(f"array_join(transform(sequence(0, size(spans)), i -> {piece}), '')")
    whole = F.when(F.col("spans").isNull(), F.col("doc")[text]).otherwise(kept)
    names = stored.schema["doc"].dataType.names
    return stored.join(grouped, "row", "left").select(*((whole if c == text else F.col("doc")[c]).alias(c) for c in names))
