"""Line deduplication by content-defined chunks of lines.

Lines are hashed, and a rolling hash over the last three line hashes chooses
where a chunk ends, so boundaries depend on the lines nearby and come back after
a shift. A chunk ends after two lines at the earliest, so a single line joins the ones behind it; where
lines repeat with a period of one or two, the rolling hash stands still and every second line ends a chunk. Chunks of two or more lines that occur again anywhere are removed, but
for the occurrence that ranks first (smallest id, then place), after their bytes
are compared.

The first scan gives digests only. Those that occur twice make a filter of fixed
size (8 MB), and the second scan gives the bytes of chunks that pass it. Grouping
by digest and bytes is the comparison; a chunk that passes by chance is alone in its
group. Groups are combined before the shuffle, so hot chunks are a few rows per
task. Null and empty texts have no chunk of two lines; rows without an id rank
last; repeated ids rank by a fixed order. Further columns are ignored.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import filter_bits, in_filter, keep, numbered

#: Fixed values of the boundary rule: lines in the rolling hash, its base and modulus, and lines per boundary.
ROLLING_LINES = 3
ROLLING_BASE = 31
ROLLING_MODULUS = 1_000_003
MEAN_LINES = 4
MIN_LINES = 2

_CHUNKS = "row bigint, id {kind}, chunk int, line int, n_lines int, start bigint, end bigint, hash bigint, text string"


def chunks(text: str) -> Iterator[tuple[int, int, int, int]]:
    """First line, lines, start and end (characters) of each chunk."""
    lines = text.split("\n")
    hashes = [int.from_bytes(hashlib.md5(x.encode("utf-8", "surrogatepass")).digest()[:4], "big") for x in lines]
    first, start, at, rolling, before = 0, 0, 0, 0, (-1, -1)
    leaving = ROLLING_BASE**ROLLING_LINES
    for k, line in enumerate(lines):
        gone = hashes[k - ROLLING_LINES] if k >= ROLLING_LINES else 0
        rolling = rolling * ROLLING_BASE + hashes[k] - gone * leaving
        at += len(line)
        ends = rolling % ROLLING_MODULUS % MEAN_LINES == 0 or rolling in before
        if ends and k + 1 - first >= MIN_LINES or k == len(lines) - 1:
            yield first, k + 1 - first, start, at
            first, start = k + 1, at + 1
        at += 1
        before = rolling, before[0]


def _chunk_batches(bits):
    """Rows of all chunks of two or more lines, or of those in the filter with their text."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            rows, found, held = [], [], 0
            for r, value in enumerate(batch.column(2)):
                text = value.as_py() or ""
                for k, (line, n, a, b) in enumerate(chunks(text)):
                    if n >= MIN_LINES:
                        piece = text[a:b]
                        digest = hashlib.md5(piece.encode("utf-8", "surrogatepass")).digest()
                        code = int.from_bytes(digest[:8], "big", signed=True)
                        if bits is None or in_filter(bits.value, np.array([code], np.int64).view(np.uint64))[0]:
                            rows.append(r)
                            found.append((k, line, n, a, b, code, None if bits is None else piece))
                            held += 0 if bits is None else len(piece)
                if held > 1 << 22 or len(found) > 50_000:
                    yield table(batch, rows, found)
                    rows, found, held = [], [], 0
            yield table(batch, rows, found)

    def table(batch: pa.RecordBatch, rows: list[int], found: list[tuple]) -> pa.RecordBatch:
        take = pa.array(rows, pa.int64())
        kinds = (pa.int32(), pa.int32(), pa.int32(), pa.int64(), pa.int64(), pa.int64(), pa.string())
        columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds)]
        names = ["row", "id", "chunk", "line", "n_lines", "start", "end", "hash", "text"]
        return pa.RecordBatch.from_arrays([batch.column(0).take(take), batch.column(1).take(take), *columns], names)

    return run


def repeated_chunks(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per removed chunk: its document and place, and the document and chunk that stay."""
    slim = numbered(docs, id_column, text)
    schema = _CHUNKS.format(kind=slim.schema["id"].dataType.simpleString())
    codes = slim.mapInArrow(_chunk_batches(None), schema).groupBy("hash").agg(F.count(F.lit(1)).alias("n"))
    bits = docs.sparkSession.sparkContext.broadcast(filter_bits(codes.filter("n > 1"), "hash"))
    rows = keep(slim.mapInArrow(_chunk_batches(bits), schema))
    rank = F.struct(F.col("id").isNull().alias("last"), "id", "row", "chunk")
    groups = rows.groupBy("hash", "text").agg(F.min(rank).alias("first"), F.count(F.lit(1)).alias("n")).filter("n > 1")
    # Stored, so that nothing stands between the join and its shuffles: a hot group is then split between tasks.
    groups = keep(groups)
    later = (F.col("row") != F.col("first.row")) | (F.col("chunk") != F.col("first.chunk"))
    return (
        rows.join(groups, ["hash", "text"])
        .filter(later)
        .select(
            F.col("id").alias(id_column),
            "row",
            "chunk",
            "line",
            "n_lines",
            "start",
            "end",
            F.col("first.id").alias("keep_id"),
            F.col("first.chunk").alias("keep_chunk"),
        )
    )
