"""Benchmark decontamination by winnowing.

Words are runs of digits, letters A-Z (in lower case) and characters beyond
ASCII. An item's windows are its runs of ten words; an item of fewer words is
one window. Of every run of ten words, the smallest of its six hashes of five
words is kept as a fingerprint, in documents and items alike, so a shared
window always shares a fingerprint at the same place. Fingerprints of documents
are joined with those of the benchmark, and each hit is extended to the windows
around it, which are compared as text. For items shorter than ten words all
runs of their length are fingerprints.

Before the join, tasks drop fingerprints that a filter of 8 MB, made from the
benchmark's, rules out; the filter has that size for any benchmark, and the join
behind it is exact.

Null and empty texts have no words and no hits; items without words have no
windows. Rows that repeat an item id count as one item; an item without an id
hits words but is not counted. Documents are rows: repeated or missing ids make
no difference. An empty benchmark leaves all documents clean. Further columns are
ignored.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.common import filter_bits, in_filter, keep, numbered, slices, stored_rows, texts_of, without
from cohortloom.llm.words import LOWER, gram_hashes, hashed_words

WINDOW_WORDS = 10
GRAM_WORDS = 5

_SCHEMA = "row bigint, id {kind}, n_words bigint, size int, first bigint, hash bigint, context string"


def winnowed(hashes: np.ndarray, row: np.ndarray, size: int) -> tuple[np.ndarray, np.ndarray, int]:
    """Places and hashes of the fingerprints for windows of ``size`` words, and their length in words."""
    k = GRAM_WORDS if size == WINDOW_WORDS else size
    grams = gram_hashes(hashes, k)
    n, wide = len(grams) - (size - k), size - k
    if n <= 0:
        return np.zeros(0, np.int64), np.zeros(0, np.uint64), k
    open_ = row[:n] == row[size - 1 : size - 1 + n]
    low = grams[:n].copy()
    for j in range(1, wide + 1):
        np.minimum(low, grams[j : j + n], out=low)
    chosen = np.zeros(len(grams), bool)
    for j in range(wide, -1, -1):
        hit = open_ & (grams[j : j + n] == low)
        chosen[j : j + n] |= hit
        open_ &= ~hit
    at = np.nonzero(chosen)[0]
    return at, grams[at], k


def _fingerprints(sizes: list[int], bits, own: bool):
    """Map rows (row, id, text) to one row with the word count and one for each fingerprint.

    ``bits`` holds the filter; ``own``: a text has windows of one size only, the
    usual one or, if it is shorter, its own length.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for first, last, data, at in slices(batch.column(2)):
                yield part(batch.slice(first, last - first), data, at)

    def part(batch: pa.RecordBatch, data: np.ndarray, at: np.ndarray) -> pa.RecordBatch:
        starts, ends, hashes = hashed_words(data, at)
        row = np.searchsorted(at, starts, "right") - 1
        edge = np.searchsorted(row, np.arange(len(at)))
        counts = np.diff(edge)
        rows, size_of, first_of, hash_of, texts = [], [], [], [], []
        for size in sizes:
            places, prints, k = winnowed(hashes, row, size)
            keep_ = np.ones(len(places), bool) if bits is None else in_filter(bits.value, prints)
            if own and size < WINDOW_WORDS:
                keep_ &= counts[row[places]] == size
            for p, h in zip(places[keep_].tolist(), prints[keep_].view(np.int64).tolist(), strict=True):
                r = int(row[p])
                a, b = max(int(edge[r]), p - (size - k)), min(int(edge[r + 1]), p + size)
                low = LOWER[data[starts[a] : ends[b - 1]]].tobytes()
                base = int(starts[a])
                edges = zip(starts[a:b].tolist(), ends[a:b].tolist(), strict=True)
                words = [low[s - base : e - base] for s, e in edges]
                rows.append(r)
                size_of.append(size)
                first_of.append(a - int(edge[r]))
                hash_of.append(h)
                texts.append(b" ".join(words).decode("utf-8", "replace"))
        n = batch.num_rows
        take = pa.array(np.concatenate((np.arange(n), np.array(rows, np.int64))))
        none = [None] * n
        return pa.RecordBatch.from_arrays(
            [
                batch.column(0).take(take),
                batch.column(1).take(take),
                pa.array([*counts.tolist(), *[None] * len(rows)], pa.int64()),
                pa.array([*none, *size_of], pa.int32()),
                pa.array([*none, *first_of], pa.int64()),
                pa.array([*none, *hash_of], pa.int64()),
                pa.array([*none, *texts], pa.string()),
            ],
            ["row", "id", "n_words", "size", "first", "hash", "context"],
        )

    return run


def _mapped(slim: DataFrame, sizes: list[int], bits=None, own: bool = False) -> DataFrame:
    kind = slim.schema["id"].dataType.simpleString()
    return keep(slim.mapInArrow(_fingerprints(sizes, bits, own), _SCHEMA.format(kind=kind)))


def _windows(prints: DataFrame, *columns: Column | str) -> DataFrame:
    """Extend each fingerprint to all windows around it: their first word and text."""
    words = F.split("context", " ")
    steps = F.sequence(F.lit(0), F.size(words) - F.col("size"))
    spread = prints.select("*", F.explode(steps).alias("_step"))
    text = F.array_join(F.slice(words, F.col("_step") + 1, F.col("size")), " ")
    return spread.select(*columns, "size", (F.col("first") + F.col("_step")).alias("start"), text.alias("window"))


def contaminated_words(
    docs: DataFrame,
    benchmark: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    item_column: str = "item_id",
    item_text: str = "text",
) -> DataFrame:
    """One row per document: its id, ``n_words, n_hit, n_items, items`` (sorted ids as text) and ``contaminated``."""
    items = numbered(benchmark, item_column, item_text)
    return _hits(numbered(docs, id_column, text), items).drop("row").withColumnRenamed("id", id_column)


def _hits(docs: DataFrame, benchmark: DataFrame) -> DataFrame:
    """``contaminated_words`` of rows ``row, id, text``, with ``row`` and ``id``."""
    items = _mapped(benchmark, list(range(1, WINDOW_WORDS + 1)), own=True)
    items = items.filter("hash IS NOT NULL")
    sizes = sorted(r["size"] for r in items.select("size").distinct().collect())
    bits = docs.sparkSession.sparkContext.broadcast(filter_bits(items, "hash"))
    rows = _mapped(docs, sizes, bits)
    prints = rows.filter("hash IS NOT NULL").join(items.select("size", "hash").distinct(), ["size", "hash"], "left_semi")
    owners = (
        _windows(items, F.col("id").cast("string").alias("item"))
        .groupBy("size", "window")
        .agg(F.collect_set("item").alias("found"))
    )
    hits = _windows(prints, "row").join(owners, ["size", "window"]).select("row", "start", "size", "found")
    by_start = Window.partitionBy("row").orderBy("start").rowsBetween(Window.unboundedPreceding, -1)
    end = F.col("start") + F.col("size")
    fresh = end - F.greatest(F.col("start"), F.coalesce(F.max(end).over(by_start), F.lit(0)))
    spans = (
        hits.select("row", F.greatest(fresh, F.lit(0)).alias("fresh"))
        .groupBy("row")
        .agg(F.sum("fresh").cast("bigint").alias("n_hit"))
    )
    named = (
        hits.select("row", F.explode("found").alias("item"))
        .distinct()
        .groupBy("row")
        .agg(F.sort_array(F.collect_list("item")).alias("items"))
    )
    stats = rows.filter("hash IS NULL").select("row", "id", "n_words")
    none = F.array().cast("array<string>")
    return (
        stats.join(spans, "row", "left")
        .join(named, "row", "left")
        .select(
            "row",
            "id",
            "n_words",
            F.coalesce("n_hit", F.lit(0).cast("bigint")).alias("n_hit"),
            F.coalesce(F.size(F.coalesce("items", none)), F.lit(0)).cast("bigint").alias("n_items"),
            F.coalesce("items", none).alias("items"),
            F.col("n_hit").isNotNull().alias("contaminated"),
        )
    )


def decontaminate(docs: DataFrame, benchmark: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Rows without a benchmark window, with their columns."""
    rows = stored_rows(docs)
    found = _hits(texts_of(rows, id_column, text), numbered(benchmark, "item_id", "text"))
    return without(rows, keep(found.filter("contaminated").select("row")))
