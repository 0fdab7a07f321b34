"""Helpers that several corpus operators share."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.session import shared_folder

UPPER, LOWER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz"
#: Rows of a side that may be broadcast by hint; beyond it the join shuffles both sides.
BROADCAST_ROWS = 1_000_000
#: Bits of a filter that is broadcast: 8 MB however large the tables are.
FILTER_BITS = 1 << 26
#: Bytes of text that a task turns into arrays at a time (one document at least).
SLICE_BYTES = 1 << 20


def keep(df: DataFrame) -> DataFrame:
    """Store rows in the shared checkpoint folder: read more than once, made once, safe from lost executors."""
    shared_folder(df.sparkSession)
    return df.checkpoint()


def text_of(column: str) -> Column:
    """Null texts count as empty."""
    return F.coalesce(F.col(column), F.lit(""))


def numbered(docs: DataFrame, id_column: str, text: str) -> DataFrame:
    """``row, id, text`` of every document; the row number tells apart those that repeat an id."""
    row = F.monotonically_increasing_id()
    return docs.select(row.alias("row"), F.col(id_column).alias("id"), F.col(text).alias("text"))


def stored_rows(docs: DataFrame) -> DataFrame:
    """``row, doc``: a stage's rows under numbers, stored so that every reading of them finds the same numbers."""
    return keep(docs.select(F.monotonically_increasing_id().alias("row"), F.struct("*").alias("doc")))


def texts_of(stored: DataFrame, id_column: str, text: str) -> DataFrame:
    """``row, id, text`` of stored rows, as in ``numbered``."""
    return stored.select("row", F.col("doc")[id_column].alias("id"), F.col("doc")[text].alias("text"))


def small_side(df: DataFrame, rows: int = BROADCAST_ROWS) -> DataFrame:
    """Hint a broadcast if a stored table is counted as small; otherwise leave the join to its shuffle."""
    return F.broadcast(df) if df.limit(rows + 1).count() <= rows else df


def without(stored: DataFrame, losers: DataFrame) -> DataFrame:
    """The documents of ``stored_rows`` whose row is not in the stored table ``losers``, whatever their ids."""
    return stored.join(small_side(losers.select("row").distinct()), "row", "left_anti").select("doc.*")


def slices(texts: pa.Array, limit: int = SLICE_BYTES) -> Iterator[tuple[int, int, np.ndarray, np.ndarray]]:
    """Cut an Arrow text column into runs of rows of about ``limit`` bytes.

    Yields first row, row after the last, their bytes in one array, and the
    rows' offsets in it (one more than rows). Nulls have no bytes.
    """
    texts = texts.cast(pa.large_string())
    if texts.null_count:
        texts = texts.fill_null("")
    n = len(texts)
    if not n:
        return
    _, places, data = texts.buffers()
    at = np.frombuffer(places, np.int64, n + 1, texts.offset * 8)
    whole = np.frombuffer(data, np.uint8) if data is not None else np.zeros(0, np.uint8)
    first = 0
    while first < n:
        last = int(np.searchsorted(at, at[first] + limit, "right")) - 1
        last = min(n, max(first + 1, last))
        yield first, last, whole[at[first] : at[last]], at[first : last + 1] - at[first]
        first = last


def filter_bits(hashes: DataFrame, column: str) -> np.ndarray:
    """Bit map of the low bits of a 64-bit hash column, made by Spark; at most ``FILTER_BITS / 8`` bytes come back."""
    place = F.col(column).bitwiseAND(F.lit(FILTER_BITS - 1))
    parts = (
        hashes.filter(F.col(column).isNotNull())
        .groupBy(F.shiftright(place, 15).alias("part"))
        .agg(F.bitmap_construct_agg(place.bitwiseAND(F.lit(32767))).alias("bits"))
        .collect()
    )
    found = np.zeros((FILTER_BITS >> 15, 4096), np.uint8)
    for row in parts:
        found[row["part"]] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return found.reshape(-1)


def in_filter(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes & np.uint64(FILTER_BITS - 1)
    return (bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0


def mixed(x: np.ndarray) -> np.ndarray:
    """Spread 64-bit values over all bits."""
    x = (x ^ (x >> np.uint64(31))) * np.uint64(0x9E3779B97F4A7C15)
    x = (x ^ (x >> np.uint64(29))) * np.uint64(0xC2B2AE3D27D4EB4F)
    return x ^ (x >> np.uint64(32))


def components(edges: DataFrame) -> DataFrame:
    """Connected components of edges ``a, b`` (bigint): ``node, root`` with the smallest node as root.

    Alternating large and small stars: every round links a node's greater
    neighbours, then its smaller ones, to the smallest node it knows, until
    nothing changes. Edges stay a distributed table; a count and a checksum per
    round come back. Minima are combined before the shuffle, so a hub is no hot key.
    """
    shape = [F.greatest("a", "b").alias("a"), F.least("a", "b").alias("b")]
    now = keep(edges.filter("a <> b").select(*shape).distinct())
    seen = _state(now)
    while seen[0]:
        both = now.unionAll(now.select(F.col("b").alias("a"), F.col("a").alias("b")))
        low = both.groupBy("a").agg(F.min("b").alias("m")).select("a", F.least("a", "m").alias("m"))
        large = both.join(low, "a").filter("b > a").select(F.col("b").alias("a"), F.col("m").alias("b"))
        large = large.filter("a <> b").distinct()
        low = large.groupBy("a").agg(F.min("b").alias("m"))
        small = large.join(low, "a").select(F.col("b").alias("a"), F.col("m").alias("b")).filter("a <> b")
        now = keep(small.unionAll(low.select("a", F.col("m").alias("b"))).select(*shape).distinct())
        before, seen = seen, _state(now)
        if seen == before:
            break
    return now.select(F.col("a").alias("node"), F.col("b").alias("root"))


def _state(edges: DataFrame) -> tuple:
    row = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("a", "b").cast("decimal(38,0)"))).first()
    return tuple(row)
