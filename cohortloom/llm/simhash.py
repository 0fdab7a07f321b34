"""SimHash near-duplicates by a byte-position inverted index with count filtering.

A fingerprint has eight bytes, each at its position. Fingerprints that differ in
at most two bits share at least six of the eight positional bytes: that is the
guaranteed minimum of the count filter. Posting lists of single bytes would hold
a 256th of the corpus each and meet in pairs, so a list here belongs to six
positions and their bytes: a pair meets in one of the 28 lists exactly when its
tally reaches six. Inside a list the tally is taken over all eight positions,
pairs below the minimum go, and the rest are verified by their bits. A long list finds its
candidates by looking up what is one or two bits away, and tallies and verifies those. A list
differs in two bytes only and so holds at most 65,536 distinct fingerprints,
however many documents there are. It gives a spanning set of verified links, not
all pairs; components of links are unchanged by that.

Equal fingerprints are one node, so copies are never paired. Null texts and texts
without words have fingerprint zero. Rows without an id are fingerprinted; a
component is named by its smallest id, which is null if it has none. An empty
table gives no rows.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import components, keep, numbered, stored_rows, texts_of, without
from cohortloom.session import shuffle_width

SHINGLE_WORDS = 3
SEED = 42
MAX_BITS = 2
SHARED_BYTES = 6
PART_BYTES = 1 << 20
#: Lists up to this size are tallied as a matrix of all pairs, larger ones for looked-up neighbours.
MATRIX = 256
_WHITE = b" \t\n\r\x0b\x0c"


def shingle_hashes(data: bytes, width: int = SHINGLE_WORDS) -> Iterator[np.ndarray]:
    """XXH64 of every run of ``width`` words, a part of the text at a time."""
    carried: list[bytes] = []
    digest = xxhash.xxh64_intdigest
    at, seen = 0, 0
    while at < len(data):
        end = min(len(data), at + PART_BYTES)
        while end < len(data) and data[end] not in _WHITE:
            end += 1
        words = carried + data[at:end].split()
        seen += len(words) - len(carried)
        carried = words[max(0, len(words) - width + 1) :]
        at = end
        if len(words) < width:
            continue
        joined = b" ".join(words)
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        pairs = zip(starts[: len(words) - width + 1].tolist(), ends[width - 1 :].tolist(), strict=True)
        yield np.array([digest(joined[a:b], SEED) for a, b in pairs], np.uint64)
    if 0 < seen < width:
        yield np.array([digest(b" ".join(carried), SEED)], np.uint64)


def _text_hashes(text: str | None, width: int) -> Iterator[np.ndarray]:
    return shingle_hashes((text or "").encode("utf-8", "surrogatepass").lower(), width)


def fingerprint(text: str | None, width: int = SHINGLE_WORDS) -> int:
    """Bits set in more than half of the shingle hashes, as an unsigned integer."""
    return _voted(_text_hashes(text, width))


def _voted(parts: Iterator[np.ndarray]) -> int:
    total, votes = 0, np.zeros(64, np.int64)
    for hashes in parts:
        total += len(hashes)
        for at in range(0, len(hashes), 1 << 16):
            octets = hashes[at : at + (1 << 16)].astype(">u8").view(np.uint8).reshape(-1, 8)
            votes += np.unpackbits(octets, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(2 * votes > total).tobytes(), "big") if total else 0


def _fingerprint_batches(words: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            prints = [fingerprint(value.as_py(), words) for value in batch.column(2)]
            columns = [batch.column(0), batch.column(1), pa.array(np.array(prints, np.uint64).view(np.int64))]
            yield pa.RecordBatch.from_arrays(columns, ["row", "id", "fp"])

    return run


def fingerprints(slim: DataFrame, words: int = SHINGLE_WORDS) -> DataFrame:
    """``row, id, fp`` of rows ``row, id, text``; ``fp`` is the fingerprint as a signed integer."""
    kind = slim.schema["id"].dataType.simpleString()
    return slim.mapInArrow(_fingerprint_batches(words), f"row bigint, id {kind}, fp bigint")


def _masks() -> list[int]:
    """A mask for each choice of the shared positions, as signed 64-bit integers."""
    masks = []
    for places in combinations(range(8), SHARED_BYTES):
        mask = sum(0xFF << (8 * p) for p in places)
        masks.append(mask - (1 << 64) if mask >= 1 << 63 else mask)
    return masks


def _bits(x: np.ndarray) -> np.ndarray:
    return np.bitwise_count(x)


def list_links(members: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Links that span the verified pairs of one posting list (distinct unsigned fingerprints)."""
    members = np.sort(members)
    n = len(members)
    octets = members.view(np.uint8).reshape(n, 8)
    if n <= MATRIX:
        tally = (octets[:, None, :] == octets[None, :, :]).sum(axis=2)
        i, j = np.nonzero(np.triu(tally >= SHARED_BYTES, 1))
        close = _bits(members[i] ^ members[j]) <= MAX_BITS
        i, j = i[close], j[close]
    else:
        free = int(np.bitwise_or.reduce(members ^ members[0]))
        singles = [1 << b for b in range(64) if free >> b & 1]
        steps = singles + [a | b for a, b in combinations(singles, 2)]
        found = []
        for step in steps:
            to = members ^ np.uint64(step)
            at = np.minimum(np.searchsorted(members, to), n - 1)
            hit = np.nonzero((members[at] == to) & (members < to))[0]
            found.append((hit, at[hit]))
        i, j = (np.concatenate(x) for x in zip(*found, strict=True)) if found else (np.zeros(0, int),) * 2
        shared = (octets[i] == octets[j]).sum(axis=1) >= SHARED_BYTES
        i, j = i[shared], j[shared]
    root = np.arange(n)
    while len(i):
        low = np.minimum(root[i], root[j])
        before = root.copy()
        np.minimum.at(root, root[i], low)
        np.minimum.at(root, root[j], low)
        root = root[root]
        if (root == before).all():
            break
    tied = np.nonzero(root != np.arange(n))[0]
    return members[tied], members[root[tied]]


def _link_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        column = batch.column(0)
        values, at = column.values.to_numpy(), column.offsets.to_numpy()
        found = [list_links(values[s:e].view(np.uint64)) for s, e in zip(at[:-1], at[1:], strict=True)]
        sides = [np.concatenate([f[k] for f in found] or [np.zeros(0, np.uint64)]).view(np.int64) for k in (0, 1)]
        yield pa.RecordBatch.from_arrays([pa.array(x) for x in sides], ["a", "b"])


def links(nodes: DataFrame) -> DataFrame:
    """Verified links ``a, b`` between the distinct fingerprints of ``nodes`` (column ``fp``)."""
    postings = F.array(*(F.struct(F.lit(i).alias("list"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(_masks())))
    # Few and small: without a number of their own, the nodes would be multiplied in a task or two.
    spread = nodes.select("fp").repartition(shuffle_width(nodes.sparkSession))
    rows = spread.select("fp", F.explode(postings).alias("p")).select("p.list", "p.key", "fp")
    lists = rows.groupBy("list", "key").agg(F.collect_list("fp").alias("members")).filter(F.size("members") > 1)
    return lists.select("members").mapInArrow(_link_batches, "a bigint, b bigint")


def near_groups(
    docs: DataFrame, id_column: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS
) -> DataFrame:
    """One row per document: its id, ``fp`` and ``component_id``, the smallest id that links reach."""
    groups = _groups(numbered(docs, id_column, text), words)
    return groups.select(F.col("id").alias(id_column), "fp", F.col("first.id").alias("component_id"))


def _groups(slim: DataFrame, words: int) -> DataFrame:
    """``row, id, fp`` of rows ``row, id, text`` and ``first``: the row that stays of each component, smallest id first."""
    low = F.min(F.struct(F.col("id").isNull().alias("last"), "id", "row")).alias("low")
    rows = keep(fingerprints(slim, words))
    nodes = rows.groupBy("fp").agg(low)
    roots = components(links(nodes))
    placed = nodes.join(roots, nodes["fp"] == roots["node"], "left").select(
        "fp", "low", F.coalesce("root", "fp").alias("root")
    )
    names = placed.groupBy("root").agg(F.min("low").alias("first"))
    table = placed.join(names, "root").select("fp", "first")
    return rows.join(table, "fp").select("row", "id", "fp", "first")


def near_dedup(docs: DataFrame, id_column: str = "doc_id", text: str = "text", words: int = SHINGLE_WORDS) -> DataFrame:
    """One row of each component, with its columns."""
    rows = stored_rows(docs)
    groups = _groups(texts_of(rows, id_column, text), words)
    return without(rows, keep(groups.filter("row <> first.row").select("row")))
