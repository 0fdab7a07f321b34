"""Best-fit packing of tokenised documents into sequences of a fixed length.

Documents become token ids of a byte-level BPE vocabulary and an end id. Those
longer than a sequence are cut into whole sequences, with the remainder first,
so each document leaves one shorter piece at most. Whole pieces are sequences as
they are. The others are packed best fit decreasing: longest first, each into
the open bin with the least room that still fits, which a segment tree over the
remaining capacities finds in logarithmic time.

One packer for the whole corpus would be one task, so pieces are dealt by row,
not by document or length, into groups of about ``GROUP_PIECES``. A group has
pieces of all lengths and wastes part of its last bins only, a few in
tens of thousands.

Ids come from the vocabulary's rank file and the added tokens of the JSON file,
so they are those of the JSON file for all texts: the string of an added token
inside a text is that token, as the JSON file's tokenizer reads it. Null
and empty texts are one piece with the end id. Long texts are encoded a part at
a time, cut where the vocabulary's pattern always cuts. Rows with repeated or
missing ids are documents of their own; an empty table gives no rows; further
columns are ignored.
"""

from __future__ import annotations

import base64
import json
import re
import zlib
from collections.abc import Iterator, Mapping

import numpy as np
import pandas as pd
import public_tokenizers
import pyarrow as pa
import tiktoken
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import keep, numbered

CAPACITY = 1024
END_ID = 2
RANKS = "byte_bpe_50k.tiktoken"
VOCABULARY = "byte_bpe_50k.json"
GROUP_PIECES = 32_768
PART_CHARS = 1 << 19
#: A space between a visible character and a letter always starts a new token; added tokens have no spaces.
_CUT = re.compile(r"(?<=\S) (?=[^\W\d_])")

_PIECES = "row bigint, id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint"
_PLACED = "id {kind}, piece int, start bigint, length bigint, ids_crc32 bigint, sequence_id bigint, offset bigint"


def added_tokens(path: str) -> dict[str, int]:
    """Strings and ids of the added tokens of a JSON vocabulary."""
    with open(path, encoding="utf-8") as file:
        found = json.load(file)["added_tokens"]
    for token in found:
        plain = not any(token[k] for k in ("single_word", "lstrip", "rstrip", "normalized"))
        if not plain or _CUT.search(f"x{token['content']}x"):
            raise ValueError(f"the added token {token['content']!r} is not a plain string without spaces")
    return {token["content"]: token["id"] for token in found}


def load_encoding(path: str, added: Mapping[str, int] | None = None) -> tiktoken.Encoding:
    """The encoding of a rank file; without ``added`` tokens all of a text is ordinary."""
    with open(path, "rb") as lines:
        ranks = {base64.b64decode(token): int(rank) for token, rank in map(bytes.split, lines)}
    special = dict(added or {})
    return tiktoken.Encoding(
        "byte_bpe", pat_str=public_tokenizers.PATTERN, mergeable_ranks=ranks, special_tokens=special
    )


def token_ids(encoding: tiktoken.Encoding, text: str) -> np.ndarray:
    """Ids of the whole text and the end id."""
    found, at = [], 0
    while at < len(text):
        cut = _CUT.search(text, at + PART_CHARS)
        end = cut.start() if cut else len(text)
        found.append(np.array(encoding.encode(text[at:end], allowed_special="all"), np.uint32))
        at = end
    return np.concatenate([*found, np.array([END_ID], np.uint32)])


def cuts(n: int, capacity: int) -> list[tuple[int, int]]:
    """Start and length of each piece of ``n`` tokens; only the first may be shorter than the rest."""
    first = n % capacity or min(n, capacity)
    return [(0, first), *((a, capacity) for a in range(first, n, capacity))]


def _piece_batches(path: str, added: Mapping[str, int], capacity: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encoding = load_encoding(path, added)
        for batch in batches:
            rows, found = [], []
            for r, value in enumerate(batch.column(2)):
                ids = token_ids(encoding, value.as_py() or "").astype("<u4")
                for k, (start, length) in enumerate(cuts(len(ids), capacity)):
                    rows.append(r)
                    found.append((k, start, length, zlib.crc32(ids[start : start + length].tobytes())))
            take = pa.array(rows, pa.int64())
            kinds = (pa.int32(), pa.int64(), pa.int64(), pa.int64())
            columns = [pa.array([f[i] for f in found], kind) for i, kind in enumerate(kinds)]
            yield pa.RecordBatch.from_arrays(
                [batch.column(0).take(take), batch.column(1).take(take), *columns],
                ["row", "id", "piece", "start", "length", "ids_crc32"],
            )

    return run


class OpenBins:
    """Open bins by remaining capacity, with a segment tree over the capacities that have any."""

    def __init__(self, capacity: int) -> None:
        self.size = 1 << capacity.bit_length()
        self.tree = [0] * (2 * self.size)
        self.bins: list[list[int]] = [[] for _ in range(capacity + 1)]

    def _count(self, room: int, change: int) -> None:
        at = room + self.size
        while at:
            self.tree[at] += change
            at >>= 1

    def put(self, room: int, bin_: int) -> None:
        self.bins[room].append(bin_)
        self._count(room, 1)

    def tightest(self, need: int) -> tuple[int, int] | None:
        """Take out the bin with the least room of at least ``need``."""
        at = need + self.size
        if not self.tree[at]:
            # Up until a sibling to the right has a bin, then down its left edge.
            while at > 1 and (at & 1 or not self.tree[at + 1]):
                at >>= 1
            if at <= 1:
                return None
            at += 1
            while at < self.size:
                at = 2 * at if self.tree[2 * at] else 2 * at + 1
        room = at - self.size
        bin_ = self.bins[room].pop()
        self._count(room, -1)
        return room, bin_


def best_fit(lengths: np.ndarray, capacity: int = CAPACITY) -> tuple[np.ndarray, np.ndarray]:
    """Bin and offset of each length, packed best fit decreasing."""
    bins, offsets = np.zeros(len(lengths), np.int64), np.zeros(len(lengths), np.int64)
    open_, made = OpenBins(capacity), 0
    for i in np.argsort(-lengths, kind="stable").tolist():
        need = int(lengths[i])
        found = open_.tightest(need)
        if found is None:
            found, made = (capacity, made), made + 1
        room, bin_ = found
        bins[i], offsets[i] = bin_, capacity - room
        if room > need:
            open_.put(room - need, bin_)
    return bins, offsets


def pack(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    path: str | None = None,
    capacity: int = CAPACITY,
    added: Mapping[str, int] | None = None,
) -> DataFrame:
    """One row per piece: its document, place in it, CRC of its ids, and its sequence and place there.

    A rank file of the caller's own comes with its ``added`` tokens, if it has any.
    """
    if path is None and added is None:
        added = added_tokens(public_tokenizers.path(VOCABULARY))
    path = path or public_tokenizers.path(RANKS)
    slim = numbered(docs, id_column, text)
    kind = slim.schema["id"].dataType.simpleString()
    pieces = keep(slim.mapInArrow(_piece_batches(path, added or {}, capacity), _PIECES.format(kind=kind)))
    short = F.col("length") < capacity
    groups = max(1, -(-pieces.filter(short).count() // GROUP_PIECES))

    def packed(part: pd.DataFrame) -> pd.DataFrame:
        part = part.sort_values(["row", "piece"], kind="stable")
        bins, offsets = best_fit(part["length"].to_numpy(), capacity)
        return part.assign(sequence_id=(part["group"].to_numpy().astype(np.int64) << 32) + bins, offset=offsets)[
            ["id", "piece", "start", "length", "ids_crc32", "sequence_id", "offset"]
        ]

    dealt = pieces.filter(short).withColumn("group", F.pmod(F.xxhash64("row", "piece"), F.lit(groups)).cast("int"))
    partly = dealt.groupBy("group").applyInPandas(packed, _PLACED.format(kind=kind))
    whole = pieces.filter(~short).select(
        "id", "piece", "start", "length", "ids_crc32",
        (-1 - F.monotonically_increasing_id()).alias("sequence_id"),
        F.lit(0).cast("bigint").alias("offset"),
    )
    return partly.unionByName(whole).withColumnRenamed("id", id_column)
