"""Spelling variants by a dictionary of trie-node pairs.

The vocabulary is put into two tries, one of the words and one of the words read
backwards, and every node gets a number. A word of L code points is then known by
pairs of integers: the node of its first i code points and the node of its last
j. Skipping position i gives the pair (i, L - i - 1), splitting before position i
the pair (i, L - i). Words that share a skip pair differ in one replaced code point;
a skip pair that is another word's split pair is one deleted (or inserted) code
point. Where equal code points stand side by side, only the first of them is
skipped for deletions, so each such neighbour is met once. Pairs are exact: no
candidate needs another look at its text.

Tries are numbered in range shards: a shard walks its words in order, and what two
words have in common keeps its numbers. A shard takes over the numbers of the nodes
that its first word shares with the shard before; for that, two words of each
shard come to the driver. Members of a pair differ in one code point, so there
are as many as the alphabet has letters at most, however frequent a word is.

Null texts have no words, an empty table has none. Documents without an id count
like any other (their id reads as empty text), rows that repeat an id as well.
Further columns are ignored. Ties between forms go to the smallest word.
"""

from __future__ import annotations

import re
from collections import Counter
from collections.abc import Callable, Iterator
from itertools import groupby
from operator import itemgetter
from zlib import crc32

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cohortloom.llm.common import keep
from cohortloom.session import shuffle_width

#: Letters of a word after A-Z are in lower case.
LETTERS = "a-zÀ-ÿ"
MIN_CHARS = 6
MIN_COUNT = 5
#: A form is this many times as frequent as its variant at least.
FORM_RATIO = 5
#: Distinct words that a task counts before it hands them on.
HELD_WORDS = 200_000
SHARD_SHIFT = 40

_SPLIT, _SKIP, _SKIP_FIRST = 0, 1, 2
_PAIRS = "prefix bigint, suffix bigint, kind tinyint, word_id bigint, n bigint"
_LINKS = "word_id bigint, near bigint, form_n bigint, form_id bigint"


def _count_batches(min_chars: int, drop_every: int | None) -> Callable:
    runs = re.compile(f"[{LETTERS}]{{{min_chars},}}")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: Counter[str] = Counter()
        for batch in batches:
            for key, text in zip(batch.column(0).to_pylist(), batch.column(1), strict=True):
                plain = (text.as_py() or "").encode("utf-8", "surrogatepass").lower().decode("utf-8", "replace")
                found = Counter(runs.findall(plain))
                if drop_every:
                    found = _damaged(found, key or "", drop_every, min_chars)
                held.update(found)
                if len(held) > HELD_WORDS:
                    yield _word_batch(held)
                    held.clear()
        yield _word_batch(held)

    return run


def _damaged(found: Counter[str], key: str, drop_every: int, min_chars: int) -> Counter[str]:
    """Words of one document, some without one code point, as the checksum of document and word says."""
    begun, out = crc32(f"{key}:".encode()), Counter()
    for word, n in found.items():
        h = crc32(word.encode(), begun)
        if h % drop_every == 0:
            place = h % len(word)
            word = word[:place] + word[place + 1 :]
            if len(word) < min_chars:
                continue
        out[word] += n
    return out


def _word_batch(held: Counter[str]) -> pa.RecordBatch:
    columns = [pa.array(list(held), pa.string()), pa.array(list(held.values()), pa.int64())]
    return pa.RecordBatch.from_arrays(columns, ["word", "n"])


def word_counts(
    docs: DataFrame,
    id_column: str = "doc_id",
    text: str = "text",
    min_chars: int = MIN_CHARS,
    min_count: int = MIN_COUNT,
    drop_every: int | None = None,
) -> DataFrame:
    """``word, n`` of the words of at least ``min_chars`` code points with ``min_count`` occurrences or more.

    With ``drop_every``, a word loses a code point in those documents where the CRC-32
    of ``id:word`` is a multiple of it: planted misspellings.
    """
    slim = docs.select(F.col(id_column).cast("string").alias("id"), F.col(text).alias("text"))
    counted = slim.mapInArrow(_count_batches(min_chars, drop_every), "word string, n bigint")
    return counted.groupBy("word").agg(F.sum("n").alias("n")).filter(F.col("n") >= min_count)


def _common(a: str, b: str) -> int:
    n = min(len(a), len(b))
    if a[:n] == b[:n]:
        return n
    return next(i for i in range(n) if a[i] != b[i])


class _Walk:
    """Numbers of the trie nodes on the path of each word, for words in order."""

    def __init__(self, shard: int, carried: list[int]):
        self.base, self.made = shard << SHARD_SHIFT, 0
        self.before: str | None = None
        self.path = list(carried)

    def step(self, word: str) -> list[int]:
        common = len(self.path) if self.before is None else _common(self.before, word)
        fresh = range(self.base + self.made + 1, self.base + self.made + 1 + len(word) - common)
        self.made += len(fresh)
        self.path = [*self.path[:common], *fresh]
        self.before = word
        return self.path


def _ends(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The first and last word of a shard and the nodes of the last, without what an earlier shard gives."""
    walk, first, shard = None, None, 0
    for batch in batches:
        for shard, word in zip(batch["shard"].to_pylist(), batch["key"].to_pylist(), strict=True):
            if walk is None:
                walk, first = _Walk(shard, []), word
            walk.step(word)
    if walk is not None:
        row = {"shard": shard, "first": first, "last": walk.before, "path": walk.path}
        kinds = [("shard", pa.int32()), ("first", pa.string()), ("last", pa.string()), ("path", pa.list_(pa.int64()))]
        yield pa.RecordBatch.from_pylist([row], pa.schema(kinds))


def _carried(ends: list) -> dict[int, list[int]]:
    """For each shard the numbers of the nodes that its first word shares with earlier shards."""
    out: dict[int, list[int]] = {}
    last, path = "", []
    for row in sorted(ends, key=lambda r: r["shard"]):
        taken = path[: _common(last, row["first"])]
        # A shard's own numbering takes over nodes too, and so makes fewer: its last path moves down by as many.
        own = [p - len(taken) for p in row["path"]]
        shared = _common(row["first"], row["last"])
        kept = min(len(taken), shared)
        out[row["shard"]] = taken
        last, path = row["last"], [*taken[:kept], *own[kept:]]
    return out


def trie_paths(words: DataFrame, key: str, shards: int) -> DataFrame:
    """Add ``word_id`` (in the order of ``key``) and ``path``, the numbers of the trie nodes of ``key``'s prefixes.

    ``key`` holds distinct texts. Path entry i belongs to the first i + 1 code points; the root, which no path names, is 0.
    """
    ordered = words.withColumn("key", F.col(key)).repartitionByRange(shards, "key").sortWithinPartitions("key")
    ordered = keep(ordered).withColumn("shard", F.spark_partition_id())
    rows = ordered.select("shard", "key").mapInArrow(_ends, "shard int, first string, last string, path array<bigint>")
    carried = _carried(rows.collect())

    def number(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        walk, seen = None, 0
        for batch in batches:
            shards_, keys = batch["shard"].to_pylist(), batch["key"].to_pylist()
            if not keys:
                continue
            if walk is None:
                walk = _Walk(shards_[0], carried[shards_[0]])
            paths = [walk.step(k) for k in keys]
            ids = np.arange(seen, seen + len(keys), dtype=np.int64) + (shards_[0] << SHARD_SHIFT)
            seen += len(keys)
            kept = [batch[c] for c in batch.schema.names if c not in ("shard", "key")]
            names = [c for c in batch.schema.names if c not in ("shard", "key")]
            yield pa.RecordBatch.from_arrays(
                [*kept, pa.array(ids), pa.array(paths, pa.list_(pa.int64()))], [*names, "rank", "path"]
            )

    kept = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in words.schema.fields)
    return ordered.mapInArrow(number, f"{kept}, rank bigint, path array<bigint>")


def _pair_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Skip and split pairs of every word."""
    for batch in batches:
        found: list[list[np.ndarray]] = []
        made = 0
        columns = (batch[c].to_pylist() for c in ("word_id", "n", "word", "path", "back"))
        for word_id, n, word, path, back in zip(*columns, strict=True):
            size = len(word)
            front, rear = np.array([0, *path], np.int64), np.array([0, *back], np.int64)
            code = np.frombuffer(word.encode("utf-32-le"), np.uint32)
            first = np.concatenate(([True], code[1:] != code[:-1]))
            kinds = np.concatenate((np.full(size + 1, _SPLIT), np.where(first, _SKIP_FIRST, _SKIP))).astype(np.int8)
            whole = np.full(2 * size + 1, word_id), np.full(2 * size + 1, n)
            found.append([np.concatenate((front, front[:-1])), np.concatenate((rear[::-1], rear[-2::-1])), kinds, *whole])
            made += 2 * size + 1
            if made > HELD_WORDS:
                yield _pair_batch(found)
                found, made = [], 0
        if found:
            yield _pair_batch(found)


def _pair_batch(found: list[list[np.ndarray]]) -> pa.RecordBatch:
    columns = [pa.array(np.concatenate(parts)) for parts in zip(*found, strict=True)]
    return pa.RecordBatch.from_arrays(columns, ["prefix", "suffix", "kind", "word_id", "n"])


def _link_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Neighbours within each pair; rows come in the order of pairs, and one pair's rows may span batches."""
    held: list[np.ndarray] | None = None
    for batch in batches:
        columns = [c.to_numpy(zero_copy_only=False) for c in batch.columns]
        if held is not None:
            columns = [np.concatenate(c) for c in zip(held, columns, strict=True)]
        if not len(columns[0]):
            continue
        new = (columns[0][1:] != columns[0][:-1]) | (columns[1][1:] != columns[1][:-1])
        starts = np.concatenate(([0], np.nonzero(new)[0] + 1))
        held = [c[starts[-1] :] for c in columns]
        yield _linked(columns, starts)
    if held is not None:
        yield _linked(held, np.array([0, len(held[0])]))


def _linked(columns: list[np.ndarray], starts: np.ndarray) -> pa.RecordBatch:
    sizes = np.diff(starts)
    many = np.nonzero(sizes > 1)[0]
    place = np.repeat(starts[:-1][many], sizes[many])
    step = np.arange(len(place)) - np.repeat(np.cumsum(sizes[many]) - sizes[many], sizes[many])
    take = place + step
    rows = zip(place.tolist(), *(c[take].tolist() for c in columns[2:]), strict=True)
    found: list[tuple[int, int, int, int]] = []
    for _, members in groupby(rows, itemgetter(0)):
        # Most frequent first, then the smallest word.
        ranked = sorted(((-n, word, kind) for _, kind, word, n in members))
        skips = [m for m in ranked if m[2] != _SPLIT]
        for k, (_, word, _) in enumerate(skips if len(skips) > 1 else []):
            n, best, _ = skips[0 if k else 1]
            found.append((word, len(skips) - 1, -n, best))
        shorter = next((m for m in ranked if m[2] == _SPLIT), None)
        longer = [m for m in skips if m[2] == _SKIP_FIRST] if shorter else []
        if longer:
            found.append((shorter[1], len(longer), -longer[0][0], longer[0][1]))
            found += [(word, 1, -shorter[0], shorter[1]) for _, word, _ in longer]
    columns = zip(*found, strict=True) if found else [[]] * 4
    return pa.RecordBatch.from_arrays(
        [pa.array(c, pa.int64()) for c in columns], ["word_id", "near", "form_n", "form_id"]
    )


def neighbours(words: DataFrame) -> DataFrame:
    """``word_id, word, n, n_near, best_n, best_id``: each word of ``word, n`` with its near words counted and the best of them.

    Near are words that differ by one inserted, deleted or replaced code point; the best has the largest n,
    of equal ones the smallest word. ``word_id`` follows the order of words.
    """
    shards = shuffle_width(words.sparkSession)
    front = keep(trie_paths(words.select("word", "n"), "word", shards).withColumnRenamed("rank", "word_id"))
    turned = front.select("word_id", F.reverse("word").alias("turned"))
    back = trie_paths(turned, "turned", shards).select("word_id", F.col("path").alias("back"))
    both = front.join(back, "word_id").select("word_id", "n", "word", "path", "back")
    pairs = both.mapInArrow(_pair_batches, _PAIRS).repartition(shards, "prefix", "suffix")
    links = pairs.sortWithinPartitions("prefix", "suffix").mapInArrow(_link_batches, _LINKS)
    best = F.max(F.struct(F.col("form_n").alias("n"), (-F.col("form_id")).alias("id")))
    found = links.groupBy("word_id").agg(F.sum("near").alias("n_near"), best.alias("best"))
    return front.select("word_id", "word", "n").join(found, "word_id", "left").select(
        "word_id",
        "word",
        "n",
        F.coalesce("n_near", F.lit(0).cast("bigint")).alias("n_near"),
        F.col("best.n").alias("best_n"),
        (-F.col("best.id")).alias("best_id"),
    )


def roots(forms: DataFrame) -> DataFrame:
    """``word_id, root_id`` for links ``word_id, form_id``: where following the links ends.

    Links lead to more frequent words, so there is no cycle; every round doubles the steps that a link stands for.
    """
    now = keep(forms.select("word_id", F.col("form_id").alias("root_id")))
    while True:
        further = now.select(F.col("word_id").alias("root_id"), F.col("root_id").alias("next"))
        joined = keep(now.join(further, "root_id", "left").select("word_id", "root_id", "next"))
        now = joined.select("word_id", F.coalesce("next", "root_id").alias("root_id"))
        if joined.filter("next IS NOT NULL").isEmpty():
            return now


def spelling_groups(words: DataFrame, ratio: int = FORM_RATIO) -> DataFrame:
    """``word, form, root, n, n_near, form_n`` for the vocabulary ``word, n``.

    A word's form is its best near word if that is ``ratio`` times as frequent at least, else null;
    its root is where forms of forms end, itself if it has none.
    """
    near = neighbours(keep(words))
    has_form = F.col("best_n") >= ratio * F.col("n")
    near = keep(
        near.select(
            "word_id", "word", "n", "n_near",
            F.when(has_form, F.col("best_n")).alias("form_n"),
            F.when(has_form, F.col("best_id")).alias("form_id"),
        )
    )
    found = keep(roots(near.filter("form_id IS NOT NULL")))
    form = near.select(F.col("word_id").alias("form_id"), F.col("word").alias("form"))
    root = near.select(F.col("word_id").alias("root_id"), F.col("word").alias("root"))
    # A word without a form is in no link; only the others are joined to words.
    linked = near.filter("form_id IS NOT NULL").join(found, "word_id").join(form, "form_id").join(root, "root_id")
    columns = ["word", "form", "root", "n", "n_near", "form_n"]
    alone = near.filter("form_id IS NULL").select(
        "word", F.lit(None).cast("string").alias("form"), F.col("word").alias("root"), "n", "n_near", "form_n"
    )
    return linked.select(*columns).unionByName(alone)
