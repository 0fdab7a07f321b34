"""Prefix tries of conversations, built as ternary search trees in range shards.

Turns are encoded by a dictionary: each distinct (role, text) is one integer, in the
order of role and text. A conversation is then a short list of integers. Lists are
dealt into shards by range, so a shard is a run of the sorted lists; copies of one
conversation lie side by side and may fill several shards. A shard inserts its
distinct lists into a ternary search tree, medians first, which keeps the trees of
siblings balanced. One pass back over the nodes, children before parents, adds up
members, leaves and savings without recursion.

Where two neighbouring shards share a prefix, both have its nodes. Their number
is bounded by shards times the length of what neighbours share. These nodes are summed
up over shards, then along their own small tree on the driver; all other nodes are final in
their shard. The ids that end at a shared node go to its digest in order, a chunk
at a time, so no list of members is ever held whole.

Turns are ordered by their number (null first), those of equal number by role
and text. Null roles and texts are empty. Rows without a conversation id are in no
conversation. Repeated rows are turns of their own. A conversation without turns
ends at the root. An empty table has no node. Further columns are ignored. One conversation
is one list in one task; it holds two integers for each turn, no text.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from itertools import pairwise

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.llm.common import keep, text_of
from cohortloom.session import shuffle_width

#: Turns of a shard, about.
SHARD_TURNS = 200_000
#: Ids of a chunk of a shared node's members.
CHUNK_IDS = 1_000

_FINAL, _SHARED, _ENDS = 0, 1, 2
_ROWS = (
    "kind tinyint, owner int, depth bigint, parent_owner int, conv_id bigint, parent_conv_id bigint, n_convs bigint, "
    "n_children bigint, n_leaves bigint, saved_tokens bigint, chars bigint, part bigint, ends string"
)
_NAMES = [c.split()[0] for c in _ROWS.split(", ")]
_KINDS = {"tinyint": pa.int8(), "int": pa.int32(), "bigint": pa.int64(), "string": pa.string()}
_SCHEMA = pa.schema([(c.split()[0], _KINDS[c.split()[1]]) for c in _ROWS.split(", ")])
_NO_ENDS = hashlib.sha256(b"").hexdigest()
NODE_COLUMNS = [
    "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256"
]


def encoded_turns(
    rows: DataFrame, conv: str = "conv_id", turn: str = "turn", role: str = "role", text: str = "text"
) -> DataFrame:
    """``conv_id, turns``: each conversation's turns in order, as structs of ``turn``, ``id`` and ``chars``."""
    said = rows.filter(F.col(conv).isNotNull()).select(
        F.col(conv).cast("bigint").alias("conv_id"),
        F.col(turn).alias("turn"),
        text_of(role).alias("role"),
        text_of(text).alias("text"),
    )
    # The role's length keeps apart what role and text share between them.
    digest = F.unhex(F.sha2(F.concat(F.length("role").cast("string"), F.lit(":"), "role", "text"), 256)).alias("digest")
    width = shuffle_width(rows.sparkSession)
    distinct = said.select("role", "text").distinct().repartitionByRange(width, "role", "text")
    dictionary = keep(
        distinct.sortWithinPartitions("role", "text").select(
            digest, F.monotonically_increasing_id().alias("id"), F.length("text").cast("bigint").alias("chars")
        )
    )
    # Stored right after the join, so that a turn that many conversations share can be split between tasks.
    coded = keep(said.select("conv_id", "turn", digest).join(dictionary, "digest").drop("digest"))
    listed = F.sort_array(F.collect_list(F.struct("turn", "id", "chars")))
    return coded.groupBy("conv_id").agg(listed.alias("turns"))


def with_shared_heads(turns: DataFrame, every: int, most: int, head_size: Column) -> DataFrame:
    """Conversations whose first ``head_size`` turns are those of the next lower conversation divisible by ``every``.

    ``head_size`` is below ``most``. A head has as many turns as that conversation can give, none if it is absent.
    """
    base = F.col("conv_id") - F.col("conv_id") % every
    heads = turns.filter(F.col("conv_id") % every == 0)
    heads = heads.select(F.col("conv_id").alias("base"), F.slice("turns", 1, most - 1).alias("head"))
    sized = turns.select("conv_id", "turns", base.alias("base"), head_size.cast("int").alias("size"))
    head = F.coalesce(F.slice("head", F.lit(1), F.col("size")), F.slice("turns", 1, 0))
    own = F.slice("turns", F.col("size") + 1, F.greatest(F.size("turns"), F.lit(1)))
    return sized.join(heads, "base", "left").select("conv_id", F.concat(head, own).alias("turns"))


def _common_prefix(a: str, b: str) -> Column:
    """Length of what two arrays have in common at their start."""
    differs = f"array_position(zip_with({a}, {b}, (x, y) -> x <=> y), false)"
    return F.expr(f"CASE WHEN {differs} = 0 THEN size({a}) ELSE {differs} - 1 END").cast("int")


class _Border:
    """What a shard shares with its neighbours.

    ``owners[d]`` is the first shard that has the node at depth d of this shard's first list, for the depths
    shared with the shard before; ``ahead`` is the greatest depth shared with the next, -1 without one.
    """

    def __init__(self, shard: int, owners: list[int], within: int, ahead: int):
        self.shard, self.owners, self.within, self.ahead = shard, owners, within, ahead

    def owner_on_last(self, depth: int) -> int:
        """The first shard that has the node at this depth of the shard's last list."""
        return self.owners[depth] if depth <= self.within and depth < len(self.owners) else self.shard


def _borders(shards: DataFrame) -> dict[int, _Border]:
    """Borders of shards from ``shard, first, last``, compared in Spark; three integers of each come back."""
    before = F.lag("last").over(Window.orderBy("shard"))
    rows = shards.withColumn("before", before).select(
        "shard", _common_prefix("first", "last").alias("within"), _common_prefix("before", "first").alias("shared")
    )
    ordered = sorted(rows.collect(), key=lambda r: r["shard"])
    found = [_Border(r["shard"], [], r["within"], -1) for r in ordered]
    for (one, two), row in zip(pairwise(found), ordered[1:], strict=True):
        one.ahead = row["shared"]
        two.owners = [one.owner_on_last(d) for d in range(row["shared"] + 1)]
    return {b.shard: b for b in found}


class TernaryTree:
    """Ternary search tree over lists of integers; node 0 is the root, ``parent`` the node of the list without its last."""

    def __init__(self):
        self.key, self.low, self.equal, self.high = [0], [-1], [-1], [-1]
        self.parent, self.depth, self.chars = [-1], [0], [0]

    def _new(self, key: int, parent: int, chars: int) -> int:
        for column, value in (
            (self.key, key), (self.low, -1), (self.equal, -1), (self.high, -1),
            (self.parent, parent), (self.depth, self.depth[parent] + 1), (self.chars, chars),
        ):
            column.append(value)
        return len(self.key) - 1

    def insert(self, items: list[int], chars: list[int]) -> int:
        """The node of a list, made where it is new."""
        key, low, high, at = self.key, self.low, self.high, 0
        for item, size in zip(items, chars, strict=True):
            above, links, place = at, self.equal, at
            while (at := links[place]) >= 0 and key[at] != item:
                links, place = (low if item < key[at] else high), at
            if at < 0:
                links[place] = at = self._new(item, above, size)
        return at

    def path(self, node: int) -> list[int]:
        """Nodes from the root to ``node``."""
        out = []
        while node >= 0:
            out.append(node)
            node = self.parent[node]
        return out[::-1]


def median_order(n: int) -> Iterator[int]:
    """0 to n - 1, the middle of each range before its halves."""
    ranges = [(0, n)]
    for first, last in ranges:
        if first < last:
            middle = (first + last) // 2
            yield middle
            ranges += [(first, middle), (middle + 1, last)]


def shard_nodes(lists: list[list[int]], chars: list[list[int]], members: list[np.ndarray], border: _Border) -> Iterator[dict]:
    """Rows of a shard's nodes for its distinct lists in order; ``members`` are the sorted ids that have each list."""
    tree = TernaryTree()
    node_of = [0] * len(lists)
    for i in median_order(len(lists)):
        node_of[i] = tree.insert(lists[i], chars[i])
    size = len(tree.key)
    owner: list[int | None] = [None] * size
    for d, node in enumerate(tree.path(node_of[-1])[: border.ahead + 1]):
        owner[node] = border.owner_on_last(d)
    for d, node in enumerate(tree.path(node_of[0])[: len(border.owners)]):
        owner[node] = border.owners[d]
    n_convs, smallest, ends = [0] * size, [None] * size, [None] * size
    children, leaves, saved = [0] * size, [0] * size, [0] * size
    for node, ids in zip(node_of, members, strict=True):
        n_convs[node], smallest[node], ends[node] = len(ids), int(ids[0]), ids
    for node in range(size - 1, 0, -1):  # a child is made after its parent, so it is met before
        above = tree.parent[node]
        n_convs[above] += n_convs[node]
        smallest[above] = smallest[node] if smallest[above] is None else min(smallest[above], smallest[node])
        if owner[node] is None:
            leaves[node] = leaves[node] or 1
            saved[node] += (n_convs[node] - 1) * tree.chars[node]
            children[above] += 1
            leaves[above] += leaves[node]
            saved[above] += saved[node]
    for node in range(size):
        above = tree.parent[node]
        row = {
            "kind": _FINAL if owner[node] is None else _SHARED,
            "owner": owner[node],
            "depth": tree.depth[node],
            "parent_owner": owner[above] if above >= 0 else None,
            "conv_id": smallest[node],
            "parent_conv_id": smallest[above] if above >= 0 and owner[above] is None else None,
            "n_convs": n_convs[node],
            "n_children": children[node],
            "n_leaves": leaves[node],
            "saved_tokens": saved[node],
            "chars": tree.chars[node],
        }
        if owner[node] is None:
            row["n_leaves"] = leaves[node] or 1
            ids = ends[node]
            row["ends"] = _NO_ENDS if ids is None else hashlib.sha256(_joined(ids)).hexdigest()
        yield row
        if owner[node] is not None and ends[node] is not None:
            for k in range(0, len(ends[node]), CHUNK_IDS):
                chunk = _joined(ends[node][k : k + CHUNK_IDS]).decode()
                part = (border.shard << 32) + k
                yield {"kind": _ENDS, "owner": owner[node], "depth": tree.depth[node], "part": part, "ends": chunk}


def _joined(ids: np.ndarray) -> bytes:
    return ",".join(map(str, ids.tolist())).encode()


def _shard_batches(borders: dict[int, _Border]):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        lists, chars, members, shard = [], [], [], None
        for batch in batches:
            columns = (batch[c].to_pylist() for c in ("shard", "items", "chars", "conv_id"))
            for shard, items, sizes, conv in zip(*columns, strict=True):
                if not lists or lists[-1] != items:
                    lists.append(items)
                    chars.append(sizes)
                    members.append([])
                members[-1].append(conv)
        if shard is None:
            return
        held = []
        for row in shard_nodes(lists, chars, [np.array(m, np.int64) for m in members], borders[shard]):
            held.append(row)
            if len(held) >= 10_000:
                yield pa.RecordBatch.from_pylist(held, _SCHEMA)
                held = []
        yield pa.RecordBatch.from_pylist(held, _SCHEMA)

    return run


def _digest_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The digest of each shared node's ids; chunks come in order."""
    names = ["owner", "depth", "ends_sha256"]
    kinds = pa.schema([("owner", pa.int32()), ("depth", pa.int64()), ("ends_sha256", pa.string())])
    now, digest = None, None
    for batch in batches:
        done = []
        columns = (batch[c].to_pylist() for c in ("owner", "depth", "ends"))
        for owner, depth, chunk in zip(*columns, strict=True):
            if (owner, depth) != now:
                done += [(*now, digest.hexdigest())] if now else []
                now, digest = (owner, depth), hashlib.sha256()
            else:
                digest.update(b",")
            digest.update(chunk.encode())
        yield pa.RecordBatch.from_pylist([dict(zip(names, row, strict=True)) for row in done], kinds)
    if now:
        yield pa.RecordBatch.from_pylist([dict(zip(names, (*now, digest.hexdigest()), strict=True))], kinds)


def _merged(rows: list) -> list[tuple]:
    """Shared nodes, summed over shards already, summed up along their own tree."""
    nodes = {(r["owner"], r["depth"]): r.asDict() for r in rows}
    for r in sorted(nodes.values(), key=lambda r: -r["depth"]):
        above = nodes.get((r["parent_owner"], r["depth"] - 1))
        r["n_leaves"] = r["n_leaves"] or 1
        r["saved_tokens"] += (r["n_convs"] - 1) * r["chars"]
        r["parent_conv_id"] = above["conv_id"] if above else None
        if above:
            above["n_children"] += 1
            above["n_leaves"] += r["n_leaves"]
            above["saved_tokens"] += r["saved_tokens"]
    return [tuple(r[c] for c in ("owner", *NODE_COLUMNS[:-1])) for r in nodes.values()]


def prefix_trie(conversations: DataFrame) -> DataFrame:
    """One row per trie node of ``conv_id, turns`` (as from ``encoded_turns``), under the names of ``NODE_COLUMNS``.

    ``conv_id`` is the smallest member, ``saved_tokens`` the characters that members other than the first repeat, in the
    whole subtree, and ``ends_sha256`` the digest of the ids, in order, of the conversations that end at the node.
    """
    spark = conversations.sparkSession
    items, chars = F.transform("turns", lambda t: t["id"]), F.transform("turns", lambda t: t["chars"])
    lists = keep(conversations.select("conv_id", items.alias("items"), chars.alias("chars")))
    total = lists.agg(F.sum(F.size("items") + 1)).first()[0] or 0
    shards = max(shuffle_width(spark), -(-total // SHARD_TURNS))
    ordered = lists.repartitionByRange(shards, "items", "conv_id").sortWithinPartitions("items", "conv_id")
    ordered = keep(ordered).withColumn("shard", F.spark_partition_id())
    ends = ordered.groupBy("shard").agg(F.min("items").alias("first"), F.max("items").alias("last"))
    borders = _borders(ends)
    nodes = keep(ordered.mapInArrow(_shard_batches(borders), _ROWS))

    shared = nodes.filter(F.col("kind") == _SHARED).groupBy("owner", "depth").agg(
        F.min("parent_owner").alias("parent_owner"),
        F.min("conv_id").alias("conv_id"),
        F.max("chars").alias("chars"),
        *(F.sum(c).alias(c) for c in ("n_convs", "n_children", "n_leaves", "saved_tokens")),
    )
    schema = "owner int, " + ", ".join(f"{c} bigint" for c in NODE_COLUMNS[:-1])
    merged = spark.createDataFrame(_merged(shared.collect()), schema)
    chunks = nodes.filter(F.col("kind") == _ENDS).repartition(shuffle_width(spark), "owner", "depth")
    digests = chunks.sortWithinPartitions("owner", "depth", "part").mapInArrow(
        _digest_batches, "owner int, depth bigint, ends_sha256 string"
    )
    borderline = merged.join(digests, ["owner", "depth"], "left").withColumn(
        "ends_sha256", F.coalesce("ends_sha256", F.lit(_NO_ENDS))
    )
    final = nodes.filter(F.col("kind") == _FINAL).withColumnRenamed("ends", "ends_sha256")
    inner = final.filter("parent_owner IS NULL")
    above = merged.select(
        F.col("owner").alias("parent_owner"), (F.col("depth") + 1).alias("depth"), F.col("conv_id").alias("above")
    )
    outer = final.filter("parent_owner IS NOT NULL").drop("parent_conv_id").join(above, ["parent_owner", "depth"])
    outer = outer.withColumnRenamed("above", "parent_conv_id")
    return inner.select(*NODE_COLUMNS).unionByName(outer.select(*NODE_COLUMNS)).unionByName(borderline.select(*NODE_COLUMNS))
