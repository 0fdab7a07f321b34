"""Substring deduplication with suffixes sorted deep-shallow.

A byte is removed if it lies in a string of ``SPAN`` (50) bytes that also starts
in a document with a smaller id. Sorting every suffix of a large corpus would
move 50 bytes for each of its bytes, so the suffixes that can match are found first.

1. Of the 27 hashes of 24 bytes inside a string of 50, the smallest (the last, if
   tied) is its anchor. Equal strings have equal anchors at the same place, and
   each string belongs to one anchor: neighbouring strings that share theirs are a
   context of 50 to 76 bytes.
2. Anchors that occur once are dropped by a filter of fixed size.
3. Contexts are grouped by anchor and hash. In a group of equal contexts all but
   those of the smallest id are covered as a whole. Tasks settle their own rows
   first, so of a hot passage each passes on the rows of one document.
4. Anchors with different contexts of different documents are contested. Their
   contexts are fetched, and all their suffixes are sorted: multikey quicksort to
   ``SHALLOW`` bytes, then blind tries for the groups that are still equal, to 50
   bytes. Suffixes equal to that depth with a greater id than the group's least
   are hits. An anchor with very many contexts is split into its strings, each a
   group of its own.
5. The spans of each document are merged, and the kept bytes follow from its text.

Documents are pairs of id and content hash; ids are integers. Rows without an id
rank behind all others and not before each other; rows that repeat an id never
remove each other's bytes. Null texts are empty, texts under 50 bytes lose nothing, an
empty table gives no rows, further columns are ignored. Long texts are taken a
segment at a time; a context cut at its edge is one more context.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
import zstandard
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm.common import keep, mixed, slices
from cohortloom.llm.words import _Powers
from cohortloom.session import shuffle_width

SPAN = 50
GRAM = 24
WIDTH = SPAN - GRAM + 1
SHALLOW = 16
STEP = 4
#: Bytes taken at a time; below 2^20, which the place of an anchor in its segment is held in.
SEGMENT = 1 << 16
#: Bits of the filters that tasks get, at most 16 MB each, whatever the corpus; fewer for few hashes.
SHARED_BITS = 1 << 27
LEAST_BITS = 1 << 20
BITS_PER_HASH = 64
#: Rows a task gathers before it settles them, and contexts of an anchor from which it is split.
GATHER = 1 << 21
HOT_CONTEXTS = 2_000
_LAST = np.iinfo(np.int64).max
_LOWER = np.uint64((1 << 20) - 1)
_UPPER = ~_LOWER
_SPREAD = np.uint64(0x9E3779B97F4A7C15)
_PLACES = _LOWER - np.arange(SEGMENT + SPAN, dtype=np.uint64)


def anchors(data: np.ndarray, at: np.ndarray) -> Iterator[tuple[np.ndarray, ...]]:
    """Anchors of the rows ``data[at[i]:at[i + 1]]``, a segment at a time.

    Yields row, hash, first string, last string (byte offsets in ``data``) and the
    hash of the context from the first byte of the one to the last of the other.
    """
    ends = np.repeat(at[1:], np.diff(at))
    for begin in range(0, max(0, len(data) - SPAN + 1), SEGMENT):
        part = data[begin : begin + SEGMENT + SPAN - 1]
        n = len(part) - SPAN + 1
        up, down = _Powers.upto(len(part))
        sums = np.zeros(len(part) + 1, np.uint64)
        np.cumsum(part * up[: len(part)], out=sums[1:])
        grams = (sums[GRAM:] - sums[:-GRAM]) * down[: len(part) - GRAM + 1]
        # The upper bits of a product decide, then the place, the last one first.
        low = grams * _SPREAD
        low &= _UPPER
        low |= _PLACES[: len(grams)]
        wide = 1
        while wide < WIDTH:
            step = min(wide, WIDTH - wide)
            low = np.minimum(low[step:], low[:-step])
            wide += step
        place = _LOWER - (low & _LOWER)
        place[np.arange(begin + SPAN, begin + SPAN + n) > ends[begin : begin + n]] = _LOWER
        edge = np.nonzero(place[1:] != place[:-1])[0] + 1
        edge = np.concatenate((np.zeros(1, np.int64), edge))
        last = np.concatenate((edge[1:], [n])) - 1
        real = place[edge] != _LOWER
        first, last = edge[real], last[real]
        p = place[first].astype(np.int64)
        context = (sums[last + SPAN] - sums[first]) * down[first]
        context = mixed(context ^ ((p - first).astype(np.uint64) << np.uint64(56)) ^ ((last - first).astype(np.uint64) << np.uint64(48)))
        row = np.searchsorted(at, first + begin, "right") - 1
        yield row, mixed(grams[p]), first + begin, last + begin, context


def _marked(bits: np.ndarray, hashes: np.ndarray) -> np.ndarray:
    place = hashes & np.uint64(8 * len(bits) - 1)
    return (bits[(place >> np.uint64(3)).astype(np.int64)] >> (place & np.uint64(7)).astype(np.uint8)) & 1 > 0


def _ranks(ids: pa.Array) -> np.ndarray:
    return ids.cast(pa.int64()).fill_null(_LAST).to_numpy(zero_copy_only=False)


def _content(data: np.ndarray) -> int:
    return xxhash.xxh3_64_intdigest(data) - (1 << 63)


def _buckets(spark: SparkSession) -> int:
    """A power of two of at least four buckets per shuffle partition, each at least a byte of a filter."""
    return min(1 << (4 * shuffle_width(spark) - 1).bit_length(), SHARED_BITS >> 3)


#: Bytes of a hash that are compared to find those that occur twice; the filter may pass more than those.
_KEPT = 6


def _gathered_hashes(buckets: int):
    """Map texts to blobs of anchor hashes by bucket; a hash seen again in the task is there twice."""
    shift = np.uint64((SHARED_BITS // buckets).bit_length() - 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for batch in batches:
            for _, _, data, at in slices(batch.column(1)):
                for _, hashes, *_ in anchors(data, at):
                    held.append(hashes)
                    n += len(hashes)
                if n > 2 * GATHER:
                    yield blobs(held)
                    held, n = [], 0
        if held:
            yield blobs(held)

    def blobs(held: list[np.ndarray]) -> pa.RecordBatch:
        values, counts = np.unique(np.concatenate(held), return_counts=True)
        values = np.repeat(values, np.minimum(counts, 2))
        bucket = ((values & np.uint64(SHARED_BITS - 1)) >> shift).astype(np.int64)
        order = np.argsort(bucket, kind="stable")
        values, bucket = values[order], bucket[order]
        edge = np.nonzero(np.concatenate(([True], bucket[1:] != bucket[:-1])))[0]
        octets = values.view(np.uint8).reshape(-1, 8)[:, :_KEPT]
        parts = [octets[a:b].tobytes() for a, b in zip(edge, [*edge[1:], len(values)], strict=True)]
        return pa.RecordBatch.from_arrays([pa.array(bucket[edge], pa.int32()), pa.array(parts, pa.binary())], ["bucket", "blob"])

    return run


def _shared_bits(buckets: int):
    """Part of the filter for one bucket: hashes that are there twice."""
    width = SHARED_BITS // buckets

    def run(key: tuple, table: pa.Table) -> pa.Table:
        octets = np.concatenate([np.frombuffer(b.as_buffer(), np.uint8).reshape(-1, _KEPT) for b in table["blob"]])
        values = np.zeros((len(octets), 8), np.uint8)
        values[:, :_KEPT] = octets
        values = np.sort(values.view(np.uint64)[:, 0])
        again = np.unique(values[1:][values[1:] == values[:-1]])
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([_packed(again, width)], pa.binary())})

    return run


def _packed(hashes: np.ndarray, width: int) -> bytes:
    flags = np.zeros(width, np.uint8)
    flags[(hashes & np.uint64(width - 1)).astype(np.int64)] = 1
    return np.packbits(flags, bitorder="little").tobytes()


def _collected(parts: DataFrame, buckets: int, bits: int) -> np.ndarray:
    """A filter from its parts; ``bits / 8`` bytes come to the driver."""
    found = np.zeros((buckets, bits // buckets // 8), np.uint8)
    for row in parts.collect():
        found[row["bucket"]] = np.frombuffer(bytes(row["bits"]), np.uint8)
    return found.reshape(-1)


def _filter_of(hashes: DataFrame) -> np.ndarray:
    """A filter of the hashes in a stored table, sized by their number up to a fixed bound."""
    n = hashes.count()
    bits = min(SHARED_BITS, max(LEAST_BITS, 1 << (BITS_PER_HASH * n).bit_length()))
    buckets = bits >> 17
    width = bits // buckets
    place = F.col("hash").bitwiseAND(F.lit(bits - 1))

    def run(key: tuple, table: pa.Table) -> pa.Table:
        values = table["hash"].to_numpy().view(np.uint64)
        return pa.table({"bucket": pa.array([key[0].as_py()], pa.int32()), "bits": pa.array([_packed(values, width)], pa.binary())})

    rows = hashes.select("hash", F.floor(place / width).cast("int").alias("bucket")).distinct()
    return _collected(rows.groupBy("bucket").applyInArrow(run, "bucket int, bits binary"), buckets, bits)


def _first_of_class(rank: np.ndarray, *keys: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Sort rows by the keys and rank; the order, and for each place in it whether its rank is its class's least."""
    order = np.lexsort((rank, *keys[::-1]))
    new = np.zeros(len(order), bool)
    new[:1] = True
    for key in keys:
        new[1:] |= key[order][1:] != key[order][:-1]
    first = np.maximum.accumulate(np.where(new, np.arange(len(order)), 0))
    ordered = rank[order]
    return order, ordered == ordered[first]


_FIELDS = ("hash", "context", "rank", "doc", "start", "stop")
_ROWS = ", ".join(f"{name} bigint" for name in _FIELDS)


def _settled(table: dict[str, np.ndarray]) -> pa.RecordBatch:
    """Rows that are not their context's first become spans (no context, dealt by place); the rest stay anchors."""
    order, first = _first_of_class(table["rank"], table["hash"], table["context"])
    table = {k: v[order] for k, v in table.items()}
    spans = _merged(table["rank"][~first], table["doc"][~first], table["start"][~first], table["stop"][~first] + SPAN)
    deal = mixed(spans[1].view(np.uint64) ^ spans[2].view(np.uint64)).view(np.int64)
    done = dict(zip(("hash", "rank", "doc", "start", "stop"), (deal, *spans), strict=True))
    arrays = []
    for name in _FIELDS:
        open_ = table[name][first]
        open_ = pa.array(open_.view(np.int64) if open_.dtype == np.uint64 else open_.astype(np.int64))
        arrays.append(pa.concat_arrays([open_, pa.array(done[name]) if name in done else pa.nulls(len(deal), pa.int64())]))
    return pa.RecordBatch.from_arrays(arrays, list(_FIELDS))


def _merged(rank: np.ndarray, doc: np.ndarray, start: np.ndarray, stop: np.ndarray) -> tuple[np.ndarray, ...]:
    """Spans of a document that touch, as one."""
    order = np.lexsort((start, doc, rank))
    rank, doc, start, stop = (x[order].astype(np.int64) for x in (rank, doc, start, stop))
    if not len(order):
        return rank, doc, start, stop
    change = (rank[1:] != rank[:-1]) | (doc[1:] != doc[:-1])
    group = np.concatenate(([0], np.cumsum(change)))
    # Offsets are shifted by group, so that one running maximum serves all documents.
    far = int(stop.max()) + 1
    reach = np.maximum.accumulate(stop + group * far)
    new = np.concatenate(([True], (start + group * far)[1:] > reach[:-1]))
    edge = np.nonzero(new)[0]
    last = np.concatenate((edge[1:], [len(order)])) - 1
    return rank[edge], doc[edge], start[edge], reach[last] - group[last] * far


def _texts(batches: Iterator[pa.RecordBatch]) -> Iterator[tuple[np.ndarray, np.ndarray, np.ndarray, np.ndarray]]:
    """Ranks, content hashes, bytes and offsets of runs of rows (id, text)."""
    for batch in batches:
        rank = _ranks(batch.column(0))
        for first, last, data, at in slices(batch.column(1)):
            doc = np.array([_content(data[a:b]) for a, b in zip(at[:-1], at[1:], strict=True)], np.int64)
            yield rank[first:last], doc, data, at


def _shared_anchors(bits):
    """Map texts to the anchors that the filter passes, settled inside the task."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for rank, doc, data, at in _texts(batches):
            for row, hashes, first, last, context in anchors(data, at):
                k = _marked(bits.value, hashes)
                row = row[k]
                held.append((hashes[k], context[k], rank[row], doc[row], first[k] - at[row], last[k] - at[row]))
                n += len(row)
            if n > GATHER:
                yield settle(held)
                held, n = [], 0
        if held:
            yield settle(held)

    def settle(held: list[tuple]) -> pa.RecordBatch:
        return _settled({f: np.concatenate(x) for f, x in zip(_FIELDS, zip(*held, strict=True), strict=True)})

    return run


def _by_key(batches: Iterator[pa.RecordBatch], key: str) -> Iterator[pa.Table]:
    """Tables of whole key groups from rows sorted by the key."""
    rest = None
    for batch in batches:
        table = pa.Table.from_batches([batch])
        table = table if rest is None else pa.concat_tables([rest, table])
        if not table.num_rows:
            continue
        values = table[key].to_numpy()
        cut = int(np.searchsorted(values, values[-1]))
        rest = table.slice(cut)
        if cut:
            yield table.slice(0, cut)
    if rest is not None and rest.num_rows:
        yield rest


_SPANS = "rank bigint, doc bigint, starts array<int>, stops array<int>"
_JUDGED = f"hash bigint, n bigint, {_SPANS}"


def _listed(held: list[tuple[np.ndarray, ...]]) -> pa.RecordBatch:
    """Gathered spans as one row for each document."""
    rank, doc, start, stop = _merged(*(np.concatenate(x) for x in zip(*held, strict=True)))
    edge = np.nonzero(np.concatenate((np.ones(min(1, len(rank)), bool), (rank[1:] != rank[:-1]) | (doc[1:] != doc[:-1]))))[0]
    at = pa.array(np.concatenate((edge, [len(rank)])).astype(np.int32))
    lists = [pa.ListArray.from_arrays(at, pa.array(x.astype(np.int32))) for x in (start, stop)]
    return pa.RecordBatch.from_arrays([pa.array(rank[edge]), pa.array(doc[edge]), *lists], ["rank", "doc", "starts", "stops"])


def _judged(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Spans of contexts that are not their first, and the contested anchors with their number of contexts."""

    def spans(held: list[tuple]) -> pa.RecordBatch:
        rows = _listed(held)
        none = pa.nulls(rows.num_rows, pa.int64())
        return pa.RecordBatch.from_arrays([none, none, *rows.columns], ["hash", "n", *rows.schema.names])

    held, gathered = [], 0
    for table in _by_key(batches, "hash"):
        done = table.filter(table["context"].is_null())
        held.append(tuple(done[f].to_numpy() for f in ("rank", "doc", "start", "stop")))
        table = table.filter(table["context"].is_valid())
        if table.num_rows:
            columns = {f: table[f].to_numpy() for f in _FIELDS}
            order, first = _first_of_class(columns["rank"], columns["hash"], columns["context"])
            columns = {k: v[order] for k, v in columns.items()}
            held.append((*(columns[k][~first] for k in ("rank", "doc", "start")), columns["stop"][~first] + SPAN))
            hashes, contexts, rank = (columns[k][first] for k in ("hash", "context", "rank"))
            edge = np.nonzero(np.concatenate(([True], hashes[1:] != hashes[:-1])))[0]
            size = np.diff([*edge, len(hashes)])
            several = np.minimum.reduceat(contexts, edge) != np.maximum.reduceat(contexts, edge)
            several &= np.minimum.reduceat(rank, edge) != np.maximum.reduceat(rank, edge)
            n = int(several.sum())
            none, lists = pa.nulls(n, pa.int64()), pa.nulls(n, pa.list_(pa.int32()))
            yield pa.RecordBatch.from_arrays(
                [pa.array(hashes[edge][several]), pa.array(size[several]), none, none, lists, lists],
                ["hash", "n", "rank", "doc", "starts", "stops"],
            )
        gathered += sum(len(x[0]) for x in held[-2:])
        if gathered > GATHER:
            yield spans(held)
            held, gathered = [], 0
    if gathered:
        yield spans(held)


_CONTEXTS = "key bigint, rank bigint, doc bigint, start bigint, stop bigint, bytes binary"


def _contested_contexts(bits, hot):
    """Map texts to the bytes of contested contexts; those of hot anchors as single strings.

    Of equal strings a task passes on the least document's, and spans without bytes for the others.
    """

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held, n = [], 0
        for rank, doc, data, at in _texts(batches):
            for row, hashes, first, last, context in anchors(data, at):
                k = _marked(bits.value, hashes)
                if not k.any():
                    continue
                row, hashes, first, last, context = (x[k] for x in (row, hashes, first, last, context))
                spread = _marked(hot.value, hashes)
                times = np.where(spread, last - first + 1, 1)
                pick = np.repeat(np.arange(len(row)), times)
                step = np.arange(len(pick)) - np.repeat(np.cumsum(times) - times, times)
                split = spread[pick]
                start = first[pick] + np.where(split, step, 0)
                stop = np.where(split, start, last[pick]) + SPAN
                pieces = [data[a:b].tobytes() for a, b in zip(start.tolist(), stop.tolist(), strict=True)]
                key, again = hashes[pick], context[pick]
                for i in np.nonzero(split)[0].tolist():
                    key[i] = again[i] = xxhash.xxh3_64_intdigest(pieces[i])
                row = row[pick]
                held.append((key, again, rank[row], doc[row], start - at[row], split, np.array(pieces, object)))
                n += len(row)
            if n > GATHER // 8:
                yield settle(held)
                held, n = [], 0
        if held:
            yield settle(held)

    def settle(held: list[tuple]) -> pa.RecordBatch:
        key, context, rank, doc, start, split, pieces = (np.concatenate(x) for x in zip(*held, strict=True))
        order, first = _first_of_class(rank, key, context)
        chosen, later = order[first], order[~first]
        later = later[split[later]]  # whole contexts that are not the first were settled before
        spans = _merged(rank[later], doc[later], start[later], start[later] + SPAN)
        deal = mixed(spans[1].view(np.uint64) ^ spans[2].view(np.uint64))
        size = np.fromiter(map(len, pieces[chosen]), np.int64, len(chosen))
        ours = (key[chosen].view(np.int64), rank[chosen], doc[chosen], start[chosen], start[chosen] + size)
        columns = [np.concatenate(x) for x in zip(ours, (deal.view(np.int64), *spans), strict=True)]
        data = pa.array([*pieces[chosen].tolist(), *[None] * len(deal)], pa.binary())
        return pa.RecordBatch.from_arrays([*map(pa.array, columns), data], ["key", "rank", "doc", "start", "stop", "bytes"])

    return run


def multikey_groups(data: bytes, suffixes: list[int], depth: int = 0) -> Iterator[list[int]]:
    """Suffixes in order by their first ``SHALLOW`` bytes; those still equal are one group.

    Ternary quicksort on symbols of four bytes: the suffixes are parted into those
    below, at and above a pivot's symbol, and only those at it go a symbol deeper.
    """
    work = [(suffixes, depth)]
    while work:
        part, depth = work.pop()
        if len(part) == 1 or depth >= SHALLOW:
            yield part
            continue
        symbols = [data[s + depth : s + depth + STEP] for s in part]
        pivot = symbols[len(part) // 2]
        below = [s for s, x in zip(part, symbols, strict=True) if x < pivot]
        at = [s for s, x in zip(part, symbols, strict=True) if x == pivot]
        if len(at) == len(part):
            work.append((at, depth + STEP))
            continue
        above = [s for s, x in zip(part, symbols, strict=True) if x > pivot]
        if above:
            work.append((above, depth))
        work.append((at, depth + STEP))
        if below:
            work.append((below, depth))


class BlindTrie:
    """Order of suffixes that share their first bytes; nodes know a depth and branch by one byte there.

    A suffix goes down by those bytes alone to some leaf, is compared with that
    leaf once, and enters where they part. Suffixes equal to the end of the span
    share a leaf.
    """

    __slots__ = ("data", "root")

    def __init__(self, data: bytes, first: int) -> None:
        self.data = data
        self.root: list | tuple = [first]  # a leaf is a list of suffixes, a node a pair of depth and branches

    def add(self, suffix: int) -> None:
        data, node = self.data, self.root
        while isinstance(node, tuple):
            depth, branches = node
            node = branches.get(data[suffix + depth]) or next(iter(branches.values()))
        other = node[0]
        mine, theirs = data[suffix : suffix + SPAN], data[other : other + SPAN]
        if mine == theirs:
            node.append(suffix)
            return
        apart = int.from_bytes(mine, "big") ^ int.from_bytes(theirs, "big")
        common = SPAN - (apart.bit_length() + 7) // 8
        above, node = None, self.root
        while isinstance(node, tuple) and node[0] < common:
            above, node = node, node[1][mine[node[0]]]
        if isinstance(node, tuple) and node[0] == common:
            node[1][mine[common]] = [suffix]
            return
        fork = (common, {theirs[common]: node, mine[common]: [suffix]})
        if above is None:
            self.root = fork
        else:
            above[1][mine[above[0]]] = fork

    def leaves(self) -> Iterator[list[int]]:
        work = [self.root]
        while work:
            node = work.pop()
            if isinstance(node, tuple):
                work += [node[1][b] for b in sorted(node[1], reverse=True)]
            else:
                yield node


def deep_shallow(data: bytes, suffixes: list[int]) -> Iterator[list[int]]:
    """Suffixes in order of their first ``SPAN`` bytes; equal ones are one list."""
    for group in multikey_groups(data, suffixes):
        if len(group) == 1:
            yield group
            continue
        trie = BlindTrie(data, group[0])
        for suffix in group[1:]:
            trie.add(suffix)
        yield from trie.leaves()


def contested_hits(ranks: list[int], pieces: list[bytes]) -> Iterator[tuple[int, int]]:
    """Piece and offset of every string that also starts in a piece of lower rank."""
    data = b"".join(pieces)
    suffixes, owner, base = [], {}, 0
    for i, piece in enumerate(pieces):
        for s in range(base, base + len(piece) - SPAN + 1):
            suffixes.append(s)
            owner[s] = (i, s - base)
        base += len(piece)
    for equal in deep_shallow(data, suffixes):
        if len(equal) > 1:
            least = min(ranks[owner[s][0]] for s in equal)
            for s in equal:
                if ranks[owner[s][0]] > least:
                    yield owner[s]


def _sorted_contexts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    held, gathered = [], 0
    for table in _by_key(batches, "key"):
        done = table.filter(table["bytes"].is_null())
        held.append(tuple(done[f].to_numpy() for f in ("rank", "doc", "start", "stop")))
        gathered += done.num_rows
        table = table.filter(table["bytes"].is_valid())
        if table.num_rows:
            key, rank, doc, start = (table[f].to_numpy() for f in ("key", "rank", "doc", "start"))
            pieces = table["bytes"].to_pylist()
            edge = np.nonzero(np.concatenate(([True], key[1:] != key[:-1])))[0].tolist()
            found: list[tuple[int, int]] = []
            ranks = rank.tolist()
            for a, b in zip(edge, [*edge[1:], len(key)], strict=True):
                # Equal contexts were settled before; single strings are settled here.
                least: dict[bytes, int] = {}
                for i in range(a, b):
                    known = least.get(pieces[i])
                    least[pieces[i]] = ranks[i] if known is None else min(known, ranks[i])
                own = [i for i in range(a, b) if ranks[i] == least[pieces[i]]]
                if len(own) < b - a:
                    found += [(i, 0) for i in range(a, b) if len(pieces[i]) == SPAN and ranks[i] > least[pieces[i]]]
                if len(least) > 1 and len({ranks[i] for i in own}) > 1:
                    found += [(own[i], s) for i, s in contested_hits([ranks[i] for i in own], [pieces[i] for i in own])]
            at = np.array([i for i, _ in found], np.int64)
            begin = start[at] + np.array([s for _, s in found], np.int64)
            held.append(_merged(rank[at], doc[at], begin, begin + SPAN))
            gathered += len(held[-1][0])
        if gathered > GATHER:
            yield _listed(held)
            held, gathered = [], 0
    if gathered:
        yield _listed(held)


def removed_spans(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """Stored spans of bytes to remove by document: ``rank`` (the id), ``doc`` (content hash), ``starts, stops``.

    Spans of one document may overlap.
    """
    spark = docs.sparkSession
    context, width, buckets = spark.sparkContext, shuffle_width(spark), _buckets(spark)
    slim = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    blobs = slim.mapInArrow(_gathered_hashes(buckets), "bucket int, blob binary")
    parts = blobs.groupBy("bucket").applyInArrow(_shared_bits(buckets), "bucket int, bits binary")
    shared = context.broadcast(_collected(parts, buckets, SHARED_BITS))
    found = slim.mapInArrow(_shared_anchors(shared), _ROWS)
    judged = keep(found.repartition(width, "hash").sortWithinPartitions("hash").mapInArrow(_judged, _JUDGED))
    shared.unpersist()
    contested = judged.filter("hash IS NOT NULL")
    bits = context.broadcast(_filter_of(contested))
    hot = context.broadcast(_filter_of(contested.filter(F.col("n") > HOT_CONTEXTS)))
    texts = slim.mapInArrow(_contested_contexts(bits, hot), _CONTEXTS)
    hits = texts.repartition(width, "key").sortWithinPartitions("key").mapInArrow(_sorted_contexts, _SPANS)
    both = judged.filter("hash IS NULL").select("rank", "doc", "starts", "stops").unionAll(hits)
    whole = {name: F.flatten(F.collect_list(name)).alias(name) for name in ("starts", "stops")}
    spans = keep(both.groupBy("rank", "doc").agg(*whole.values()))
    bits.unpersist()
    return spans


def _prepared(bits):
    """Map (id, text) to id, rank, content hash, size, and the text's digest, or its packed text if it may have spans."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        packer = zstandard.ZstdCompressor(level=1)
        for batch in batches:
            rank = _ranks(batch.column(0))
            for first, last, data, at in slices(batch.column(1)):
                cut = list(zip(at[:-1], at[1:], strict=True))
                doc = np.array([_content(data[a:b]) for a, b in cut], np.int64)
                some = _marked(bits.value, mixed(doc.view(np.uint64)))
                texts = [packer.compress(data[a:b]) if s else None for (a, b), s in zip(cut, some, strict=True)]
                whole = [None if s else hashlib.sha256(data[a:b]).hexdigest() for (a, b), s in zip(cut, some, strict=True)]
                yield pa.RecordBatch.from_arrays(
                    [batch.column(0).slice(first, last - first), pa.array(rank[first:last]), pa.array(doc), pa.array(np.diff(at)), pa.array(whole, pa.string()), pa.array(texts, pa.binary())],
                    ["id", "rank", "doc", "n_bytes", "digest", "bytes"],
                )

    return run


def _cut_batches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    unpacker = zstandard.ZstdDecompressor()
    for batch in batches:
        removed, spans, digests = [], [], []
        for text, begins, stops in zip(batch["bytes"], batch["starts"], batch["stops"], strict=True):
            data = unpacker.decompress(text.as_buffer())
            begin = np.asarray(begins.values, np.int64) if begins.is_valid else np.zeros(0, np.int64)
            stop = np.asarray(stops.values, np.int64) if stops.is_valid else np.zeros(0, np.int64)
            zero = np.zeros(len(begin), np.int64)
            _, _, begin, stop = _merged(zero, zero, begin, stop)
            digest, at = hashlib.sha256(), 0
            for a, b in zip(begin.tolist(), stop.tolist(), strict=True):
                digest.update(data[at:a])
                at = b
            digest.update(data[at:])
            removed.append(int((stop - begin).sum()))
            spans.append(len(begin))
            digests.append(digest.hexdigest())
        yield pa.RecordBatch.from_arrays(
            [batch["id"], batch["n_bytes"], pa.array(removed, pa.int64()), pa.array(spans, pa.int64()), pa.array(digests, pa.string())],
            ["id", "n_bytes", "n_removed", "n_spans", "kept_sha256"],
        )


def suffix_dedup(docs: DataFrame, id_column: str = "doc_id", text: str = "text") -> DataFrame:
    """One row per document: its id, ``n_bytes, n_removed, n_spans, kept_sha256``.

    Texts that have no spans stay where they are; the others meet their spans in one shuffle.
    """
    slim = docs.select(F.col(id_column).alias("id"), F.col(text).alias("text"))
    kind = slim.schema["id"].dataType.simpleString()
    grouped = removed_spans(docs, id_column, text)
    bits = docs.sparkSession.sparkContext.broadcast(_filter_of(grouped.select("doc").mapInArrow(_mixed_keys, "hash bigint")))
    schema = f"id {kind}, rank bigint, doc bigint, n_bytes bigint, digest string, bytes binary"
    rows = slim.mapInArrow(_prepared(bits), schema)
    cut = rows.filter("bytes IS NOT NULL").join(grouped, ["rank", "doc"], "left").select("id", "n_bytes", "bytes", "starts", "stops")
    result = f"id {kind}, n_bytes bigint, n_removed bigint, n_spans bigint, kept_sha256 string"
    zero = F.lit(0).cast("bigint")
    whole = rows.filter("bytes IS NULL").select("id", "n_bytes", zero.alias("n_removed"), zero.alias("n_spans"), F.col("digest").alias("kept_sha256"))
    return cut.mapInArrow(_cut_batches, result).unionAll(whole).withColumnRenamed("id", id_column)


def _mixed_keys(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        keys = mixed(batch.column(0).to_numpy().view(np.uint64))
        yield pa.RecordBatch.from_arrays([pa.array(keys.view(np.int64))], ["hash"])
