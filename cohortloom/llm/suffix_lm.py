"""Language-model scores by a probabilistic suffix tree over words.

Symbols are the frequent tokens; all others share one symbol, inside which a token
has the share that its count gives it. A context is a run of the last one to
``depth`` symbols (a text begins with a start symbol) that occurs ``min_count`` times in
the training texts. It is retained as a state of the tree if its next symbols
diverge from those after its suffix: the gain in log-likelihood must exceed
half the logarithm of its count for each distinct next symbol (the usual price of
a parameter). Every state smooths its counts with the distribution of its longest retained
suffix, weighted by the number of distinct next symbols; the root is the add-one
distribution of single tokens. A token is scored by the longest state that
the symbols before it end with. The least count is the same for a corpus of any size.

The model is a table spread over the cluster and grows with the corpus. Documents are
coded once into blocks: integers, and the block's own dictionary of 64-bit token
hashes (tokens are told apart by them). A block asks for the counts of its distinct
tokens, then of its distinct runs of symbols, level by level, each with what it has to add
itself; the buckets of the key space sum up and answer. Answers number frequent symbols and
runs, from small numbers on for the most frequent ones, so a later level asks by numbers: for each
context its next symbols. The bucket of a context decides if it is a state; runs of a context too
frequent for one bucket are dealt over several by next symbol, and the few sums of such contexts are added
up at the driver. So a shuffle moves distinct keys of blocks, packed, never a row per token,
and a frequent word is one key of each block. Blocks are stored bucketed by number, so only answers move to them.

On disk lie at a time: the codes of the blocks, the answers so far, and what one level asks or is answered. Words are stored apart
from the codes, ask in rounds, and are deleted once they have numbers; then the blocks are coded anew, by what the model knows of a
word: its number and training occurrences, or, of a rare word, the occurrences alone. Answers are stored as the buckets give them first,
so that what was asked can go before they move to their blocks. Shuffle files go when the table made from them is written.

Null and empty texts have one token, the end. Rows with a null or repeated id are
documents of their own. Without training texts every token has the probability
of an unseen one. An empty table gives no rows. Further columns are ignored.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from contextlib import contextmanager
from functools import partial

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cohortloom.llm.common import keep, mixed, slices
from cohortloom.llm.words import hashed_words
from cohortloom.plans.stages import SharedFolder
from cohortloom.session import fresh_folder, shuffle_width

DEPTH = 2
#: Training occurrences that a symbol of its own, and a context, has at least.
MIN_COUNT = 50
#: Tokens of a block (one document at least), and tokens whose keys one bucket answers for.
BLOCK_TOKENS = 1 << 20
BUCKET_TOKENS = 1 << 22
#: Words ask in so many rounds, each for a part of the buckets.
WORD_ROUNDS = 2
#: A context with so few runs in a block sends whole numbers, which take less room than the sum of their logarithms.
FEW = 2
#: A context with more than one of so many parts of a bucket's tokens is dealt over several buckets.
HOT_PARTS = 4
#: Every byte but ASCII white space belongs to a token.
TOKEN = ~np.isin(np.arange(256), [9, 10, 11, 12, 13, 32])
END = np.uint64(0x9E6C63D0876A9A47)
#: Numbers of the symbol that rare tokens share, of the start symbol, and of the first symbol or run with a number of its own.
RARE, START, FIRST = 0, 1, 2
_SPREAD = np.uint64(0x9FB21C651E98DF25)

#: Parts of a stored block: codes of its tokens, and its distinct words.
CODES, WORDS = "codes", "words"
#: Spark deletes the shuffle files of a query at its end.
_CLEANUP = "spark.sql.classic.shuffleDependency.fileCleanup.enabled"

_TEXTS = "ids array<{kind}>, held array<boolean>, sizes array<bigint>, data binary"
_ASKED = "block bigint, bucket int, data binary"
_ANSWERS = "block bigint, level int, bucket int, data binary"
_SCORES = (
    "id {kind}, held_out boolean, n_tokens bigint, n_known bigint, train_tokens bigint, base_score double, score double"
)
_SCORE_FIELDS = [
    ("held_out", pa.bool_()), ("n_tokens", pa.int64()), ("n_known", pa.int64()), ("train_tokens", pa.int64()),
    ("base_score", pa.float64()), ("score", pa.float64()),
]


def pack(values: np.ndarray) -> bytes:
    """Whole numbers as compressed planes of bytes; small ones take little room."""
    planes = np.ascontiguousarray(values, np.uint64).view(np.uint8).reshape(-1, 8).T
    return len(values).to_bytes(8, "little") + pa.Codec("zstd", 1).compress(planes.tobytes(), asbytes=True)


def unpack(data: bytes) -> np.ndarray:
    size = int.from_bytes(data[:8], "little")
    planes = pa.Codec("zstd").decompress(data[8:], 8 * size, asbytes=True) if size else b""
    return np.ascontiguousarray(np.frombuffer(planes, np.uint8).reshape(8, size).T).view(np.uint64).reshape(-1)


def pack_parts(*parts: np.ndarray) -> bytes:
    """Several arrays in one; floats as their bits."""
    sizes = np.array([len(parts), *map(len, parts)], np.uint64)
    return pack(np.concatenate([sizes, *(p.view(np.uint64) if p.dtype.kind == "f" else p.astype(np.uint64) for p in parts)]))


def unpack_parts(data: bytes) -> list[np.ndarray]:
    values = unpack(data)
    first = int(values[0]) + 1
    return np.split(values[first:], np.cumsum(values[1:first].astype(np.int64))[:-1])


def _joined(pieces: list[list[np.ndarray]], part: int) -> np.ndarray:
    return np.concatenate([p[part] for p in pieces] or [np.zeros(0, np.uint64)])


def _steps(ascending: np.ndarray) -> np.ndarray:
    """Differences, which pack better; ``np.cumsum`` undoes them."""
    return np.diff(ascending, prepend=ascending.dtype.type(0))


def _coded(held: list[np.ndarray], sizes: list[int], ids: list, out: list[bool], kind: pa.DataType) -> pa.RecordBatch:
    """Two rows of a block: its texts as codes, with how often each word occurs, and its words with their training occurrences.

    Words are in the order of their hashes, codes in that of falling numbers of occurrences, so the first row needs no words.
    """
    words, codes, counts = np.unique(np.concatenate(held), return_inverse=True, return_counts=True)
    train = np.bincount(codes[np.repeat(~np.array(out, bool), sizes)], minlength=len(words))
    rank = np.empty(len(words), np.int64)
    rank[_falling(counts)] = np.arange(len(words))  # frequent words get small codes
    columns = [
        pa.array([CODES, WORDS]),
        pa.array([ids, []], pa.list_(kind)),
        pa.array([out, []], pa.list_(pa.bool_())),
        pa.array([sizes, []], pa.list_(pa.int64())),
        pa.array([pack_parts(counts, rank[codes]), pack_parts(_steps(words), train)], pa.binary()),
    ]
    return pa.RecordBatch.from_arrays(columns, ["part", "ids", "held", "sizes", "data"])


def _falling(counts: np.ndarray) -> np.ndarray:
    return np.argsort(-counts.astype(np.int64), kind="stable")


def _block_batches(block_tokens: int) -> Callable:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        kind, held, sizes, ids, out, total = None, [], [], [], [], 0
        for batch in batches:
            kind = batch.column(0).type
            keys, outs = batch.column(0).to_pylist(), batch.column(1).to_pylist()
            for first, last, data, at in slices(batch.column(2)):
                starts, _, hashes = hashed_words(data, at, TOKEN)
                ends = np.searchsorted(starts, at[1:])
                held.append(np.insert(hashes, ends, END))
                sizes += (np.diff(ends, prepend=0) + 1).tolist()
                ids += keys[first:last]
                out += outs[first:last]
                total += len(held[-1])
                if total >= block_tokens:
                    yield _coded(held, sizes, ids, out, kind)
                    held, sizes, ids, out, total = [], [], [], [], 0
        if ids:
            yield _coded(held, sizes, ids, out, kind)

    return run


class _Stored:
    """Rows stored in a table by their part, bucketed by their block, so that reading a part by block moves none."""

    def __init__(self, spark: SparkSession, label: str, buckets: int):
        self.spark, self.buckets, self.path = spark, buckets, fresh_folder(spark, label)
        self.name = self.path.rpartition("/")[2].replace("-", "_")

    def add(self, rows: DataFrame) -> None:
        writer = rows.write.mode("append").option("path", self.path).option("compression", "none")
        if "part" in rows.columns:
            writer = writer.partitionBy("part")
        writer.bucketBy(self.buckets, "block").saveAsTable(self.name)

    def rows(self, part: str | None = None) -> DataFrame:
        rows = self.spark.table(self.name)
        return rows.filter(F.col("part") == part).drop("part") if part else rows

    def drop_part(self, part: str) -> None:
        """Delete the files of a part that is not read any more."""
        SharedFolder(self.spark, self.path).delete(f"{self.path}/part={part}")

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        SharedFolder(self.spark, self.path).delete(self.path)


@contextmanager
def _short_shuffles(spark: SparkSession) -> Iterator[None]:
    """Shuffle files go when the table made from them is written, not when the driver's memory happens to be cleaned."""
    before = spark.conf.get(_CLEANUP, None)
    spark.conf.set(_CLEANUP, "true")
    try:
        yield
    finally:
        if before is None:
            spark.conf.unset(_CLEANUP)
        else:
            spark.conf.set(_CLEANUP, before)


class _Shared:
    """What all blocks and buckets share."""

    def __init__(self, depth: int, min_count: int, tokens: int, buckets: int):
        self.depth, self.min_count, self.buckets = depth, min_count, buckets
        self.hot_count = max(1, tokens // (HOT_PARTS * buckets))
        #: Of each level, the contexts dealt over several buckets and, where they are states, their distinct next symbols.
        self.hot: dict[int, tuple[np.ndarray, np.ndarray]] = {}

    def add_totals(self, tokens: int, distinct: int, texts: int, frequent: int, plus_one: int) -> None:
        """Training tokens, distinct ones, texts, and counts of the frequent symbols."""
        self.tokens, self.distinct, self.texts = tokens, distinct, texts
        self.room = tokens + distinct + 1
        self.rare, self.rare_room = tokens - frequent, max(1, self.room - plus_one)

    def add_hot(self, level: int, found: list[bytes]) -> None:
        """Add up what the buckets say of contexts dealt over several of them; a few for each bucket."""
        pieces = [unpack_parts(f) for f in found]
        contexts, inverse = np.unique(_joined(pieces, 0), return_inverse=True)
        kinds, sums = (np.bincount(inverse, _joined(pieces, k), len(contexts)) for k in (1, 2))
        gains = np.bincount(inverse, _joined(pieces, 3).view(np.float64), len(contexts))
        self.hot[level] = contexts.astype(np.int64), np.where(_states(gains, kinds, sums), kinds, 0).astype(np.int64)

    def bucket(self, hashes: np.ndarray) -> np.ndarray:
        return (((hashes >> np.uint64(40)) * np.uint64(self.buckets)) >> np.uint64(24)).astype(np.int64)

    def number(self, rank: np.ndarray, bucket: np.ndarray) -> np.ndarray:
        """Numbers of frequent keys from their ranks in their buckets; no two buckets give the same."""
        return FIRST + (rank.astype(np.int64) - 1) * self.buckets + bucket


def _ranks(counts: np.ndarray, frequent: np.ndarray) -> np.ndarray:
    """Ranks of a bucket's frequent keys by falling count, from 1 on; zero for the rest."""
    order = np.nonzero(frequent)[0]
    order = order[np.argsort(-counts[order], kind="stable")]
    out = np.zeros(len(counts), np.int64)
    out[order] = np.arange(1, len(order) + 1)
    return out


def _states(gains: np.ndarray, kinds: np.ndarray, sums: np.ndarray) -> np.ndarray:
    """Contexts whose gain in likelihood is worth a state; ``gains`` is without the part of the contexts' own counts."""
    logs = np.log(np.maximum(sums, 1))
    return gains - sums * logs > 0.5 * kinds * logs


class _Block:
    """A block's tokens, and its runs of symbols as far as answers are there."""

    def __init__(self, row: dict):
        self.number, self.ids, self.held = row["block"], row["ids"], np.array(row["held"], bool)
        self.sizes = np.array(row["sizes"], np.int64)
        self.starts = np.cumsum(self.sizes) - self.sizes
        self.train = np.repeat(~self.held, self.sizes)
        numbers, counts, occurrences, codes = unpack_parts(row["data"])
        self.codes, order = codes.astype(np.int32), _falling(occurrences)
        numbers, self.counts = np.cumsum(numbers).astype(np.int64)[order], counts.astype(np.int64)[order]
        self.rare = numbers == RARE
        self.symbols, symbol = np.unique(numbers, return_inverse=True)
        self.symbol = symbol.astype(np.int32)[self.codes]

    def levels(self, answers: dict[int, list[bytes]], shared: _Shared, level: int) -> Iterator[_Level]:
        """Level after level up to ``level``, each with its answers unless it is still to be asked."""
        place = np.arange(len(self.codes), dtype=np.int32) - np.repeat(self.starts.astype(np.int32), self.sizes)
        above: _Level | None = None
        for d in range(1, level + 1):
            above = _Level(self, above, d, place, shared)
            if d in shared.hot:
                above.answered([unpack_parts(a) for a in answers.get(d, [])])
            yield above


class _Level:
    """The runs of a context of ``d`` symbols and its next symbol, at the places where the context is frequent enough."""

    def __init__(self, block: _Block, above: _Level | None, d: int, place: np.ndarray, shared: _Shared):
        self.block, self.d, self.shared = block, d, shared
        size = len(place)
        # Occurrences of the context, of its suffix and of the run without the farthest symbol.
        if above is None:
            self.shorter = np.where(block.rare, shared.rare, block.counts)[block.codes]
            contexts, self.suffix_sums = block.symbols[block.symbol], np.full(size, shared.tokens, np.int64)
        else:
            self.shorter, contexts, self.suffix_sums = above.counts, above.numbers, above.sums
        contexts, self.sums = np.roll(contexts, 1), np.roll(self.shorter, 1)
        if above is None:
            contexts[place == 0], self.sums[place == 0] = START, shared.texts
        else:
            self.sums[place < d - 1] = 0
        self.at = np.nonzero(self.sums >= shared.min_count)[0]
        self.contexts, inverse = np.unique(contexts[self.at], return_inverse=True)
        inverse *= len(block.symbols)
        inverse += block.symbol[self.at]
        runs, first, self.inverse = np.unique(inverse, return_index=True, return_inverse=True)
        # The distinct runs in the order of their buckets, then contexts, then next symbols.
        context, symbol = np.divmod(runs, max(1, len(block.symbols)))
        first = self.at[first]
        parts = (self.sums[first] // shared.hot_count + 1).astype(np.uint64)
        part = mixed(block.symbols[symbol].astype(np.uint64)) % parts
        bucket = shared.bucket(mixed(mixed(self.contexts[context].astype(np.uint64) + np.uint64(d)) * _SPREAD + part))
        self.order = np.argsort(bucket, kind="stable")
        self.bucket, self.context, self.symbol = bucket[self.order], context[self.order], symbol[self.order]
        self.first, self.hot = first[self.order], parts[self.order] > 1
        fresh = (np.diff(self.bucket, prepend=-1) != 0) | (np.diff(self.context, prepend=-1) != 0)
        self.heads = np.nonzero(fresh)[0]
        self.kinds = np.diff(self.heads, append=len(runs))

    def asked(self) -> Iterator[tuple[int, bytes]]:
        """Buckets and what they are asked: contexts, how many runs each has here, then the runs."""
        if not len(self.heads):
            return
        block, heads = self.block, self.heads
        counts = np.bincount(self.inverse[block.train[self.at]], minlength=len(self.order))[self.order]
        shorter, suffix_sums = np.maximum(1, self.shorter[self.first]), self.suffix_sums[self.first]
        logs = np.add.reduceat(counts * (np.log(shorter) - np.log(suffix_sums)), heads)
        contexts, kinds, symbols = self.contexts[self.context[heads]], 2 * self.kinds + self.hot[heads], block.symbols[self.symbol]
        few = self.kinds <= FEW
        of_few = np.repeat(few, self.kinds)
        symbols[1:] -= np.where(np.diff(np.repeat(heads, self.kinds)) == 0, symbols[:-1], 0)  # steps, within a context
        cuts = np.searchsorted(self.bucket, np.arange(self.shared.buckets + 1))
        head_cuts = np.searchsorted(heads, cuts)
        for b in np.nonzero(np.diff(cuts))[0].tolist():
            h, r = slice(*head_cuts[b : b + 2]), slice(*cuts[b : b + 2])
            numbers = shorter[r][of_few[r]], suffix_sums[heads[h][few[h]]], logs[h][~few[h]]
            yield b, pack_parts(_steps(contexts[h]), kinds[h], symbols[r], counts[r], *numbers)

    def answered(self, pieces: list[list[np.ndarray]]) -> None:
        """Take in the runs' training counts and numbers, and the distinct next symbols of contexts that are states."""
        kinds = np.repeat(_joined(pieces, 0).astype(np.int64), self.kinds)
        hot, hot_kinds = self.shared.hot[self.d]
        if self.hot.any():
            kinds[self.hot] = hot_kinds[np.searchsorted(hot, self.contexts[self.context[self.hot]])]
        told = np.ones(len(kinds), bool) if self.d < self.shared.depth else (kinds > 0) | self.hot
        self.counts = self._placed(told, _joined(pieces, 1))
        if self.d < self.shared.depth:
            frequent = _joined(pieces, 1) >= self.shared.min_count
            self.numbers = self._placed(frequent, self.shared.number(_joined(pieces, 2), self.bucket[frequent]))
        self.state_kinds = self._placed(kinds > 0, kinds[kinds > 0])

    def _placed(self, mask: np.ndarray, values: np.ndarray) -> np.ndarray:
        """Values of some runs, at all places of these runs."""
        of_run, out = np.zeros(len(self.order), np.int64), np.zeros(len(self.sums), np.int64)
        of_run[self.order[mask]] = values
        out[self.at] = of_run[self.inverse]
        return out

    def smoothed(self, likely: np.ndarray) -> None:
        """Replace the probabilities at places whose context is a state."""
        at = np.nonzero(self.state_kinds)[0]
        t = self.state_kinds[at]
        likely[at] = (self.counts[at] + t * likely[at]) / (self.sums[at] + t)


def _table(rows: list[dict], schema: str) -> pa.Table:
    kinds = {"bigint": pa.int64(), "int": pa.int32(), "binary": pa.binary()}
    fields = [c.split() for c in schema.split(", ")]
    return pa.Table.from_pylist(rows, pa.schema([(n, kinds[k]) for n, k in fields]))


def _answer_words(shared: _Shared, table: pa.Table) -> pa.Table:
    """Sum a bucket's tokens over blocks and answer each block in the order of its keys; block -1 has the bucket's totals."""
    rows = table.to_pylist()
    bucket = rows[0]["bucket"]
    pieces = [unpack_parts(r["data"]) for r in rows]
    keys, inverse = np.unique(np.concatenate([np.cumsum(p[0]) for p in pieces]), return_inverse=True)
    counts = np.bincount(inverse, _joined(pieces, 1)).astype(np.int64)
    frequent = (counts >= shared.min_count) | (keys == END)
    ranks = _ranks(counts, frequent)
    own = counts[frequent]
    totals = [counts.sum(), (counts > 0).sum(), counts[keys == END].sum(), own.sum(), (own + 1).sum()]
    out, at = [{"block": -1, "level": 0, "bucket": bucket, "data": pack(np.array(totals))}], 0
    for row, piece in zip(rows, pieces, strict=True):
        key = inverse[at : at + len(piece[0])]
        at += len(key)
        out.append({"block": row["block"], "level": 0, "bucket": bucket, "data": pack_parts(counts[key], ranks[key])})
    return _table(out, _ANSWERS)


def _answer_runs(shared: _Shared, level: int, table: pa.Table) -> pa.Table:
    """Sum a bucket's runs over blocks, choose the states, and answer each block in the order that it asked in.

    A row of block -1 has the sums of contexts that are dealt over several buckets.
    """
    rows = table.to_pylist()
    bucket, last = rows[0]["bucket"], level == shared.depth
    pieces = [unpack_parts(r["data"]) for r in rows]
    contexts, context = np.unique(np.concatenate([np.cumsum(p[0]) for p in pieces]), return_inverse=True)
    own_kinds, counts = _joined(pieces, 1).astype(np.int64), _joined(pieces, 3).astype(np.int64)
    hot = np.zeros(len(contexts), bool)
    hot[context], own_kinds = own_kinds & 1 > 0, own_kinds >> 1
    few = own_kinds <= FEW
    of_few, logs = np.repeat(few, own_kinds), np.empty(len(context))
    of_context = np.repeat(np.arange(few.sum()), own_kinds[few])
    own_logs = counts[of_few] * (np.log(_joined(pieces, 4)) - np.log(_joined(pieces, 5))[of_context])
    logs[few], logs[~few] = np.bincount(of_context, own_logs, few.sum()), _joined(pieces, 6).view(np.float64)
    symbols = np.cumsum(_joined(pieces, 2).astype(np.int64))
    before = np.concatenate(([0], symbols))[np.cumsum(own_kinds) - own_kinds]
    symbols -= np.repeat(before, own_kinds)
    width = symbols.max() + 1
    symbols += np.repeat(context, own_kinds) * width
    runs, run = np.unique(symbols, return_inverse=True)
    of, size = runs // width, len(contexts)
    counts = np.bincount(run, counts).astype(np.int64)
    kinds, sums = np.bincount(of[counts > 0], minlength=size), np.bincount(of, counts, size)
    gains = np.bincount(of, counts * np.log(np.maximum(1, counts)), size) - np.bincount(context, logs, size)
    state_kinds = np.where(~hot & _states(gains, kinds, sums), kinds, 0)
    told = (state_kinds > 0) | hot
    ranks = _ranks(counts, counts >= shared.min_count)
    sums_of_hot = pack_parts(contexts[hot], kinds[hot], sums[hot].astype(np.int64), gains[hot])
    out, at, run_at = [{"block": -1, "level": level, "bucket": bucket, "data": sums_of_hot}], 0, 0
    for row, piece in zip(rows, pieces, strict=True):
        own, mine = context[at : at + len(piece[0])], run[run_at : run_at + len(piece[2])]
        at, run_at = at + len(own), run_at + len(mine)
        if last:
            data = pack_parts(state_kinds[own], counts[mine[told[of[mine]]]])
        else:
            data = pack_parts(state_kinds[own], counts[mine], ranks[mine[counts[mine] >= shared.min_count]])
        out.append({"block": row["block"], "level": level, "bucket": bucket, "data": data})
    return _table(out, _ANSWERS)


def _sorted_answers(table: pa.Table) -> dict[int, list[bytes]]:
    """Answers of each level in the order of buckets."""
    out: dict[int, list[bytes]] = {}
    for row in sorted(table.select(["level", "bucket", "data"]).to_pylist(), key=lambda r: (r["level"], r["bucket"])):
        out.setdefault(row["level"], []).append(row["data"])
    return out


def _ask_words(shared: _Shared, turn: int) -> Callable:
    """Ask for the words of the buckets whose turn it is."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for row in batch.to_pylist():
                steps, counts = unpack_parts(row["data"])
                keys = np.cumsum(steps)
                cuts = np.searchsorted(shared.bucket(keys), np.arange(shared.buckets + 1))
                rows = []
                for b in np.nonzero(np.diff(cuts))[0].tolist():
                    if b % WORD_ROUNDS != turn:
                        continue
                    part = slice(*cuts[b : b + 2])
                    rows.append({"block": row["block"], "bucket": b, "data": pack_parts(_steps(keys[part]), counts[part])})
                yield from _table(rows, _ASKED).to_batches()

    return run


def _known(shared: _Shared, left: pa.Table, right: pa.Table) -> pa.Table:
    """Code a block's texts anew: words of one number, or rare ones with equal training occurrences, share a code."""
    if not left.num_rows:
        return left
    row, answers = left.to_pylist()[0], sorted(right.select(["bucket", "data"]).to_pylist(), key=lambda r: r["bucket"])
    own, codes = unpack_parts(row["data"])
    pieces, order = [unpack_parts(a["data"]) for a in answers], _falling(own)  # places of the codes' words among their hashes
    bucket = np.repeat([a["bucket"] for a in answers], [len(p[0]) for p in pieces])[order]
    counts, rank = _joined(pieces, 0)[order].astype(np.int64), _joined(pieces, 1)[order]
    numbers = np.where(rank > 0, shared.number(rank, bucket), RARE)
    _, first, entry = np.unique(np.where(rank > 0, numbers + shared.min_count, counts), return_index=True, return_inverse=True)
    entries = entry[codes.astype(np.int64)]
    occurrences = np.bincount(entries, minlength=len(first))
    place = np.empty(len(first), np.int64)
    place[_falling(occurrences)] = np.arange(len(first))
    data = pack_parts(_steps(numbers[first]), counts[first], occurrences, place[entries])
    return left.set_column(left.schema.get_field_index("data"), "data", pa.array([data], pa.binary()))


def _ask_runs(shared: _Shared, level: int, left: pa.Table, right: pa.Table) -> pa.Table:
    """Ask for the runs of a level."""
    if not left.num_rows:
        return _table([], _ASKED)
    block = _Block(left.to_pylist()[0])
    for runs in block.levels(_sorted_answers(right), shared, level):
        pass
    return _table([{"block": block.number, "bucket": b, "data": data} for b, data in runs.asked()], _ASKED)


def _scores(shared: _Shared, left: pa.Table, right: pa.Table) -> pa.Table:
    """Scores of a block's documents."""
    schema = pa.schema([("id", left.schema.field("ids").type.value_type), *_SCORE_FIELDS])
    if not left.num_rows:
        return schema.empty_table()
    block, likely = _Block(left.to_pylist()[0]), None
    for runs in block.levels(_sorted_answers(right), shared, shared.depth):
        if likely is None:
            likely = _root(block, shared)
        runs.smoothed(likely)
    likely = _root(block, shared) if likely is None else likely
    counts, rare = block.counts[block.codes], block.rare[block.codes]
    likely = np.where(rare, likely * (counts + 1) / shared.rare_room, likely)
    summed = partial(np.add.reduceat, indices=block.starts)
    columns = [
        pa.array(block.ids, schema.field("id").type),
        pa.array(block.held),
        pa.array(block.sizes),
        pa.array(summed((counts > 0).astype(np.int64))),
        pa.array(np.full(len(block.sizes), shared.tokens)),
        pa.array(summed(np.log10((counts + 1) / shared.room))),
        pa.array(summed(np.log10(likely))),
    ]
    return pa.Table.from_arrays(columns, schema=schema)


def _root(block: _Block, shared: _Shared) -> np.ndarray:
    """Probabilities of the block's symbols by the root."""
    return (np.where(block.rare, shared.rare_room, block.counts + 1) / shared.room)[block.codes]


def suffix_tree_scores(
    docs: DataFrame,
    held_out: Column,
    id_column: str = "doc_id",
    text: str = "text",
    depth: int = DEPTH,
    min_count: int = MIN_COUNT,
    block_tokens: int = BLOCK_TOKENS,
) -> DataFrame:
    """One row per document: id, ``held_out, n_tokens, n_known, train_tokens, base_score, score``.

    The model learns from the rows where ``held_out`` is not true. ``base_score`` is the log10 probability by the add-one
    distribution of single tokens, ``score`` that by the suffix tree.
    """
    spark = docs.sparkSession
    slim = docs.select(
        F.col(id_column).alias("id"), F.coalesce(held_out, F.lit(False)).alias("held"), F.col(text).alias("text")
    )
    kind = slim.schema["id"].dataType.simpleString()
    schema = _TEXTS.format(kind=kind)
    width = shuffle_width(spark)
    labels = "lm-blocks", "lm-numbers", "lm-texts", "lm-answers"
    blocks, numbers, texts, answers = tables = [_Stored(spark, label, width) for label in labels]
    try:
        with _short_shuffles(spark):
            coded = slim.mapInArrow(_block_batches(block_tokens), f"part string, {schema}")
            number = F.shiftright(F.monotonically_increasing_id(), 1)  # a block's two rows follow each other
            blocks.add(coded.select(number.alias("block"), "*"))
            sizes = F.aggregate("sizes", F.lit(0).cast("bigint"), lambda x, y: x + y)
            tokens = blocks.rows(CODES).agg(F.sum(sizes)).first()[0] or 0
            shared = _Shared(depth, min_count, tokens, max(width, -(-tokens // BUCKET_TOKENS)))
            found = []
            for turn in range(WORD_ROUNDS):
                asked = blocks.rows(WORDS).select("block", "data").mapInArrow(_ask_words(shared, turn), _ASKED)
                found += _answered(asked, partial(_answer_words, shared), numbers)
            blocks.drop_part(WORDS)
            found = [unpack(f).astype(np.int64) for f in found]
            shared.add_totals(*(sum(f[i].item() for f in found) for i in range(5)))
            texts.add(_by_block(blocks.rows(CODES), numbers, partial(_known, shared), f"block bigint, {schema}"))
            blocks.drop()
            numbers.drop()
            answers.add(spark.createDataFrame([], _ANSWERS))
            for level in range(1, depth + 1):
                asked = _by_block(texts.rows(), answers, partial(_ask_runs, shared, level), _ASKED)
                shared.add_hot(level, _answered(asked, partial(_answer_runs, shared, level), answers))
            scored = _by_block(texts.rows(), answers, partial(_scores, shared), _SCORES.format(kind=kind))
            return keep(scored).withColumnRenamed("id", id_column)
    finally:
        for table in tables:
            table.drop()


def _answered(asked: DataFrame, f: Callable, answers: _Stored) -> list[bytes]:
    """Store the buckets' answers to the blocks; what they say to all comes back.

    They are stored as they are made first, and what was asked goes then.
    """

    def run(table: pa.Table) -> pa.Table:
        return f(table)

    spark = asked.sparkSession
    path = fresh_folder(spark, "lm-answered")
    try:
        made = asked.groupBy("bucket").applyInArrow(run, _ANSWERS)
        made.write.option("compression", "none").parquet(path)
        made = spark.read.schema(_ANSWERS).parquet(path)
        answers.add(made.filter("block >= 0").repartition(answers.buckets, "block"))
        return [r["data"] for r in made.filter("block = -1").select("data").collect()]
    finally:
        SharedFolder(spark, path).delete(path)


def _by_block(blocks: DataFrame, answers: _Stored, f: Callable, schema: str) -> DataFrame:
    """A function of each block and the answers to it."""

    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        return f(left, right)

    return blocks.groupBy("block").cogroup(answers.rows().groupBy("block")).applyInArrow(run, schema)
