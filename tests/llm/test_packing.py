"""Packing: ids against the JSON tokenizer, bins against a plain search, and gapless sequences."""

import random
import zlib

import numpy as np
import public_tokenizers
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st
from tokenizers import Tokenizer

from cohortloom.llm import packing

VOCABULARY = public_tokenizers.path(packing.VOCABULARY)
ENCODING = packing.load_encoding(public_tokenizers.path(packing.RANKS), packing.added_tokens(VOCABULARY))
TOKENIZER = Tokenizer.from_file(VOCABULARY)


def plain_ids(text):
    return [*TOKENIZER.encode(text or "", add_special_tokens=False).ids, 2]


@settings(max_examples=300, deadline=None)
@given(
    st.text(max_size=80)
    | st.text("ab '\n\tsé1!.  ", max_size=60)
    | st.lists(st.sampled_from(["<|endoftext|>", "<|endof", "text|>", " ", "a"]), max_size=8).map("".join)
)
def test_ids_are_the_tokenizers(text):
    assert packing.token_ids(ENCODING, text).tolist() == plain_ids(text)


def test_parts_of_long_texts(monkeypatch):
    rng = random.Random(2)
    text = "".join(rng.choice(["word ", " b", "\n", "it's", "é", "  ", "1", "<|endoftext|>"]) for _ in range(3000))
    whole = plain_ids(text)
    for part in (1, 7, 100):
        monkeypatch.setattr(packing, "PART_CHARS", part)
        assert packing.token_ids(ENCODING, text).tolist() == whole


def test_cuts():
    assert packing.cuts(5, 10) == [(0, 5)]
    assert packing.cuts(10, 10) == [(0, 10)]
    assert packing.cuts(20, 10) == [(0, 10), (10, 10)]
    assert packing.cuts(23, 10) == [(0, 3), (3, 10), (13, 10)]


@pytest.mark.parametrize("seed", range(5))
def test_best_fit_takes_the_tightest_bin(seed):
    lengths = np.array(random.Random(seed).choices(range(1, 101), k=400))
    bins, offsets = packing.best_fit(lengths, 100)
    rooms = []
    for i in np.argsort(-lengths, kind="stable"):
        fits = [r for r in rooms if r >= lengths[i]]
        room = min(fits) if fits else 100
        if fits:
            rooms.remove(room)
        assert offsets[i] == 100 - room
        rooms.append(room - lengths[i])
    assert len(rooms) == bins.max() + 1


@pytest.mark.parametrize("group", [packing.GROUP_PIECES, 20])
def test_sequences(monkeypatch, documents, group):
    monkeypatch.setattr(packing, "GROUP_PIECES", group)
    rng = random.Random(4)
    pairs = [(i, "token " * rng.choice([3, 90, 500, 1023, 1024, 2047, 5000])) for i in range(80)]
    pairs += [(100, None), (101, ""), (5, "again"), (None, "no id"), (None, "no id")]
    rows = packing.pack(documents(pairs)).collect()
    texts = {i: t for i, t in pairs if i not in (5, None)}
    for i, text in texts.items():
        ids, own = plain_ids(text), sorted((r for r in rows if r.doc_id == i), key=lambda r: r.piece)
        assert [r.piece for r in own] == list(range(len(own))) and sum(r.length for r in own) == len(ids)
        assert all(r.length == 1024 for r in own[1:])
        for r in own:
            part = np.array(ids[r.start : r.start + r.length], "<u4")
            assert len(part) == r.length and zlib.crc32(part.tobytes()) == r.ids_crc32
    assert sum(r.doc_id is None for r in rows) == 2
    placed = {}
    for r in rows:
        placed.setdefault(r.sequence_id, []).append((r.offset, r.length))
    for spans in placed.values():
        at = 0
        for offset, length in sorted(spans):
            assert offset == at
            at += length
        assert at <= 1024
    if group > 20:
        assert len(placed) <= -(-sum(r.length for r in rows) // 1024) + 2


def test_whole_table(spark):
    """Ids of all texts are the tokenizer's, and sequences are about as few as their tokens could fill."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    rows = packing.pack(docs).collect()
    pieces = {(r.doc_id, r.piece): r for r in rows}
    for doc in docs.collect():
        ids = plain_ids(doc.text)
        for piece, (start, length) in enumerate(packing.cuts(len(ids), 1024)):
            crc = zlib.crc32(np.array(ids[start : start + length], "<u4").tobytes())
            r = pieces.pop((doc.doc_id, piece))
            assert (r.start, r.length, r.ids_crc32) == (start, length, crc)
    assert not pieces
    bound = -(-sum(r.length for r in rows) // 1024)
    assert bound <= len({r.sequence_id for r in rows}) <= bound + 2


def test_empty(documents):
    assert packing.pack(documents([])).count() == 0
