"""Substring deduplication against all strings of 50 bytes in Python."""

import hashlib
import random

import numpy as np
import pytest

from cohortloom.llm import suffix


def plain(pairs):
    least = {}
    order = lambda i: float("inf") if i is None else i
    texts = [(order(i), (t or "").encode()) for i, t in pairs]
    for i, data in texts:
        for s in range(len(data) - 49):
            key = data[s : s + 50]
            least[key] = min(least.get(key, i), i)
    out = []
    for (i, data), (name, _) in zip(texts, pairs, strict=True):
        gone = np.zeros(len(data) + 1, bool)
        for s in range(len(data) - 49):
            if least[data[s : s + 50]] < i:
                gone[s : s + 50] = True
        runs = int(np.count_nonzero(np.diff(np.concatenate(([False], gone)).astype(int)) == 1))
        kept = bytes(b for b, g in zip(data, gone, strict=False) if not g)
        out.append((name, len(data), int(gone.sum()), runs, hashlib.sha256(kept).hexdigest()))
    return sorted(out, key=str)


def corpus(seed):
    rng = random.Random(seed)
    word = lambda: "".join(rng.choice(["th", "en", "é", "or", "ing", "a"]) for _ in range(rng.randrange(1, 5)))
    run = lambda n: " ".join(word() for _ in range(n))
    shared = [run(n) for n in (8, 12, 20, 40, 80)]
    pairs = []
    for k in range(50):
        parts = [run(rng.randrange(12)) for _ in range(3)]
        parts.insert(rng.randrange(4), rng.choice(shared))
        pairs.append((k * 3, " ".join(parts)))
    for k in range(25):
        text = list(rng.choice(pairs)[1])
        for _ in range(rng.randrange(4)):
            if text:
                text[rng.randrange(len(text))] = rng.choice("xyz")
        pairs.append((rng.randrange(160), "".join(text)))
    pairs += [(200, None), (201, ""), (202, "a" * 49), (203, "a" * 50), (1, "a" * 400), (204, "ab" * 90 + "a" * 60)]
    pairs += [(None, shared[4]), (None, shared[4]), (5, shared[3]), (5, shared[3]), (7, shared[3] * 2)]
    rng.shuffle(pairs)
    return pairs


def found(df):
    return sorted((tuple(r) for r in df.collect()), key=str)


@pytest.mark.parametrize(("seed", "segment", "gather", "hot"), [(1, suffix.SEGMENT, 1 << 21, 2000), (2, 64, 1 << 21, 2000), (3, suffix.SEGMENT, 64, 1), (4, 333, 16, 0)])
def test_against_all_strings(monkeypatch, documents, seed, segment, gather, hot):
    for name, value in (("SEGMENT", segment), ("GATHER", gather), ("HOT_CONTEXTS", hot)):
        monkeypatch.setattr(suffix, name, value)
    pairs = corpus(seed)
    assert found(suffix.suffix_dedup(documents(pairs))) == plain(pairs)


def test_empty_table(documents):
    assert found(suffix.suffix_dedup(documents([]))) == []


@pytest.mark.parametrize("seed", range(6))
def test_deep_shallow_order(seed):
    rng = random.Random(seed)
    data = bytes(rng.choice(b"ab" if seed % 2 else b"abcdefgh") for _ in range(400)) + b"a" * 120 + bytes([0, 255]) * 60
    data += data[30:150]
    suffixes = list(range(len(data) - suffix.SPAN + 1))
    rng.shuffle(suffixes)
    groups = list(suffix.deep_shallow(data, suffixes))
    heads = [{data[s : s + 50] for s in g} for g in groups]
    assert all(len(h) == 1 for h in heads) and sum(map(len, groups)) == len(suffixes)
    flat = [h.pop() for h in heads]
    assert flat == sorted(set(flat))
