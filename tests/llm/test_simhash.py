"""SimHash groups against all pairs in Python."""

import random
import re

import numpy as np
import pytest
import xxhash
from pyspark.sql import functions as F

from cohortloom.llm import simhash
from cohortloom.llm.common import components


def plain_fingerprint(text):
    lowered = re.sub("[A-Z]", lambda m: m[0].lower(), text or "")
    words = re.findall(r"[^\x20\x09-\x0D]+", lowered)
    shingles = [" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or ([" ".join(words)] if words else [])
    hashes = [xxhash.xxh64(s.encode(), 42).intdigest() for s in shingles]
    return sum(1 << b for b in range(64) if sum(h >> b & 1 for h in hashes) * 2 > len(hashes))


def plain_components(pairs):
    prints = [(i, plain_fingerprint(t)) for i, t in pairs]
    out = {}
    for i, _ in prints:
        if i in out:
            continue
        group, queue = {i}, [i]
        while queue:
            at = dict(prints)[queue.pop()]
            for j, other in prints:
                if j not in group and bin(at ^ other).count("1") <= 2:
                    group.add(j)
                    queue.append(j)
        out |= dict.fromkeys(group, min(group))
    return out


def corpus():
    rng = random.Random(7)
    words = [f"w{i}" for i in range(300)]
    base = [[rng.choice(words) for _ in range(400)] for _ in range(6)]
    pairs = [(0, None), (1, ""), (2, " \n "), (3, "One TWO"), (4, "one two"), (5, "one"), (6, "A b C"), (7, "É é x")]
    for k, text in enumerate(base):
        for j in range(12):
            copy = list(text)
            for _ in range(j // 3):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            pairs.append((100 + 20 * k + j, " ".join(copy)))
    return pairs


@pytest.mark.parametrize("part", [simhash.PART_BYTES, 64])
def test_fingerprint(monkeypatch, part):
    monkeypatch.setattr(simhash, "PART_BYTES", part)
    for _, text in corpus():
        assert simhash.fingerprint(text) == plain_fingerprint(text)


def test_groups(documents):
    pairs = corpus()
    rows = simhash.near_groups(documents(pairs)).collect()
    expected = plain_components(pairs)
    assert {r.doc_id: r.component_id for r in rows} == expected
    assert {r.doc_id: r.fp % 2**64 for r in rows} == {i: plain_fingerprint(t) for i, t in pairs}
    kept = simhash.near_dedup(documents(pairs).withColumn("fp", F.lit("mine")))
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(expected.values()))
    assert kept.columns[-1] == "fp"


def test_empty_and_repeated(documents):
    assert simhash.near_groups(documents([])).count() == 0
    rows = simhash.near_groups(documents([(4, "a b"), (4, "a b"), (None, "a b"), (None, "c d e f")])).collect()
    assert sorted((str(r.doc_id), str(r.component_id)) for r in rows) == [
        ("4", "4"), ("4", "4"), ("None", "4"), ("None", "None"),
    ]


@pytest.mark.parametrize("matrix", [256, 1])
def test_list_links(monkeypatch, matrix):
    monkeypatch.setattr(simhash, "MATRIX", matrix)
    rng = np.random.default_rng(3)
    values = np.unique(rng.integers(0, 1 << 16, 200).astype(np.uint64) | np.uint64(0xABCDEF0123450000))
    a, b = simhash.list_links(values)
    near = {(int(x), int(y)) for x in values for y in values if x < y and int(x ^ y).bit_count() <= 2}

    def roots(pairs):
        root = {int(v): int(v) for v in values}
        for _ in range(len(values)):
            for x, y in pairs:
                root[x] = root[y] = min(root[x], root[y])
        return root

    assert roots({(int(x), int(y)) for x, y in zip(a, b, strict=True)}) == roots(near)


def test_components_of_a_chain(spark):
    edges = spark.range(300).selectExpr("id + 1 AS a", "id AS b").unionAll(spark.sql("SELECT 1000L a, 1001L b"))
    assert {r.node: r.root for r in components(edges).collect()} == {**dict.fromkeys(range(1, 301), 0), 1001: 1000}
