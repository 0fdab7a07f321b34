"""Exact deduplication against a plain grouping in Python."""

import hashlib
import re

import pytest
from pyspark.sql import functions as F

from cohortloom.llm import exact

LONG = "word " * 50_000
CASES = [
    (3, "a  b\tc"), (1, "a b c"), (2, "a b c"), (7, None), (5, ""), (9, LONG), (8, LONG + " "), (4, LONG + "x"),
    (11, "a b d"), (12, " a b c"), (13, " "), (14, " "), (15, "\n\n"), (16, "p" * 200 + "q"), (17, "p" * 200 + "r"),
]


def plain(pairs):
    groups = {}
    for i, t in pairs:
        groups.setdefault(re.sub(r"[\x20\x09-\x0D]+", " ", t or ""), []).append(i)
    out = []
    for norm, ids in groups.items():
        digest = hashlib.sha256(norm.encode()).hexdigest()
        out += [(i, min(ids), len(ids), i == min(ids), digest) for i in ids]
    return sorted(out)


def found(docs):
    rows = exact.exact_groups(docs, extra={"sha": F.sha2("_norm", 256)})
    return [tuple(r) for r in rows.select("doc_id", "keep_id", "group_size", "kept", "sha").collect()]


@pytest.mark.parametrize("cases", [CASES, [], [(1, "only")], [(i, "same") for i in range(500)]])
def test_groups(documents, cases):
    assert sorted(found(documents(cases))) == plain(cases)


def test_repeated_and_missing_ids(documents):
    rows = found(documents([(1, "x"), (1, "x"), (None, "x"), (None, "y"), (None, "y"), (2, "z")]))
    assert sum(r[3] for r in rows) == 3
    assert {(r[1], r[2]) for r in rows} == {(1, 3), (None, 2), (2, 1)}


def test_dedup_keeps_columns(documents):
    docs = documents(CASES).withColumn("_word", F.lit(1)).withColumn("keep_id", F.lit("c"))
    kept = exact.exact_dedup(docs.drop("_word"))
    assert kept.columns == docs.drop("_word").columns
    assert sorted(r.doc_id for r in kept.collect()) == sorted({r[1] for r in plain(CASES)})
