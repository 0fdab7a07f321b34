"""Stages drop rows, not ids: rows without an id, repeated rows, and one id with a clean and a dropped text."""

import pytest

from cohortloom.llm import decontaminate, exact, simhash

ITEM = "one two three four five six seven eight nine ten"


def left(df):
    return sorted(((r.doc_id, r.text) for r in df.collect()), key=str)


@pytest.mark.parametrize("stage", [exact.exact_dedup, simhash.near_dedup])
def test_copies(documents, stage):
    pairs = [(1, "a b c d"), (1, "a b c d"), (None, "a b c d"), (2, "a b c d"), (2, "e f g h"), (None, "x y z w"), (None, "x y z w")]
    assert left(stage(documents(pairs))) == [(1, "a b c d"), (2, "e f g h"), (None, "x y z w")]


def test_decontaminate(spark, documents):
    bench = spark.createDataFrame([(1, ITEM)], "item_id bigint, text string")
    pairs = [(1, ITEM), (1, "clean"), (None, f"x {ITEM}"), (None, "clean too"), (2, "clean"), (2, "clean")]
    kept = left(decontaminate.decontaminate(documents(pairs), bench))
    assert kept == [(1, "clean"), (2, "clean"), (2, "clean"), (None, "clean too")]
