"""The rule ensemble: held-out accuracy, compiled rules against the forest's paths, odd inputs."""

import binascii
import math
import re
import string

import pytest
from pyspark.sql import functions as F

from cohortloom.llm import quality
from cohortloom.llm.queries import QUERIES

FOLDER = "/root/testdata/sf0.01"


def test_held_out_accuracy(spark):
    scores = QUERIES["op5_quality"](spark, FOLDER)
    joined = scores.join(spark.read.parquet(f"{FOLDER}/labels.parquet"), "doc_id").filter("held_out").collect()
    assert sum(r.predicted == r.quality for r in joined) / len(joined) > 0.95
    pairs = [(a.score, b.score) for a in joined if a.quality for b in joined if not b.quality]
    assert sum(a > b for a, b in pairs) / len(pairs) > 0.97
    rows = scores.collect()
    assert len(rows) == spark.read.parquet(f"{FOLDER}/documents.parquet").count()
    assert all(0 <= r.score <= 1 and r.predicted == (r.score >= 0.7) for r in rows)
    assert all(r.held_out == (binascii.crc32(str(r.doc_id).encode()) % 4 == 2) for r in rows)


def test_rules_of_a_tree():
    text = """RandomForestClassificationModel: uid=x
  Tree 0 (weight 1.0):
    If (feature 1 <= 0.5)
     If (feature 0 <= 2.0)
      Predict: 0.0
     Else (feature 0 > 2.0)
      Predict: 1.0
    Else (feature 1 > 0.5)
     Predict: 1.0
"""
    low, high = float("-inf"), float("inf")
    assert {r.ranges for r in quality.tree_rules(text)} == {
        ((1, low, 0.5),), ((0, low, 2.0), (1, low, 0.5)), ((0, 2.0, high), (1, low, 0.5)), ((1, 0.5, high),),
    }


def test_statistics(spark):
    df = spark.createDataFrame([("Ab ab ab!\n\nAb  #1",), ("",), (None,)], "text string")
    first, *rest = df.select(quality.measured(F.col("text")).alias("s")).select("s.*").collect()
    assert (first.distinct_words, first.distinct_lines) == (pytest.approx(4 / 5), 1.0)
    assert first.upper == pytest.approx(2 / 17) and first.digits == pytest.approx(1 / 17)
    assert all(v == 0 for r in rest for v in r)


def plain_statistics(text):
    """The twelve statistics, counted character by character."""
    text = text or ""
    words = [w for w in re.split(r"[\x20\x09-\x0D]+", text) if w]
    rows = [line for line in text.split("\n") if line]
    chars = len(text)

    def share(of, whole):
        return of / whole if whole else 0.0

    def kind(characters):
        return share(sum(c in characters for c in text), chars)

    return {
        "log_chars": math.log1p(chars),
        "log_words": math.log1p(len(words)),
        "word_chars": share(chars, len(words)),
        "line_words": share(len(words), len(rows)),
        "beyond_ascii": share(len(text.encode()) - chars, chars),
        "upper": kind(string.ascii_uppercase),
        "digits": kind(string.digits),
        "stops": kind(".,;:"),
        "marks": kind("!?"),
        "symbols": kind("#$%&*+/<=>@\\^_`{|}~()[]-"),
        "distinct_words": share(len(set(words)), len(words)),
        "distinct_lines": share(len(set(rows)), len(rows)),
    }


def test_scores_equal_plain_ones(spark, documents):
    """Statistics, rules, weights and the logistic function, all again in Python, for every document."""
    small = "/root/testdata/sf0.001"
    docs = spark.read.parquet(f"{small}/documents.parquet")
    model = quality.fit(docs, spark.read.parquet(f"{small}/labels.parquet"))
    assert len(model.weighted) > 5
    odd = [(-1, None), (-2, ""), (-3, " \n\t\n"), (-4, "É\U0001f600 é!?\n\nA-b [c] 12"), (-5, "a\\b " * 20_000)]
    every = docs.select("doc_id", "text").union(documents(odd).select("doc_id", "text"))
    texts = {r.doc_id: r.text for r in every.collect()}
    for r in quality.quality_scores(every, model).collect():
        stats = plain_statistics(texts[r.doc_id])
        total = model.intercept
        for rule, weight in model.weighted:
            if all(low < stats[model.names[i]] <= high for i, low, high in rule.ranges):
                total += weight
        score = 1 / (1 + math.exp(-total))
        assert abs(r.score - score) < 1e-9 and r.predicted == (score >= 0.7), r.doc_id


@pytest.mark.parametrize("labels", [[], [(1, 1)], [(1, 0), (3, 0)], [(1, None)]])
def test_few_labels_and_odd_rows(spark, documents, labels):
    docs = documents([(1, "good text"), (3, None), (None, ""), (3, "x" * 300_000)]).withColumn("score", F.lit("mine"))
    model = quality.fit(docs, spark.createDataFrame(labels, "doc_id bigint, quality int"))
    rows = quality.quality_scores(docs, model).collect()
    assert len(rows) == 4 and all(0 < r.score < 1 for r in rows)
    kept = quality.keep_quality(docs, model)
    assert kept.columns == docs.columns and kept.count() in (0, 4)


def test_empty_table(spark, documents):
    model = quality.fit(documents([]), spark.createDataFrame([(1, 1)], "doc_id bigint, quality int"))
    assert quality.quality_scores(documents([]), model).count() == 0
