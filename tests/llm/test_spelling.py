"""Spelling variants against a plain version, and rows that are out of the ordinary."""

import random
import re
from collections import Counter
from zlib import crc32

import pytest
from pyspark.sql import functions as F

from cohortloom.llm import spelling

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})


def plain_counts(pairs, drop_every=199):
    found = Counter()
    for doc_id, text in pairs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            word = run.translate(LOWER)
            h = crc32(f"{'' if doc_id is None else doc_id}:{word}".encode())
            if drop_every and h % drop_every == 0:
                place = h % len(word)
                word = word[:place] + word[place + 1 :]
            found[word] += 1
    return {w: n for w, n in found.items() if len(w) >= 6 and n >= 5}


def near(a, b):
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b, strict=True)) == 1
    short, long = sorted((a, b), key=len)
    return len(long) - len(short) == 1 and any(long[:i] + long[i + 1 :] == short for i in range(len(long)))


def plain_groups(counts):
    out = {}
    form = {}
    for word, n in counts.items():
        others = [w for w in counts if w != word and near(w, word)]
        best = min(others, key=lambda w: (-counts[w], w), default=None)
        form[word] = best if best and counts[best] >= 5 * n else None
        out[word] = (n, len(others), counts[form[word]] if form[word] else None)
    result = {}
    for word in counts:
        root = word
        while form[root]:
            root = form[root]
        result[word] = (form[word], root, *out[word])
    return result


def found(df):
    return {r["word"]: (r["form"], r["root"], r["n"], r["n_near"], r["form_n"]) for r in df.collect()}


@pytest.fixture(scope="module")
def vocabulary():
    pick = random.Random(7)
    words = ["aaaaaa", "aaaaaaa", "aaaaaaaa", "bookkeeper", "bokkeeper", "x" * 3000, "x" * 2999, "größere", "größerer", "großere"]
    stems = ["".join(pick.choice("abcéü") for _ in range(pick.randint(6, 9))) for _ in range(60)]
    for stem in stems:
        place = pick.randrange(len(stem))
        words += [stem, stem[:place] + "a" + stem[place:], stem[:place] + stem[place + 1 :], stem[:place] + "b" + stem[place + 1 :]]
    # Chains: each form is at least five times as frequent as its variant.
    chain = {"abcdefg": 5, "abcdefh": 25, "abcdeih": 125, "abcjeih": 625, "abcdefk": 25}
    counts = {w: pick.choice([5, 6, 7, 30, 31, 200]) for w in words if len(w) >= 6}
    return {**counts, **chain}


def test_groups_match_plain_version(spark, vocabulary):
    words = spark.createDataFrame(list(vocabulary.items()), "word string, n bigint")
    assert found(spelling.spelling_groups(words)) == plain_groups(vocabulary)


def test_more_shards_than_prefixes(spark, vocabulary):
    words = spark.createDataFrame(list(vocabulary.items()), "word string, n bigint")
    spark.conf.set("spark.sql.shuffle.partitions", "40")
    try:
        assert found(spelling.spelling_groups(words)) == plain_groups(vocabulary)
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", "8")


def test_counts_match_plain_version(spark, documents):
    pick = random.Random(3)
    stock = ["Straßen", "HÄUSER", "façade×s", "window", "windows", "short", "naïveté", "mañanas", "łodzianin"]
    texts = [(i, " ".join(pick.choice(stock) for _ in range(40)) + ".\n" + pick.choice(stock)) for i in range(30)]
    pairs = [*texts, (5, None), (None, "window " * 9), (None, "window " * 9), (6, ""), (7, "word" * 200_000), (8, "windows1windows")]
    docs = documents(pairs).withColumn("n", F.lit("clash")).withColumn("word", F.lit(1))
    for drop_every in (None, 3, 199):
        counts = spelling.word_counts(docs, drop_every=drop_every)
        assert {r["word"]: r["n"] for r in counts.collect()} == plain_counts(pairs, drop_every)


def test_no_words(spark, documents):
    for pairs in ([], [(1, None), (2, "")]):
        assert spelling.spelling_groups(spelling.word_counts(documents(pairs))).collect() == []
