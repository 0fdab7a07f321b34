"""The suffix tree's scores against a plain version, and what they are for held-out texts."""

import math
import random
import re
from collections import Counter, defaultdict
from zlib import crc32

import numpy as np
import pytest
from pyspark.sql import functions as F

from cohortloom.llm import suffix_lm
from cohortloom.llm.queries import QUERIES

LOWER = str.maketrans({chr(65 + i): chr(97 + i) for i in range(26)})
END, RARE, START = object(), object(), object()
HELD = "crc32(CAST(CAST(doc_id AS STRING) AS BINARY)) % 7 = 2"


def is_held(doc_id):
    return doc_id is not None and crc32(str(doc_id).encode()) % 7 == 2


def plain_tokens(text):
    return [*re.findall(r"[^\x20\x09-\x0D]+", (text or "").translate(LOWER)), END]


def plain_model(texts, depth, min_count):
    """Base and model probability of each token of a text, as functions."""
    count = Counter(t for text in texts for t in text)
    n, v = sum(count.values()), len(count)
    own = {t for t, c in count.items() if c >= min_count} | {END}
    room, rare_room = n + v + 1, max(1, n + v + 1 - sum(count[t] + 1 for t in own))

    def symbols(text):
        return [t if t in own else RARE for t in text]

    follow = defaultdict(Counter)
    for text in texts:
        line = [START, *symbols(text)]
        for i in range(1, len(line)):
            for d in range(depth + 1):
                if i - d >= 0:
                    follow[tuple(line[i - d : i])][line[i]] += 1
    total = {c: sum(f.values()) for c, f in follow.items()}
    states = set()
    for context, f in follow.items():
        if not context or total[context] < min_count:
            continue
        suffix = context[1:]
        gain = sum(k * math.log((k / total[context]) / (follow[suffix][s] / total[suffix])) for s, k in f.items())
        if gain > 0.5 * len(f) * math.log(total[context]):
            states.add(context)

    def base(token):
        return (count[token] + 1) / room

    def chance(context, symbol):
        if not context:
            return rare_room / room if symbol is RARE else base(symbol)
        below = chance(context[1:], symbol)
        if context not in states:
            return below
        f = follow[context]
        return (f[symbol] + len(f) * below) / (total[context] + len(f))

    def score(text):
        line, out = [START, *symbols(text)], []
        for i, token in enumerate(text, 1):
            p = chance(tuple(line[max(0, i - depth) : i]), line[i])
            out.append(p * ((count[token] + 1) / rare_room if line[i] is RARE else 1))
        return out

    return count, base, score, states


def check(df, pairs, depth, min_count):
    train = [plain_tokens(t) for i, t in pairs if not is_held(i)]
    count, base, score, states = plain_model(train, depth, min_count)
    expected = sorted(
        (
            (-1 if i is None else i, is_held(i), len(ts := plain_tokens(t)), sum(count[x] > 0 for x in ts), sum(count.values()),
             sum(math.log10(base(x)) for x in ts), sum(map(math.log10, score(ts))))
            for i, t in pairs
        ),
    )
    found = sorted(tuple(-1 if k == 0 and x is None else x for k, x in enumerate(r)) for r in df.collect())
    assert [r[:5] for r in found] == [r[:5] for r in expected]
    for a, b in zip(found, expected, strict=True):
        assert a[5:] == pytest.approx(b[5:], rel=1e-9)
    return states


def corpus(seed, n=120):
    pick = random.Random(seed)
    stock = {lang: [f"{lang}{i}" for i in range(30)] for lang in ("de", "EN", "fr")}
    pairs = []
    for i in range(n):
        lang = pick.choice(list(stock))
        words = [pick.choice(stock[lang]) if pick.random() < 0.8 else f"rare{pick.randrange(500)}" for _ in range(pick.randint(0, 60))]
        pairs.append((i, pick.choice([" ", "\n", "\t \x0b"]).join(words)))
    same = "in the beginning was the word and the word was repeated"
    return [*pairs, *((1000 + i, same) for i in range(25)), (2000, None), (2001, ""), (2002, " \n "), (None, same), (5, same), (5, same)]


@pytest.mark.parametrize(("depth", "min_count", "block_tokens"), [(1, 5, 300), (2, 5, 300), (3, 8, 1 << 20), (2, 10_000, 300)])
def test_scores_match_plain_version(spark, documents, depth, min_count, block_tokens):
    pairs = corpus(depth)
    docs = documents(pairs).withColumn("block", F.lit("clash")).withColumn("held", F.lit(1)).withColumn("id", F.lit(0))
    df = suffix_lm.suffix_tree_scores(docs, F.expr(HELD), depth=depth, min_count=min_count, block_tokens=block_tokens)
    states = check(df, pairs, depth, min_count)
    assert max(map(len, states), default=0) == (0 if min_count == 10_000 else depth)


def test_long_text_and_nothing_to_learn_from(spark, documents):
    held = next(i for i in range(100) if is_held(i))
    long = " ".join(random.Random(1).choice(["a", "b", "ccc"]) for _ in range(300_000))
    for pairs in ([(0, long), (held, "a b zzz")], [(held, "a b"), (held, None)], []):
        check(suffix_lm.suffix_tree_scores(documents(pairs), F.expr(HELD)), pairs, suffix_lm.DEPTH, suffix_lm.MIN_COUNT)


def test_held_out_texts_are_likelier_than_by_single_tokens(spark):
    rows = QUERIES["op13_suffix_lm"](spark, "/root/testdata/sf0.01").filter("held_out")
    found = rows.agg(F.sum("score"), F.sum("base_score"), F.sum("n_tokens")).first()
    assert found[0] / found[2] > found[1] / found[2] + 0.05
    assert rows.filter("score > 0 OR isnan(score)").isEmpty()


def test_least_count_is_the_same_for_a_large_corpus(spark):
    short = spark.range(5100).selectExpr("id AS doc_id", "concat('zz', id % 100, ' yy', id % 100) AS text")
    long = spark.range(14).selectExpr("10000 + id", "repeat('a ', 1000000)")
    asked = spark.createDataFrame([(-1, "zz3 yy3")], short.schema)
    rows = suffix_lm.suffix_tree_scores(short.union(long).union(asked), F.col("doc_id") < 0)
    found = rows.filter("held_out").first()
    # Pairs of 51 occurrences are learned as they are beside 14 million other tokens.
    assert found["train_tokens"] > 14e6 and found["score"] > -3


def test_numbers_survive_packing():
    for values in ([], [0], [1, 2, 1 << 40], list(range(1000))):
        assert suffix_lm.unpack(suffix_lm.pack(np.array(values, np.uint64))).tolist() == values
