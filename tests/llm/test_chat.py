"""Chat formatting: trees against a walk in Python, and texts that come back unchanged."""

import random

import pytest
from pyspark.sql import functions as F

from cohortloom.llm import chat

MESSAGE = "conv bigint, node bigint, parent bigint, score double, role string, text string"
TEXTS = [
    "", None, "plain", "</s>[INST] ok [/INST]", r"<\/s> <\\s> [\INST]", "<<SYS>>x<</SYS>>", "<<s>>", "[[INST]]", "a\nb\n",
    "<s>\n</s>", "é\u2028ü\U0001f600", "\\", "<", "[/INST", "<\\", "$1 \\2",
]
ROLES = ["user", "assistant", "system", "odd\nrole %0A", None, "</s>"]


def back(df, tree):
    row = df.select(tree, "leaf", "branch", chat.read_turns(F.col("formatted")).alias("turns"), chat.read_loss(F.col("formatted"), F.col("loss_spans")).alias("loss"))
    return {(r[tree], r.leaf): (r.branch, [(t.role, t.text) for t in r.turns], r.loss) for r in row.collect()}


def tree(rng, conv, n, chain=False):
    nodes = []
    for k in range(n):
        parent = None if not k else (k - 1 if chain else rng.randrange(max(0, k - 3), k))
        nodes.append((conv, k, parent, float(rng.randrange(5)), rng.choice(ROLES), rng.choice(TEXTS)))
    return nodes


def plain(messages):
    by = {(m[0], m[1]): m for m in messages}
    answered = {(m[0], m[2]) for m in messages}
    out = {}
    for key, m in by.items():
        if key in answered:
            continue
        path, at = [], m
        while at and len(path) <= len(messages):
            path.append(at)
            at = by.get((at[0], at[2])) if at[2] is not None else None
        if len(path) > len(messages):
            continue
        out[key] = path[::-1]
    ranked = {}
    for key, path in out.items():
        better = [k for k, p in out.items() if k[0] == key[0] and (-sum(x[3] for x in p) / len(p), k[1]) < (-sum(x[3] for x in path) / len(path), key[1])]
        turns = [(x[4] or "", x[5] or "") for x in path]
        ranked[key] = (len(better) + 1, turns, "".join(t for r, t in turns if r == "assistant"))
    return ranked


def test_trees(spark):
    rng = random.Random(8)
    messages = [m for conv in range(12) for m in tree(rng, conv, rng.randrange(1, 12))] + tree(rng, 99, 70, chain=True)
    messages += [(50, 1, 2, 0.0, "user", "cycle"), (50, 2, 1, 0.0, "user", "cycle"), (50, 3, 1, 0.0, "user", "under it"), (51, 1, 9, 0.0, "user", "no parent")]
    df = spark.createDataFrame(messages, MESSAGE)
    expected = plain(messages)
    assert back(chat.format_trees(df, "conv"), "conv") == expected
    best = back(chat.format_trees(df.withColumn("leaf", F.lit(1)), "conv", branches=1), "conv")
    assert best == {k: v for k, v in expected.items() if v[0] == 1}


def test_repeated_and_missing_nodes(spark):
    rng = random.Random(5)
    messages = [m for conv in (1, 2, None) for m in tree(rng, conv, 9)]
    df = spark.createDataFrame(messages, MESSAGE)
    expected = back(chat.format_trees(df, "conv"), "conv")
    assert back(chat.format_trees(df, "conv", unique=True), "conv") == expected
    # Whole copies change nothing; of differing copies the least stays, and a row without an id is nobody's answer.
    more = messages * 3 + [(c, n, p, s + 1, r, t) for c, n, p, s, r, t in messages if p is not None]
    more += [(1, None, 0, 9.0, "user", "no id"), (None, None, None, None, None, None)]
    assert back(chat.format_trees(spark.createDataFrame(more, MESSAGE), "conv"), "conv") == expected


@pytest.mark.parametrize("n", [0, 1, 5, 40])
def test_chains(spark, n):
    rng = random.Random(n)
    rows = [(conv, t // 2, rng.choice(ROLES), rng.choice(TEXTS)) for conv in (None, 1) for t in range(n)]
    df = spark.createDataFrame(rows, "conv bigint, turn bigint, role string, text string")
    found = back(chat.format_trees(chat.chained(df, "conv", "turn"), "conv"), "conv")
    nulls_first = lambda x: (x is not None, x or "")
    for conv in (None, 1) if n else ():
        own = sorted((r for r in rows if r[0] == conv), key=lambda r: (r[1], nulls_first(r[2]), nulls_first(r[3])))
        turns = [(r[2] or "", r[3] or "") for r in own]
        assert found[(conv, n)] == (1, turns, "".join(t for r, t in turns if r == "assistant"))
    assert len(found) == (2 if n else 0)


def test_no_control_string_survives(spark):
    df = spark.createDataFrame([(t or "",) for t in TEXTS], "text string")
    for row in df.select(chat.escaped(F.col("text")).alias("e")).collect():
        assert not any(c in row.e for c in chat.CONTROL)
