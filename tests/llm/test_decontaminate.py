"""Decontamination against a scan of all windows in Python."""

import random
import re

import numpy as np
import pytest

from cohortloom.llm import decontaminate, words
from cohortloom.llm.common import FILTER_BITS, filter_bits, in_filter

WORD = re.compile("[^\x00-\x2f\x3a-\x60\x7b-\x7f]+")


def split(text):
    return WORD.findall(re.sub("[A-Z]", lambda m: m[0].lower(), text or ""))


def plain(docs, items):
    out = []
    for i, text in docs:
        ws, hit, found = split(text), set(), set()
        for item, other in items:
            parts = split(other)
            size = min(10, len(parts))
            runs = {tuple(parts[a : a + size]) for a in range(len(parts) - size + 1)} if size else set()
            for a in range(len(ws) - size + 1) if size else ():
                if tuple(ws[a : a + size]) in runs:
                    hit |= set(range(a, a + size))
                    found |= {str(item)} if item is not None else set()
        out.append((i, len(ws), len(hit), len(found), sorted(found), bool(hit)))
    return out


def corpus():
    rng = random.Random(5)
    pool = ["Alpha", "beta", "GAMMA", "déjà", "e5", "zeta", "Ñu"]
    run = lambda n: [rng.choice(pool) for _ in range(n)]
    items = [(k, " ".join(run(n))) for k, n in enumerate((10, 11, 14, 30, 9, 3, 12))]
    items += [(7, None), (8, " ... "), (2, items[2][1]), (None, " ".join(run(12)))]
    docs = [(100 + k, ", ".join(run(rng.randrange(120)))) for k in range(60)]
    for k in range(30):
        part = split(rng.choice(items[:7])[1])
        a = rng.randrange(len(part))
        docs.append((200 + k, " ".join([*run(rng.randrange(12)), *part[a : a + 12].copy(), *run(rng.randrange(12))]).upper()))
    docs += [(300, None), (301, ""), (302, "  ..  "), (100, "beta"), (None, items[3][1]), (303, "x " * 3000 + items[0][1])]
    return docs, items


def found(spark, documents, docs, items):
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    rows = decontaminate.contaminated_words(documents(docs), bench)
    return sorted((tuple(r) for r in rows.collect()), key=str)


@pytest.mark.parametrize("segment", [words.SEGMENT, 37])
def test_against_all_windows(monkeypatch, spark, documents, segment):
    monkeypatch.setattr(words, "SEGMENT", segment)
    docs, items = corpus()
    assert found(spark, documents, docs, items) == sorted(plain(docs, items), key=str)


def test_long_items_only(spark, documents):
    docs, items = corpus()
    items = [x for x in items if len(split(x[1])) >= 10]
    assert found(spark, documents, docs, items) == sorted(plain(docs, items), key=str)


def test_empty_tables(spark, documents):
    assert found(spark, documents, [], [(1, "a b")]) == []
    assert found(spark, documents, [(1, "a b")], []) == [(1, 2, 0, 0, [], False)]


def test_clean_documents_stay(spark, documents):
    docs, items = corpus()
    bench = spark.createDataFrame(items, "item_id bigint, text string")
    kept = decontaminate.decontaminate(documents(docs), bench)
    hit = {r[0] for r in plain(docs, items) if r[5]} - {None}
    assert sorted(r.doc_id for r in kept.collect() if r.doc_id is not None) == sorted(i for i, _ in docs if i is not None and i not in hit)


def test_filter_holds_what_went_in(spark):
    hashes = np.concatenate((np.zeros(1, np.uint64), np.random.default_rng(1).integers(0, 1 << 63, 999).astype(np.uint64) * np.uint64(2)))
    table = spark.createDataFrame([(int(h),) for h in hashes.view(np.int64)], "hash bigint")
    bits = filter_bits(table, "hash")
    assert in_filter(bits, hashes).all()
    assert np.unpackbits(bits).sum() == len(np.unique(hashes & np.uint64(FILTER_BITS - 1)))
