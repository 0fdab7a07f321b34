"""The pipeline's near stage against a plain version, over rows that are out of the ordinary."""

import random

from test_simhash import plain_components

import corpus_pipeline


def corpus():
    rng = random.Random(3)
    words = [f"w{i}" for i in range(400)]
    pairs = [(0, None), (1, ""), (2, "one two"), (3, "One  TWO"), (4, "one three"), (5, " \n")]
    for k in range(8):
        base = [rng.choice(words) for _ in range(rng.choice([60, 300, 900]))]
        for j in range(14):
            copy = list(base)
            for _ in range(j * len(base) // 400):
                copy[rng.randrange(len(copy))] = rng.choice(words)
            pairs.append((100 + 20 * k + j, " ".join(copy)))
    return pairs


def test_one_of_each_component_stays(spark, documents):
    pairs = corpus()
    expected = plain_components(pairs)
    kept = corpus_pipeline.drop_near_copies(spark, documents(pairs), "")
    assert sorted(r.doc_id for r in kept.collect()) == sorted(set(expected.values()))
    assert len(set(expected.values())) < len(expected) - 20


def test_rows_without_ids_repeated_rows_and_no_rows(spark, documents):
    one, other = "some words that are the same here", "quite different words stand in this text"
    rows = [(None, one), (7, one), (7, one), (8, other), (None, other + " now"), (None, "alone among all of these")]
    kept = corpus_pipeline.drop_near_copies(spark, documents(rows), "").collect()
    assert sorted((r.doc_id or -1, r.text) for r in kept if r.text == one) == [(7, one)]
    assert sum(r.text == "alone among all of these" for r in kept) == 1
    assert corpus_pipeline.drop_near_copies(spark, documents([]), "").collect() == []
