"""The pipeline against plain versions of its stages."""

import corpus_pipeline
from test_decontaminate import plain as plain_hits
from test_exact import plain as plain_groups
from test_packing import plain_ids
from test_simhash import plain_components

from cohortloom.llm import quality

FOLDER = "/root/testdata/sf0.001"


def test_stages_and_run(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet")
    items = [(r.item_id, r.text) for r in spark.read.parquet(f"{FOLDER}/benchmark.parquet").collect()]
    model = quality.fit(docs, spark.read.parquet(f"{FOLDER}/labels.parquet"))
    good = {r.doc_id for r in quality.quality_scores(docs, model).filter("predicted = 1").collect()}
    left = {r.doc_id: r.text for r in docs.collect() if r.doc_id in good}
    left = {r[0]: left[r[0]] for r in plain_groups(list(left.items())) if r[3]}
    left = {i: left[i] for i in set(plain_components(list(left.items())).values())}
    left = {r[0]: left[r[0]] for r in plain_hits(list(left.items()), items) if not r[5]}
    tokens = {}
    for r in corpus_pipeline.run(spark, FOLDER).collect():
        tokens[r.doc_id] = tokens.get(r.doc_id, 0) + r.length
    assert tokens == {i: len(plain_ids(t)) for i, t in left.items()}
    assert 0 < len(left) < docs.count()


def test_columns_pass_through(spark):
    docs = spark.read.parquet(f"{FOLDER}/documents.parquet").withColumnsRenamed({"lang": "fp", "source": "_norm"})
    for _, stage in corpus_pipeline.STAGES[:-1]:
        out = stage(spark, docs, FOLDER)
        assert out.dtypes == docs.dtypes
        assert out.exceptAll(docs).count() == 0
