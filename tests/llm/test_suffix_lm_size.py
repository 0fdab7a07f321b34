"""What a Python worker of the suffix tree takes, in a session of its own, as a worker's peak holds for its whole life."""

import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[2]
SCRIPT = """
import resource, sys
from pyspark.sql import functions as F
from cohortloom.llm.suffix_lm import suffix_tree_scores
from cohortloom.session import build_session

spark = build_session("size", "local[1]", **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false", "spark.sql.warehouse.dir": sys.argv[1]})
word = "concat('w', cast(exp(pmod(xxhash64(id, i), 1000000) / 1e6 * 11) AS int))"
texts = f"array_join(transform(sequence(1, 200), i -> {word}), ' ')"
docs = spark.range(0, 20000, 1, 1).selectExpr("id AS doc_id", f"{texts} AS text")
rows = suffix_tree_scores(docs, F.col("doc_id") % 7 == 2)
assert rows.agg(F.sum("n_tokens")).first()[0] == 20000 * 201

def peak(batches):
    for batch in batches:
        yield batch.assign(id=resource.getrusage(resource.RUSAGE_SELF).ru_maxrss // 1024)

print("PEAK", spark.range(1).mapInPandas(peak, "id bigint").first()[0])
"""


def test_a_worker_stays_small(tmp_path):
    env = os.environ | {"PYTHONPATH": str(REPO)}
    run = subprocess.run([sys.executable, "-c", SCRIPT, str(tmp_path)], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    assert "PEAK" in run.stdout, run.stderr[-2000:]
    assert int(run.stdout.split("PEAK")[1]) < 410  # 492 with blocks of 1.5 million tokens and keys of 64 bits, 329 as it is
