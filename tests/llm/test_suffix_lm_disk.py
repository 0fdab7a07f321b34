"""What the suffix tree leaves on disk from step to step, in a session of its own, as shuffle files belong to a session."""

import os
import subprocess
import sys
from pathlib import Path

REPO = Path(__file__).resolve().parents[2]
SCRIPT = """
import sys, time
from pathlib import Path
from pyspark.sql import functions as F
from cohortloom.llm import suffix_lm
from cohortloom.session import build_session

stored, local, setting = Path(sys.argv[1], "stored"), Path(sys.argv[1], "local"), "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
folders = {"spark.checkpoint.dir": str(stored), "spark.local.dir": str(local), "spark.sql.warehouse.dir": sys.argv[1]}
spark = build_session("disk", "local[2]", **folders, **{"spark.sql.shuffle.partitions": "4", "spark.ui.enabled": "false"})
before = spark.conf.get(setting)

def held(folder, pattern="*"):
    return sum(f.stat().st_size for f in folder.rglob(pattern) if f.is_file())

def answered(*args, plain=suffix_lm._answered):
    out = plain(*args)
    end = time.time() + 10  # Spark deletes in the background
    while held(local, "shuffle_*") and time.time() < end:
        time.sleep(0.1)
    print("SHUFFLED", held(local, "shuffle_*"))
    print("STORED", held(stored))
    return out

suffix_lm._answered = answered
word = "concat('w', cast(exp(pmod(xxhash64(id, i), 1000000) / 1e6 * 14) AS int))"
texts = f"array_join(transform(sequence(1, 200), i -> {word}), ' ')"
docs = spark.range(0, 5000, 1, 1).selectExpr("id AS doc_id", f"{texts} AS text")
rows = suffix_lm.suffix_tree_scores(docs, F.col("doc_id") % 7 == 2)
assert rows.agg(F.sum("n_tokens")).first()[0] == 5000 * 201
assert spark.conf.get(setting) == before
print("LEFT", sum(1 for f in stored.iterdir() if f.name.startswith("lm-")))
"""


def test_words_and_shuffles_go_when_they_are_used_up(tmp_path):
    env = os.environ | {"PYTHONPATH": str(REPO)}
    run = subprocess.run([sys.executable, "-c", SCRIPT, str(tmp_path)], env=env, cwd=tmp_path, capture_output=True, text=True, timeout=300)
    said = [line.split() for line in run.stdout.splitlines()]
    assert ["LEFT", "0"] in said, run.stderr[-2000:]
    assert {int(x[1]) for x in said if x[0] == "SHUFFLED"} == {0}
    stored = [int(x[1]) for x in said if x[0] == "STORED"][-1]
    assert stored < 5000 * 201 * 2.5  # bytes a token: 3.5 when words and codes of words stayed to the end, 1.1 as it is
