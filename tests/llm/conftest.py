import sys
from pathlib import Path

import pytest

sys.path.insert(0, str(Path(__file__).resolve().parents[1]))

ROWS = "doc_id bigint, text string, lang string, source string, n_chars bigint"


@pytest.fixture
def documents(spark):
    """A documents table from (id, text) pairs."""

    def build(pairs):
        rows = [(i, t, "en", "src0", None if t is None else len(t)) for i, t in pairs]
        return spark.createDataFrame(rows, ROWS)

    return build
