"""Physical plans: shuffles, pushed filters, pruned columns, no Python in the row path."""

import re

import pytest
from compare import TESTDATA
from test_oracles import entry

from registry import queries as Q

SMALL = str(TESTDATA / "sf0.001")


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def final_plan(df):
    df.collect()
    text = plan(df)
    return text.split("== Initial Plan ==")[0]


def test_wide_features_move_only_ring_states(spark):
    text = plan(entry.queries()["feat_wide"](spark, SMALL))
    assert text.count("Exchange") == 2
    assert text.count("FileScan") == 1
    assert "PushedFilters: [IsNotNull(ts), GreaterThanOrEqual(ts" in text
    assert "props" not in text


def test_plain_features_need_one_exchange(spark):
    from cohortloom.operators.features import conditional_features

    df = conditional_features(Q.prepared_events(spark, SMALL), Q.event_spec(Q.WIDE))
    assert plan(df).count("Exchange") == 1


def test_both_uses_of_counts_share_an_exchange(spark):
    text = final_plan(entry.queries()["ks_stat"](spark, SMALL))
    assert "ReusedExchange" in text
    assert text.count("FileScan") == 1


def test_metrics_read_their_input_once(spark):
    read = spark.sparkContext.accumulator(0)

    def count(rows):
        for row in rows:
            read.add(1)
            yield row

    scored = Q.scored_lineitem(spark, SMALL)
    watched = spark.createDataFrame(scored.rdd.mapPartitions(count), scored.schema)
    from cohortloom.operators.evaluate import monthly_performance

    monthly_performance(watched, "l_shipdate", "score", "label").collect()
    assert read.value == scored.count()


def test_validation_is_one_scan(spark):
    text = plan(entry.queries()["validation_report"](spark, SMALL))
    assert text.count("FileScan") == 1


def under(text, name):
    """For each node of this name in a plan, the names of the nodes below it, the nearest first."""
    lines = [(re.match(r"[\s|:+-]*", line).end(), re.sub(r"^[\s|:+-]*(\*\(\d+\) )?", "", line)) for line in text.splitlines()]
    found = []
    for i, (depth, node) in enumerate(lines):
        if node.startswith(name):
            below = []
            for other, what in lines[i + 1 :]:
                if other <= depth:
                    break
                below.append(what)
            found.append(below)
    return found


@pytest.mark.parametrize("name", ["monthly_auc", "ks_stat", "cv_summary", "drift_months"])
def test_a_window_in_one_task_only_follows_an_aggregate(spark, name):
    text = plan(entry.queries()[name](spark, SMALL))
    windows = under(text, "Window ")
    assert windows
    for below in windows:
        exchange = next((i for i, what in enumerate(below) if what.startswith("Exchange")), None)
        if exchange is not None and "SinglePartition" in below[exchange]:
            assert any("Aggregate" in what for what in below[exchange + 1 : exchange + 3]), below[:4]
    assert "CartesianProduct" not in text and "BroadcastNestedLoopJoin" not in text


@pytest.mark.parametrize("name", ["split_summary", "split_oot", "union_splits"])
def test_both_parts_come_from_one_scan(spark, name):
    assert plan(entry.queries()[name](spark, SMALL)).count("FileScan") == 1


def test_no_query_runs_python_per_row(spark):
    # Trees are grown and scored on whole batches.
    stored = {"train_leaderboard", "stacked_model", "varimp", "batch_predict", "feature_importance", "run_pipeline", "split_gains", "predict_registered"}
    for name, query in Q.QUERIES.items():
        if name not in stored:
            text = plan(query(spark, SMALL))
            assert "Python" not in text and "Pandas" not in text, name
