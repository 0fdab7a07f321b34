import pytest
from pyspark.sql import functions as F

from cohortloom.operators.runlog import best_run, latest_per_key, model_version, recent_runs, valid_metrics

NAN, INF = float("nan"), float("inf")


def test_valid_metrics(spark):
    df = spark.createDataFrame(
        [("a", 0.5), ("b", NAN), ("c", INF), ("d", -INF), ("e", None), ("f", 1.0)], "metric string, value double"
    )
    assert [r["metric"] for r in valid_metrics(df).orderBy("metric").collect()] == ["a", "f"]


@pytest.fixture(scope="module")
def runs(spark):
    return spark.createDataFrame(
        [("r1", "auc", 0.85, 1), ("r2", "auc", 0.9, 2), ("r3", "auc", 0.82, 3), ("r4", "auc", NAN, 4),
         ("r5", "auc", 0.9, 9), ("r1", "f1", 0.1, 1)],
        "run_id string, metric string, value double, start_time long",
    )


def test_best_run(runs):
    assert best_run(runs.filter("run_id <> 'r5'"), "auc").first()["run_id"] == "r2"
    assert best_run(runs, "auc").first()["run_id"] == "r5"  # the newest of equals
    assert best_run(runs, "auc", ascending=True).first()["run_id"] == "r3"
    assert best_run(runs, "absent").count() == 0


def test_recent_runs(spark):
    df = spark.createDataFrame(
        [("a", 1, "active", "x"), ("b", 3, "active", "x"), ("c", 2, "deleted", "x"), ("d", 4, "active", "y")],
        "run_id string, start_time long, lifecycle_stage string, experiment_id string",
    )

    def names(*args, **kwargs):
        return [r["run_id"] for r in recent_runs(df, *args, **kwargs).collect()]

    assert names(2) == ["d", "b"] and names() == ["d", "b", "a"] and names(experiment="x") == ["b", "a"]
    assert [r["run_id"] for r in recent_runs(df.drop("lifecycle_stage")).collect()] == ["d", "b", "c", "a"]
    metric = df.withColumns({"metric": F.lit("auc"), "value": F.col("start_time").cast("double")})
    assert best_run(metric, "auc").first()["run_id"] == "d"
    assert best_run(metric, "auc", experiment="x").first()["run_id"] == "b"
    assert best_run(metric, "auc", ascending=True).first()["run_id"] == "a"


def test_versions_compare_as_numbers(spark):
    df = spark.createDataFrame(
        [("m", "9", "Production"), ("m", "10", "Staging"), ("k", "2", "Production")],
        "name string, version string, stage string",
    )
    assert {r["name"]: r["version"] for r in latest_per_key(df).collect()} == {"m": "10", "k": "2"}
    assert model_version(df, "m").first()["version"] == "10"
    assert model_version(df, "m", stage="Production").first()["version"] == "9"
    assert model_version(df, "m", version="9").first()["stage"] == "Production"
    with pytest.raises(ValueError, match="No versions found in stage 'Archived' for model m"):
        model_version(df, "m", stage="Archived")
    with pytest.raises(ValueError, match="No versions found"):
        model_version(df, "absent")


def test_versions_that_tie_or_are_no_numbers(spark):
    rows = [("m", "9", "a"), ("m", "09", "b"), ("m", "x", "c"), ("n", "y", "d"), ("n", "z", "e")]
    df = spark.createDataFrame(rows, "name string, version string, stage string")
    assert {r["name"]: r["version"] for r in latest_per_key(df).collect()} == {"m": "9", "n": "z"}
