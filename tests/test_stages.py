import datetime as dt
import json
import random

import pytest
from pyspark.sql import functions as F

from cohortloom import PipelineSpec
from cohortloom.plans.pipeline import PipelineOptions, choose_features, run_pipeline
from cohortloom.operators.train import families
from cohortloom.plans.stages import MANIFEST, STAGE_ORDER, StageStore
from cohortloom.session import shared_folder


def test_stages_are_built_once(spark, tmp_path):
    store = StageStore(spark, str(tmp_path))
    built = []

    def build():
        built.append(1)
        return spark.range(5)

    assert store.load("preprocessed_data") is None and store.info("preprocessed_data") is None
    assert store.run_stage("preprocessed_data", build).count() == 5
    assert StageStore(spark, str(tmp_path)).run_stage("preprocessed_data", build).count() == 5
    assert len(built) == 1 and store.info("preprocessed_data")["size_mb"] >= 0


def test_kinds_of_results(spark, tmp_path):
    store = StageStore(spark, str(tmp_path))
    store.save("selected_features", ["a", "b"], {"num_features": 2})
    store.save("evaluation_results", {"monthly": spark.range(3), "summary": {"auc": 0.5}})
    again = StageStore(spark, str(tmp_path))
    assert again.load("selected_features") == ["a", "b"]
    result = again.load("evaluation_results")
    assert result["monthly"].count() == 3 and result["summary"] == {"auc": 0.5}
    assert again.info("selected_features")["metadata"] == {"num_features": 2}


def test_saving_again_replaces_the_data(spark, tmp_path):
    store = StageStore(spark, str(tmp_path))
    store.save("preprocessed_data", spark.range(1))
    store.save("preprocessed_data", spark.range(2))
    assert store.load("preprocessed_data").count() == 2
    assert len([p for p in tmp_path.iterdir() if p.is_dir()]) == 1


def test_clear_restart_and_status(spark, tmp_path):
    store = StageStore(spark, str(tmp_path))
    for name in STAGE_ORDER[:4]:
        store.save(name, [name])
    assert store.restart_from("no such stage") is False and len(store.list()) == 4
    assert store.restart_from("selected_features") is True
    assert list(store.list()) == ["preprocessed_data", "train_test_split"]
    done = {r["stage"]: r["completed"] for r in store.status().collect()}
    assert [done[name] for name in STAGE_ORDER] == [True, True, False, False, False, False]
    assert store.clear("trained_model") is False and store.clear("train_test_split") is True
    assert store.clear_all() and store.list() == {}


def test_only_new_and_changed_parts_are_built(spark, tmp_path):
    store, built = StageStore(spark, str(tmp_path)), []

    def build(df):
        built.append(sorted(r["month"] for r in df.select("month").distinct().collect()))
        return df.withColumn("double", df.n * 2)

    def run(rows):
        df = spark.createDataFrame(rows, "month string, n long")
        table = StageStore(spark, str(tmp_path)).run_parts("preprocessed_data", df, F.col("month"), build)
        assert sorted(map(tuple, table.collect()), key=str) == sorted(((m, n, 2 * n) for m, n in rows), key=str)
        return table

    rows = [("2024-01", 1), ("2024-01", 2), ("2024-02", 3), ("2024-02", 3)]
    run(rows)
    run([*rows[2:], *rows[:2]])
    assert built == [["2024-01", "2024-02"]]
    rows.append(("2024-03", 4))
    before = {p for p in tmp_path.rglob("*.parquet")}
    run(rows)
    assert built[1:] == [["2024-03"]]
    new = {p for p in tmp_path.rglob("*.parquet")} - before
    assert {p.parent.name for p in new} == {"_part=2024-03"} and before <= set(tmp_path.rglob("*.parquet"))
    rows[0] = ("2024-01", 7)
    run(rows[:2] + rows[4:])  # one part changes, one goes
    assert built[2:] == [["2024-01"]]
    store = StageStore(spark, str(tmp_path))
    assert [r["part"] for r in store.part_status("preprocessed_data").collect()] == ["2024-01", "2024-03"]
    assert len({p.parent.name for p in tmp_path.rglob("*.parquet")}) == 2
    assert store.clear_part("preprocessed_data", "2024-03") and not store.clear_part("preprocessed_data", "2024-03")
    run(rows[:2] + rows[4:])
    assert built[3:] == [["2024-03"]]
    assert store.clear("no such stage") is False
    assert StageStore(spark, str(tmp_path)).clear("preprocessed_data") and not list(tmp_path.rglob("*.parquet"))


def test_parts_without_rows_and_with_odd_names(spark, tmp_path):
    store = StageStore(spark, str(tmp_path))
    df = spark.createDataFrame([("a", 1), (None, 2)], "month string, n long")
    assert store.run_parts("preprocessed_data", df, F.col("month"), lambda d: d.filter("n > 1")).collect()[0]["n"] == 2
    assert store.run_parts("preprocessed_data", df.limit(0), F.col("month"), lambda d: d).count() == 0
    with pytest.raises(ValueError, match="cannot name folders"):
        store.run_parts("preprocessed_data", df.replace("a", "a/b"), F.col("month"), lambda d: d)


def test_lost_data_counts_as_not_stored(spark, tmp_path):
    store = StageStore(spark, str(tmp_path))
    store.save("preprocessed_data", spark.range(1))
    store.folder.delete(store.info("preprocessed_data")["path"])
    assert store.has("preprocessed_data") is False and store.load("preprocessed_data") is None


def test_broken_manifest(spark, tmp_path):
    (tmp_path / MANIFEST).write_text("{")
    with pytest.raises(ValueError, match="not a stage manifest"):
        StageStore(spark, str(tmp_path))


def test_choose_features(spark):
    names = [f"f{i}" for i in range(12)]
    assert choose_features(spark, names, ["f1"]) == [n for n in names if n != "f1"]
    assert choose_features(spark, names, names[1:]) == names
    assert choose_features(spark, names, names[1:], fallback=10) == names[:10]


def test_status_follows_the_data(spark, tmp_path):
    store = StageStore(spark, str(tmp_path))
    store.save("preprocessed_data", spark.range(1))
    store.folder.delete(store.info("preprocessed_data")["path"])
    assert not store.status().filter("stage = 'preprocessed_data'").first()["completed"]


def test_a_folder_belongs_to_one_run(spark, tmp_path):
    store = StageStore(spark, str(tmp_path / "a"))
    store.claim("one")
    StageStore(spark, str(tmp_path / "a")).claim("one")
    with pytest.raises(ValueError, match="another table, spec or options"):
        StageStore(spark, str(tmp_path / "a")).claim("two")
    other = StageStore(spark, str(tmp_path / "b"))
    other.save("preprocessed_data", spark.range(1))
    with pytest.raises(ValueError, match="unknown origin"):
        other.claim("one")


@pytest.mark.parametrize("buckets", [None, 3])
def test_pipeline_runs_and_resumes(spark, tmp_path, buckets):
    draw = random.Random(4)
    rows = []
    for i in range(600):
        label = int(draw.random() < 0.4)
        month = i % 4 + 1
        rows.append(
            (i, label, dt.datetime(2024, month, 1), draw.gauss(label, 1), draw.random(), 10.0 * month, draw.random())
        )
    df = spark.createDataFrame(
        rows, "risk_id long, label int, partition_date timestamp_ntz, a double, b double, moving double, c double"
    )
    spec = PipelineSpec(("risk_id",), "label", "partition_date", "2024-01-01", oot_start="2024-04-01")
    options = PipelineOptions(ranking_rounds=2, grid=tuple(families(2)), stack=False, buckets=buckets)
    folder, output = str(tmp_path / "stages"), str(tmp_path / "out")
    first = run_pipeline(df, spec, folder, options, output)
    assert first["shifting_features"] == ["moving"] and set(first["final_features"]) == {"a", "b", "c"}
    months = first["monthly_performance"].orderBy("month").collect()
    assert [r["month"] for r in months] == ["2024-01", "2024-02", "2024-03", "2024-04"]
    assert all(r["population"] == 150 and r["auc"] > 0.5 for r in months)
    summary = json.loads((tmp_path / "out" / "model_summary.json").read_text())
    assert summary["performance_metrics"]["cross_validation_metrics"]["auc"]["mean"] > 0.5
    assert 0.5 < summary["performance_metrics"]["validation_auc"] < 1
    metadata = json.loads((tmp_path / "out" / "pipeline_metadata.json").read_text())
    assert list(metadata["checkpoints_used"]) == list(STAGE_ORDER)
    written = spark.read.option("header", True).csv(f"{output}/monthly_performance")
    assert written.columns == [
        "month", "auc", "population", "positive_count", "positive_rate", "prediction_mean"
    ]

    stamps = {name: entry["timestamp"] for name, entry in first["store"].list().items()}
    store = StageStore(spark, folder)
    store.restart_from("evaluation_results")
    second = run_pipeline(df.filter("false"), spec, folder, options)
    later = {name: entry["timestamp"] for name, entry in second["store"].list().items()}
    assert [n for n in STAGE_ORDER if later[n] != stamps[n]] == ["evaluation_results"]
    assert [tuple(r) for r in second["monthly_performance"].orderBy("month").collect()] == [tuple(r) for r in months]


def test_shared_folder_is_the_sessions(spark):
    assert shared_folder(spark) == shared_folder(spark)
