"""Stages checked while they are stored: one scan, no stage for a table that breaks a rule, buckets that save a shuffle."""

import random

import pytest
from pyspark.ml.classification import RandomForestClassifier
from pyspark.ml.linalg import Vectors, VectorUDT
from pyspark.sql import types as T

from cohortloom import PipelineSpec
from cohortloom.operators.prepare import preprocess
from cohortloom.operators.quality import duplicate_count, validate, validation_report
from cohortloom.plans.checked import FACTS, run_checked, stored_facts
from cohortloom.plans.stages import StageStore

SPEC = PipelineSpec(("id", "part"), "target", "day", "2024-01-01")
SCHEMA = "id int, part string, target string, day string, x double, flag boolean"


POINTS = T.StructType([T.StructField("label", T.DoubleType()), T.StructField("features", VectorUDT())])


def good_rows(n=300):
    draw = random.Random(8)
    return [
        (None if i == 5 else i, f"p{i % 3}", "ab"[i % 2], f"202{3 + i % 2}-0{1 + i % 9}-11", draw.random() if i % 7 else None, i % 5 == 0)
        for i in range(n)
    ]


def frame(spark, rows=None, schema=SCHEMA):
    return spark.createDataFrame(good_rows() if rows is None else rows, schema).repartition(4)


def files(path):
    return [p for p in path.rglob("*.parquet")]


def table_of(spark, tmp_path):
    frame(spark).write.parquet(str(tmp_path / "input"))
    return spark.read.parquet(str(tmp_path / "input"))


def plan(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_the_stage_is_the_preprocessed_table(spark, tmp_path):
    df, store = frame(spark), StageStore(spark, str(tmp_path))
    stored = run_checked(store, "s", df, SPEC, 4)
    plain = preprocess(df, SPEC)
    assert stored.schema.simpleString() == plain.schema.simpleString()
    assert sorted(map(str, stored.collect())) == sorted(map(str, plain.collect()))
    report = [tuple(r) for r in sorted(validation_report(df, SPEC).collect(), key=lambda r: r.step)]
    assert [tuple(r.values()) for r in store.info("s")["metadata"]["report"]] == report


def test_one_scan_checks_and_stores(spark, tmp_path):
    df = table_of(spark, tmp_path)
    seen = spark.sparkContext.accumulator(0)

    def count(batches):
        for batch in batches:
            seen.add(batch.num_rows)
            yield batch

    watched = df.mapInArrow(count, df.schema)
    run_checked(StageStore(spark, str(tmp_path / "store")), "s", watched, SPEC, 4)
    assert seen.value == 300


def test_grouping_by_id_moves_no_rows(spark, tmp_path):
    stored = run_checked(StageStore(spark, str(tmp_path)), "s", frame(spark), SPEC, 4)
    by_key = stored.groupBy("id", "part", "target").count()
    assert "Exchange" not in plan(by_key) and by_key.count() == 300
    assert "Bucketed: true" in plan(by_key)
    assert duplicate_count(stored, ["id", "part", "target"]).first()["dup_count"] == 0
    assert "Exchange hashpartitioning" not in plan(duplicate_count(stored, ["id", "part", "target"]))
    joined = stored.select("id", "part", "x").hint("merge").join(stored.select("id", "part", "flag"), ["id", "part"])
    assert "Exchange" not in plan(joined) and joined.count() == 300


def test_another_session_reads_the_buckets(spark, tmp_path):
    store = StageStore(spark, str(tmp_path))
    rows = sorted(map(str, run_checked(store, "s", frame(spark), SPEC, 4).collect()))
    spark.sql(f"DROP TABLE {store.info('s')['table']}")
    again = StageStore(spark, str(tmp_path)).load("s")
    assert sorted(map(str, again.collect())) == rows
    assert "Exchange" not in plan(again.groupBy("id", "part").count())


def test_a_stored_stage_is_not_built_again(spark, tmp_path):
    store = StageStore(spark, str(tmp_path))
    run_checked(store, "s", frame(spark), SPEC, 4)
    assert run_checked(store, "s", frame(spark, []), SPEC, 4).count() == 300
    assert store.clear("s") and not files(tmp_path)
    with pytest.raises(ValueError, match="Only 0 unique"):
        run_checked(store, "s", frame(spark, []), SPEC, 4)


def swap(rows, **values):
    names = ["id", "part", "target", "day", "x", "flag"]
    return [tuple(values.get(n, v) for n, v in zip(names, row, strict=True)) for row in rows]


BROKEN = {
    "repeats": good_rows() + good_rows()[:9],
    "hot key": good_rows() + [(1, "p1", "b", "2024-01-11", 0.5, True)] * 150,
    "null keys": good_rows() + [(None, None, "a", "2024-01-11", 0.5, True)] * 3,
    "one class": swap(good_rows(), target="a"),
    "no class": swap(good_rows(), target=None),
    "three classes": swap(good_rows()[:2], target="c") + good_rows()[2:],
    "null class": swap(good_rows()[:2], target=None) + good_rows()[2:],
    "many classes": [(*r[:2], f"c{i}", *r[3:]) for i, r in enumerate(good_rows())],
    "too early": swap(good_rows(), day="2021-01-01"),
    "too late": swap(good_rows(), day="2025-01-01"),
}


@pytest.mark.parametrize("case", BROKEN)
def test_a_broken_rule_leaves_no_stage(spark, tmp_path, case):
    df, store = frame(spark, BROKEN[case]), StageStore(spark, str(tmp_path))
    with pytest.raises(ValueError) as plain:
        validate(df, SPEC)
    before = spark.sql("SHOW TABLES").count()
    with pytest.raises(ValueError) as checked:
        run_checked(store, "s", df, SPEC, 4)
    assert str(checked.value) == str(plain.value)
    assert not store.has("s") and not files(tmp_path) and spark.sql("SHOW TABLES").count() == before


def test_static_rules_come_in_their_order(spark, tmp_path):
    store = StageStore(spark, str(tmp_path))
    odd = frame(spark).withColumnRenamed("x", "x-y")
    with pytest.raises(ValueError, match="Invalid column names"):
        run_checked(store, "s", odd, SPEC, 4)
    with pytest.raises(ValueError, match="duplicate rows"):
        run_checked(store, "s", odd.union(odd), SPEC, 4)
    with pytest.raises(ValueError, match="missing columns"):
        run_checked(store, "s", odd.drop("part"), SPEC, 4)


def test_models_work_after_a_checked_stage(spark, tmp_path):
    run_checked(StageStore(spark, str(tmp_path)), "s", frame(spark), SPEC, 4)
    points = spark.createDataFrame([(float(i % 2), Vectors.dense(i, i % 3)) for i in range(40)], POINTS)
    model = RandomForestClassifier(numTrees=2, seed=1).fit(points)
    assert model.transform(points).count() == model.transform(points).checkpoint().count() == 40


def test_the_check_reads_no_features(spark, tmp_path):
    store = StageStore(spark, str(tmp_path))
    run_checked(store, "s", frame(spark), SPEC, 4)
    text = plan(stored_facts(spark.table(store.info("s")["table"]), SPEC))
    schema = text.split("ReadSchema: ")[1]
    assert "x:" not in schema and "flag:" not in schema
    assert FACTS not in store.load("s").columns
