import datetime as dt
import math
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cohortloom import PipelineSpec
from cohortloom.operators.prepare import ceil_2dp, fill_sentinel, narrow_integers, preprocess
from cohortloom.operators.split import distinct_months, last_month_start, part_of, sort_by_date, split, split_summary, union_splits

SPEC = PipelineSpec(("id_col",), "target_col", "date_col", "2024-01-01", ignored=("ignored_feature",))
NAN, INF = float("nan"), float("inf")


def test_preprocess(spark):
    df = spark.createDataFrame(
        [
            (1.567, NAN, 1, "2024-01-01", 9, 0, "x"),
            (2.0, 2.5, 2, "2024-01-02", 9, 1, None),
            (None, -1.234, 3, "2024-01-03", 9, 0, "z"),
        ],
        "feature1 double, feature2 double, id_col long, date_col string, ignored_feature long, target_col int, "
        "text string",
    )
    result = preprocess(df, SPEC)
    assert result.columns == ["id_col", "target_col", "date_col", "feature1", "feature2", "text"]
    rows = result.orderBy("id_col").collect()
    assert [r["feature1"] for r in rows] == [1.57, 2.0, -999999.0]
    assert [r["feature2"] for r in rows] == [-999999.0, 2.5, -1.23]
    assert [r["text"] for r in rows] == ["x", "-999999", "z"]
    assert rows[0]["date_col"] == dt.datetime(2024, 1, 1)
    assert dict(result.dtypes)["target_col"] == "int"


def test_preprocess_is_narrow(spark):
    df = spark.createDataFrame([(1, 0, "2024-01-01", 1.0)], "id_col long, target_col int, date_col string, f double")
    plan = preprocess(df, SPEC, check=False)._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan and "Python" not in plan


def test_ceil_edges(spark):
    values = [1.1, 1.567, -0.001, NAN, INF, -INF, 1e300, 2.0**60, None]
    df = spark.createDataFrame([(i, v, i) for i, v in enumerate(values)], "i int, v double, n int")
    result = [r["v"] for r in ceil_2dp(df, ["v", "n", "absent"]).orderBy("i").collect()]
    assert result[0] == math.ceil(1.1 * 100) / 100 == 1.11
    assert result[1:3] == [1.57, 0.0]
    assert math.isnan(result[3]) and result[4:6] == [INF, -INF]
    assert result[6:8] == [1e300 * 100 / 100, 2.0**60] and result[8] is None
    assert dict(ceil_2dp(df, ["v", "n"]).dtypes)["n"] == "double"


def test_fill_covers_ids_and_text(spark):
    df = spark.createDataFrame([(None, None, None, None)], "a long, b string, c boolean, d date")
    assert tuple(fill_sentinel(df).first()) == (-999999, "-999999", -999999, None)


def test_fill_widens_narrow_types(spark):
    schema = "a tinyint, b smallint, c decimal(5,2), d decimal(38,36), e float, f boolean, g decimal(20,0)"
    df = spark.createDataFrame([(None,) * 7, (1, 2, Decimal("3.25"), Decimal("0.5"), NAN, True, Decimal(4))], schema)
    filled = fill_sentinel(df)
    assert [t for _, t in filled.dtypes] == ["int", "int", "decimal(8,2)", "double", "float", "int", "decimal(20,0)"]
    first, second = filled.collect()
    assert {float(v) for v in first} == {-999999.0}
    assert tuple(map(float, second)) == (1, 2, 3.25, 0.5, -999999, 1, 4)


def test_narrow_integers(spark):
    df = spark.createDataFrame(
        [(-128, 128, 40000, 2**40, 1.5, None)], "a long, b long, c int, d long, e double, f long"
    )
    assert [t for _, t in narrow_integers(df).dtypes] == ["tinyint", "smallint", "int", "bigint", "double", "bigint"]
    assert tuple(narrow_integers(df).first()) == (-128, 128, 40000, 2**40, 1.5, None)


def dated(spark, days):
    return spark.createDataFrame([(i, d) for i, d in enumerate(days)], "id_col long, date_col timestamp_ntz")


def test_split_at_a_date(spark):
    days = [dt.datetime(2024, m, d) for m in (1, 2) for d in (1, 2, 3)] + [None]
    spec = PipelineSpec(("id_col",), "t", "date_col", "2024-01-01", oot_start="2024-02-01")
    train, test = split(dated(spark, days), spec)
    assert (train.count(), test.count()) == (3, 3)


@pytest.mark.parametrize(
    ("days", "sizes"),
    [
        ([dt.datetime(2024, 1, 1) + dt.timedelta(i) for i in range(59)], (31, 28)),
        ([dt.datetime(2024, 1, d) for d in (5, 6, 7)], (0, 3)),
        ([], (0, 0)),
        ([dt.datetime(2024, 2, 1, 9), dt.datetime(2024, 2, 1, 10), dt.datetime(2024, 2, 20, 10)], (1, 2)),
    ],
)
def test_split_last_month(spark, days, sizes):
    train, test = split(dated(spark, days), SPEC)
    assert (train.count(), test.count()) == sizes
    df = dated(spark, days)
    part = part_of(SPEC, last_month_start(df, "date_col").scalar())
    summary = {r["split"]: r["n_rows"] for r in split_summary(df, "date_col", part).collect()}
    assert (summary["train"], summary["test"]) == sizes
    assert union_splits(df, part).count() == sum(sizes)


def test_optional_upper_bounds(spark):
    days = [dt.datetime(2024, m, 1) for m in (1, 2, 3, 4, 5)]
    spec = PipelineSpec(
        ("id_col",), "t", "date_col", "2024-01-01", oot_start="2024-03-01", train_end="2024-01-31", oot_end="2024-04-30"
    )
    train, test = split(dated(spark, days), spec)
    assert (train.count(), test.count()) == (1, 2)
    assert union_splits(dated(spark, days), part_of(spec, spec.oot_start)).count() == 3


def test_a_hot_date_is_split_between_tasks(spark):
    df = spark.range(0, 20_000, 1, 8).selectExpr("id", "IF(id % 3 = 0, DATE'2024-01-01', DATE'2024-01-02') AS day")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        sizes = sort_by_date(df, "day").groupBy(F.spark_partition_id()).count().collect()
    finally:
        spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "true")
    assert max(r["count"] for r in sizes) < 20_000 / 3


def test_split_filters_reach_the_files(spark):
    orders = spark.read.parquet("/root/testdata/sf0.001/orders.parquet")
    spec = PipelineSpec(("o_orderkey",), "t", "o_orderdate", "1995-01-01", oot_start="2000-01-01")
    plan = split(orders, spec)[1].select("o_orderkey")._jdf.queryExecution().executedPlan().toString()
    assert "GreaterThanOrEqual(o_orderdate" in plan
    assert "ReadSchema: struct<o_orderkey:bigint,o_orderdate:timestamp_ntz>" in plan


def test_distinct_months(spark):
    df = dated(spark, [dt.datetime(2024, 3, 1), dt.datetime(2023, 12, 1), dt.datetime(2024, 3, 9), None])
    assert [r["month"] for r in distinct_months(df, "date_col").collect()] == ["2023-12", "2024-03"]
