import datetime as dt
import math
import random
import statistics

import pytest
from pyspark.sql import functions as F
from test_spec import login_config

from cohortloom import FeatureSpec
from cohortloom.functions import columns as C
from cohortloom.operators.features import conditional_features, lookback_features, wide_features
from cohortloom.sources.readers import lookback_range

DAY = 86_400_000
AS_OF_MS = 1_706_659_200_000  # 2024-01-31 UTC


def prepared(spark, rows):
    from pyspark.sql import functions as F

    df = spark.createDataFrame(rows, "customer_id long, login_id long, device_type string, login_unix_ts long")
    time, as_of = F.col("login_unix_ts"), C.as_of_millis("2024-01-31")
    return df.withColumns(
        {
            "partition_date": C.as_date("2024-01-31"),
            "is_ios": C.flag_case("device_type", "ios"),
            "scaled_diff_login_unix_ts": C.scaled_time(time, as_of),
            **C.window_flags(time, as_of, [f"l{d}d" for d in (1, 3, 7, 14, 30, 60, 90)]),
        }
    )


@pytest.fixture(scope="module")
def rows():
    draw = random.Random(5)
    # A third of all rows are of one user; some are outside of every window.
    return [
        (
            0 if i % 3 == 0 else draw.randrange(1, 9),
            None if draw.random() < 0.1 else i,
            draw.choice(["ios", "android", None]),
            AS_OF_MS - draw.randrange(-2 * DAY, 120 * DAY),
        )
        for i in range(600)
    ] + [(77, 1, "ios", AS_OF_MS + DAY), (78, None, "ios", AS_OF_MS), (79, 4, "ios", AS_OF_MS - 7 * DAY)]


def spec():
    columns = login_config()["col_agg_dict"]
    columns["login_unix_ts"]["aggregations"] = ["MIN", "MAX", "STDDEV"]
    columns["is_ios"]["aggregations"] = ["MIN", "MAX", "AVG", "STDDEV"]
    return FeatureSpec.from_dict(login_config(col_agg_dict=columns))


def brute_force(rows, uid, condition, column, aggregation, days):
    values = []
    for user, login, device, time in rows:
        record = {"login_id": login, "is_ios": device == "ios", "login_unix_ts": time}
        holds = {"": True, "is_ios": record["is_ios"], "is_notios": not record["is_ios"]}[condition]
        if user == uid and holds and AS_OF_MS - days * DAY <= time <= AS_OF_MS and record[column] is not None:
            values.append(record[column])
    if aggregation == "COUNT":
        return len(values)
    if not values or (aggregation == "STDDEV" and len(values) < 2):
        return None
    return {
        "MIN": min,
        "MAX": max,
        "AVG": lambda v: sum(v) / len(v),
        "STDDEV": lambda v: statistics.stdev([float(x) for x in v]),
    }[aggregation](values)


@pytest.mark.parametrize("build", [conditional_features, lookback_features])
def test_features_match_brute_force(spark, rows, build):
    table = {r["customer_id"]: r for r in build(prepared(spark, rows), spec()).collect()}
    assert set(table) == {r[0] for r in rows}
    for feature in spec().features():
        if feature.column.startswith("scaled"):
            continue
        condition = feature.conditions[0].name if feature.conditions else ""
        for uid, row in table.items():
            expected = brute_force(
                rows, uid, condition, feature.column, feature.aggregation, int(feature.window[1:-1])
            )
            found = row[feature.name]
            if isinstance(expected, float):
                assert math.isclose(found, expected, rel_tol=1e-9, abs_tol=1e-9), (feature.name, uid)
            else:
                assert found == expected, (feature.name, uid)


def test_both_forms_have_the_same_columns_and_types(spark, rows):
    df = prepared(spark, rows)
    assert [(f.name, f.dataType) for f in conditional_features(df, spec()).schema] == [
        (f.name, f.dataType) for f in lookback_features(df, spec()).schema
    ]


def test_windows_that_are_no_lookbacks_use_the_plain_form(spark):
    rows = [(1, 1, "ios", AS_OF_MS), (1, 2, "ios", AS_OF_MS - DAY), (2, 3, "web", AS_OF_MS - 3 * DAY)]
    df = prepared(spark, rows).selectExpr("*", "login_id = 2 AS weekend", "login_id > 1 AS month_end")
    config = login_config(
        col_agg_dict={"login_id": {"conditions": [False], "aggregations": ["COUNT"]}},
        time_cond_dict=["weekend", "month_end"],
    )
    table = wide_features(df, FeatureSpec.from_dict(config)).drop("partition_date").orderBy("customer_id")
    assert [tuple(r) for r in table.collect()] == [(1, 1, 1), (2, 0, 1)]


def test_lookbacks_that_do_not_nest_fail(spark):
    df = prepared(spark, [(1, 1, "ios", AS_OF_MS)]).withColumn("l7d", F.lit(False))
    with pytest.raises(Exception, match="in window l3d but not in l7d"):
        wide_features(df, spec()).collect()


@pytest.mark.parametrize("build", [conditional_features, lookback_features])
def test_averages_of_large_integers(spark, build):
    df = prepared(spark, [(1, 1, "ios", AS_OF_MS), (1, 2, "ios", AS_OF_MS)]).withColumn("large", F.lit(5 * 10**18))
    config = login_config(col_agg_dict={"large": {"conditions": [False], "aggregations": ["AVG", "STDDEV"]}}, time_cond_dict=["l1d", "l7d"])
    row = build(df, FeatureSpec.from_dict(config)).first()
    assert row["avg_large_l1d"] == row["avg_large_l7d"] == 5e18


def test_month_and_year_windows(spark):
    day = lambda text: F.unix_millis(F.lit(text).cast("timestamp"))
    flags = C.window_flags(F.col("t"), day("2024-03-31"), ["l1m", "l1y", "l30d"])
    times = ["2024-02-29", "2024-02-28 23:59:59", "2023-03-31", "2023-03-30", "2024-03-31", "2024-04-01"]
    df = spark.createDataFrame([(i, t) for i, t in enumerate(times)], "i int, s string").select("i", F.unix_millis(F.col("s").cast("timestamp")).alias("t"))
    found = [tuple(r) for r in df.select("i", *(f.alias(n) for n, f in flags.items())).orderBy("i").select("l1m", "l1y").collect()]
    assert found == [(True, True), (False, True), (False, True), (False, False), (True, True), (False, False)]


def test_window_ends_are_inclusive(spark):
    edges = [(1, 1, "ios", AS_OF_MS), (1, 2, "ios", AS_OF_MS - DAY), (1, 3, "ios", AS_OF_MS - DAY - 1)]
    row = lookback_features(prepared(spark, edges), spec()).first()
    assert row["count_login_id_l1d"] == 2 and row["count_login_id_l3d"] == 3


def test_missing_columns_are_named(spark, rows):
    with pytest.raises(ValueError, match="l90d"):
        lookback_features(prepared(spark, rows).drop("l90d"), spec())


def test_as_of_millis_in_a_zone(spark):
    row = spark.range(1).select(
        C.as_of_millis("2025-08-06", "Asia/Jakarta").alias("jakarta"), C.as_of_millis("2025-08-06").alias("utc")
    )
    assert row.first().asDict() == {"jakarta": 1_754_413_200_000, "utc": 1_754_438_400_000}


def test_lookback_prunes_partitions(spark, tmp_path):
    days = [(dt.date(2024, 1, 1) + dt.timedelta(i)).strftime("%Y%m%d") for i in range(30)]
    path = str(tmp_path / "log")
    spark.createDataFrame([(d, i) for i, d in enumerate(days)], "create_date string, id int").write.partitionBy(
        "create_date"
    ).parquet(path)
    read = spark.read.schema("id int, create_date string").parquet(path)
    kept = read.filter(lookback_range("create_date", "2024-01-21", 5))
    assert sorted(r["create_date"] for r in kept.collect()) == days[15:20]
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert "PartitionFilters: [isnotnull(create_date" in plan
