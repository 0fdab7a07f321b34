import datetime as dt
import random

import pytest
from pyspark.sql import functions as F

from cohortloom.operators import evaluate
from cohortloom.operators.ranks import running_totals, value_cuts, with_buckets


def brute_auc(pairs):
    positive = [s for s, y in pairs if y == 1]
    negative = [s for s, y in pairs if y == 0]
    if not positive or not negative:
        return None
    wins = sum((p > n) + 0.5 * (p == n) for p in positive for n in negative)
    return wins / (len(positive) * len(negative))


def brute_best_f1(pairs):
    best = None
    for threshold in sorted({s for s, _ in pairs}, reverse=True):
        tp = sum(1 for s, y in pairs if s >= threshold and y == 1)
        fp = sum(1 for s, y in pairs if s >= threshold and y == 0)
        fn = sum(y for _, y in pairs) - tp
        f1 = 2 * tp / (2 * tp + fp + fn)
        if best is None or f1 > best[0]:
            best = (f1, threshold, tp, fp, fn, len(pairs) - tp - fp - fn)
    return best


@pytest.fixture(scope="module")
def scored(spark):
    draw = random.Random(11)
    rows = []
    for _ in range(900):
        month = draw.choice([1, 2, 2, 2, 3])
        label = 1 if month == 3 else int(draw.random() < 0.3)  # the last month has one class
        rows.append((dt.datetime(2024, month, 5), draw.choice([0.25, round(draw.random() + label / 4, 2)]), label))
    rows += [(None, 0.5, 1)] * 3
    return rows, spark.createDataFrame(rows, "d timestamp_ntz, score double, label int").repartition(6)


def test_monthly_performance(scored):
    rows, df = scored
    table = evaluate.monthly_performance(df, "d", "score", "label").collect()
    assert [r["month"] for r in table] == ["2024-01", "2024-02", "2024-03"]
    for row in table:
        pairs = [(s, y) for d, s, y in rows if d and d.month == int(row["month"][-2:])]
        assert row["auc"] == (None if row["month"] == "2024-03" else pytest.approx(brute_auc(pairs), abs=1e-12))
        assert (row["population"], row["positive_count"]) == (len(pairs), sum(y for _, y in pairs))
        assert row["positive_rate"] == pytest.approx(row["positive_count"] / row["population"])
        assert row["prediction_mean"] == pytest.approx(sum(s for s, _ in pairs) / len(pairs))
    stats = evaluate.monthly_stats(df, "d", "score", "label").collect()
    assert [r["population"] for r in stats] == [r["population"] for r in table]


def test_confusion_at_the_best_f1(scored):
    rows, df = scored
    row = evaluate.confusion_best_f1(df, "score", "label").first()
    expected = brute_best_f1([(s, y) for _, s, y in rows])
    assert row["f1"] == pytest.approx(expected[0], abs=1e-12)
    assert (row["threshold"], row["tp"], row["fp"], row["fn"], row["tn"]) == expected[1:]


def test_fold_metrics_and_summary(scored):
    rows, df = scored
    folds = evaluate.fold_metrics(df.withColumn("fold", F.month("d")).filter("fold < 3"), "fold", "score", "label")
    values = {(r["fold"], r["metric"]): r["value"] for r in folds.collect()}
    for fold in (1, 2):
        pairs = [(s, y) for d, s, y in rows if d and d.month == fold]
        f1, _, tp, fp, fn, tn = brute_best_f1(pairs)
        assert values[fold, "auc"] == pytest.approx(brute_auc(pairs))
        assert values[fold, "f1"] == pytest.approx(f1)
        assert values[fold, "precision"] == pytest.approx(tp / (tp + fp))
        assert values[fold, "recall"] == pytest.approx(tp / (tp + fn))
        assert values[fold, "accuracy"] == pytest.approx((tp + tn) / len(pairs))
    summary = {r["metric"]: r for r in evaluate.cv_summary(folds).collect()}
    a, b = values[1, "auc"], values[2, "auc"]
    assert summary["auc"]["mean"] == pytest.approx((a + b) / 2)
    assert summary["auc"]["std"] == pytest.approx(abs(a - b) / 2**0.5)


def test_missing_labels_and_scores_fail(spark):
    for row in ((1, None), (None, 0.5), (1, float("nan"))):
        df = spark.createDataFrame([(dt.datetime(2024, 1, 1), *row), (dt.datetime(2024, 1, 1), 0, 0.1)], "d timestamp_ntz, label int, score double")
        for metric in (evaluate.monthly_performance, evaluate.monthly_stats):
            with pytest.raises(Exception, match="is missing"):
                metric(df, "d", "score", "label").collect()


def test_a_group_without_a_key_is_kept(spark):
    rows = [(None, 0.1, 0), (None, 0.9, 1), (1, 0.2, 1), (1, 0.8, 0)]
    df = spark.createDataFrame(rows, "g int, score double, label int")
    assert {r["g0"]: r["auc"] for r in evaluate.auc_by_group(df, [F.col("g")], "score", "label")[0].collect()} == {None: 1.0, 1: 0.0}
    assert {r["g0"] for r in evaluate.best_f1(df, [F.col("g")], "score", "label")[0].collect()} == {None, 1}
    assert {r["fold"] for r in evaluate.fold_metrics(df, "g", "score", "label").collect()} == {None, 1}


def test_auc_of_large_counts(spark):
    counts = spark.createDataFrame([(0, 0.1, 0, 4 * 10**10), (0, 0.2, 4 * 10**10, 8 * 10**10)], "bucket int, score double, pos long, n long")
    assert evaluate._auc(counts, []).first()["auc"] == pytest.approx(0.75)


def test_model_auc_is_null_when_a_part_is_absent(scored):
    rows, df = scored
    row = evaluate.model_auc(df.withColumn("part", F.lit("train")), "part", "score", "label").first()
    assert row["validation_auc"] is None
    assert row["training_auc"] == pytest.approx(brute_auc([(s, y) for _, s, y in rows]))


@pytest.mark.parametrize("buckets", [2, 5, 40])
def test_running_totals_do_not_depend_on_the_cuts(spark, buckets):
    draw = random.Random(2)
    values = [7.0] * 300 + [draw.choice([float(draw.randrange(50)), draw.gauss(0, 9)]) for _ in range(600)]
    df = spark.createDataFrame([(i % 2, v) for i, v in enumerate(values)], "g int, v double").repartition(4)
    cuts, _ = value_cuts(df, ["v"], buckets=buckets)
    counts = with_buckets(df, cuts).groupBy("g", F.col("v_bucket").alias("bucket"), "v").agg(F.count("*").alias("n"))
    for row in running_totals(counts, ["g"], "v", ["n"]).collect():
        group = [v for i, v in enumerate(values) if i % 2 == row["g"]]
        assert row["n_upto"] == sum(v <= row["v"] for v in group)
        assert row["n_all"] == len(group)
