"""Model evaluation from scored rows: AUC, monthly performance, best-F1 confusion, fold summaries."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cohortloom.functions.columns import month_key, month_start
from cohortloom.operators.ranks import buckets_below, inside_bucket, running_totals, value_cuts, with_buckets
from cohortloom.session import shared_folder

FOLD_METRICS = ("auc", "accuracy", "precision", "recall", "f1")


def given(value: Column, name: str) -> Column:
    """The value; a missing one (null or NaN) fails the job, as no metric has a meaning for it."""
    missing = value.isNull() | F.isnan(value.cast("double"))
    return F.when(missing, F.raise_error(F.lit(f"a {name} is missing")).cast("double")).otherwise(value)


def score_counts(df: DataFrame, group: Sequence[Column], score: str, label: str) -> tuple[DataFrame, list[str]]:
    """Positives and rows per (group, bucket, score).

    The input is read once, and combined on the map side; the counts are stored,
    and cut points and buckets come from them. Group keys are structs of one field
    ``v``: never null, so that joins on them keep a null group.
    """
    shared_folder(df.sparkSession)
    keys = [f"g{i}" for i in range(len(group))]
    rows = df.select(
        *(F.struct(column.alias("v")).alias(key) for key, column in zip(keys, group, strict=True)),
        given(F.col(score).cast("double"), "score").alias("score"),
        given(F.col(label).cast("int"), "label").cast("int").alias("label"),
    )
    counts = rows.withColumn("score", F.col("score") + F.lit(0.0)).groupBy(*keys, "score")  # -0.0 is 0.0
    stored = counts.agg(F.sum("label").alias("pos"), F.count(F.lit(1)).alias("n")).checkpoint()
    cuts, _ = value_cuts(stored, ["score"])
    return with_buckets(stored, cuts).withColumnRenamed("score_bucket", "bucket"), keys


def opened(table: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Group keys as they were given."""
    return table.withColumns({key: F.col(f"{key}.v") for key in keys}) if keys else table


def auc_by_group(df: DataFrame, group: Sequence[Column], score: str, label: str) -> tuple[DataFrame, list[str]]:
    """ROC AUC and class statistics per group; AUC is null where a group has one class.

    AUC counts, for each positive, the negatives with a lower score and half of
    those with the same one. Inside a bucket that is a window; negatives of lower
    buckets count once for every positive, which the small table adds.
    """
    counts, keys = score_counts(df, group, score, label)
    return opened(_auc(counts, keys), keys), keys


def _auc(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    negative = F.col("n") - F.col("pos")
    lower = F.sum(negative).over(inside_bucket(keys, "score")) - negative
    per_bucket = (
        counts.withColumn("pairs", F.col("pos").cast("double") * (lower + negative / 2))
        .groupBy(*keys, "bucket")
        .agg(
            F.sum("pairs").alias("pairs"),
            F.sum("pos").alias("pos"),
            F.sum("n").alias("n"),
            F.sum(F.col("score") * F.col("n")).alias("score_sum"),
        )
    )
    below = F.coalesce(F.sum(negative).over(buckets_below(keys)), F.lit(0))
    per_group = (
        per_bucket.withColumn("pairs", F.col("pairs") + F.col("pos").cast("double") * below)
        .groupBy(*keys)
        .agg(
            F.sum("pairs").alias("pairs"),
            F.sum("pos").alias("positive_count"),
            F.sum("n").alias("population"),
            F.sum("score_sum").alias("score_sum"),
        )
    )
    possible = F.col("positive_count").cast("double") * (F.col("population") - F.col("positive_count"))
    return per_group.select(
        *keys,
        F.when(possible > 0, F.col("pairs") / possible).alias("auc"),
        "population",
        "positive_count",
        (F.col("positive_count") / F.col("population")).alias("positive_rate"),
        (F.col("score_sum") / F.col("population")).alias("prediction_mean"),
    )


def monthly_stats(df: DataFrame, date: str, score: str, label: str) -> DataFrame:
    positive = given(F.col(label).cast("int"), "label").cast("int")
    value = given(F.col(score).cast("double"), "score")
    return (
        df.filter(F.col(date).isNotNull())
        .groupBy(month_start(date).alias("month"))
        .agg(
            F.count(F.lit(1)).alias("population"),
            F.sum(positive).alias("positive_count"),
            F.avg(positive).alias("positive_rate"),
            F.avg(value).alias("prediction_mean"),
        )
        .withColumn("month", month_key("month"))
        .orderBy("month")
    )


def monthly_performance(df: DataFrame, date: str, score: str, label: str) -> DataFrame:
    """Month, AUC, population, positives, positive rate and mean score, ordered by month."""
    dated = df.filter(F.col(date).isNotNull())
    table, (key,) = auc_by_group(dated, [month_start(date)], score, label)
    return table.withColumn(key, month_key(key)).withColumnRenamed(key, "month").orderBy("month")


def monthly_auc(df: DataFrame, date: str, score: str, label: str) -> DataFrame:
    return monthly_performance(df, date, score, label).select("month", "auc")


def model_auc(df: DataFrame, part: str, score: str, label: str) -> DataFrame:
    """One row: AUC of the training and of the validation part, null when absent."""
    table, (key,) = auc_by_group(df, [F.col(part)], score, label)
    return table.agg(
        F.max(F.when(F.col(key) == "train", F.col("auc"))).alias("training_auc"),
        F.max(F.when(F.col(key) == "valid", F.col("auc"))).alias("validation_auc"),
    )


def best_f1(df: DataFrame, group: Sequence[Column], score: str, label: str) -> tuple[DataFrame, list[str]]:
    """Confusion counts per group at the score threshold with the best F1 (the highest, if tied)."""
    counts, keys = score_counts(df, group, score, label)
    return opened(_best_f1(counts, keys), keys), keys


def _best_f1(counts: DataFrame, keys: Sequence[str]) -> DataFrame:
    ranked = running_totals(counts, keys, "score", ["pos", "n"])
    tp = F.col("pos_all") - F.col("pos_upto") + F.col("pos")
    called = F.col("n_all") - F.col("n_upto") + F.col("n")
    f1 = F.when(F.col("pos_all") + called > 0, 2.0 * tp / (F.col("pos_all") + called)).otherwise(0.0)
    choice = ranked.select(
        *keys,
        F.struct(
            f1.alias("f1"),
            F.col("score").alias("threshold"),
            tp.alias("tp"),
            (called - tp).alias("fp"),
            (F.col("pos_all") - tp).alias("fn"),
            (F.col("n_all") - F.col("pos_all") - called + tp).alias("tn"),
        ).alias("best"),
    )
    best = choice.groupBy(*keys).agg(F.max("best").alias("best")).select(*keys, "best.*")
    return best.withColumns(
        {
            "precision": F.try_divide(F.col("tp"), F.col("tp") + F.col("fp")),
            "recall": F.try_divide(F.col("tp"), F.col("tp") + F.col("fn")),
            "accuracy": (F.col("tp") + F.col("tn")) / (F.col("tp") + F.col("fp") + F.col("fn") + F.col("tn")),
        }
    )


def confusion_best_f1(df: DataFrame, score: str, label: str) -> DataFrame:
    return best_f1(df, [], score, label)[0]


def fold_metrics(df: DataFrame, fold: str, score: str, label: str) -> DataFrame:
    """AUC, and the best-F1 metrics, of each fold in long form: ``fold, metric, value``."""
    counts, keys = score_counts(df, [F.col(fold)], score, label)
    table = _auc(counts, keys).select(*keys, "auc").join(_best_f1(counts, keys), keys)
    return opened(table, keys).select(
        F.col(keys[0]).alias("fold"),
        F.inline(
            F.array(*(F.struct(F.lit(m).alias("metric"), F.col(m).alias("value")) for m in FOLD_METRICS))
        ),
    )


def cv_summary(folds: DataFrame) -> DataFrame:
    """Mean and sample deviation of each metric over folds."""
    return (
        folds.groupBy("metric")
        .agg(F.avg("value").alias("mean"), F.stddev_samp("value").alias("std"))
        .orderBy("metric")
    )
