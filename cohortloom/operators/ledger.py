"""A drift ledger: counts per month and value slot, kept, so that new months alone are read.

The distance of two months is known at fixed values, the cut points, from counts
alone; between two cut points it is bounded by the counts of that gap. Most features
are clear from these bounds, in either direction. Only features and months whose
bounds leave something open are counted exactly from their rows, so the answer is the
exact one.

Cut points come from a sketch of the first month read and stay as they are: other
cut points would leave more or less open, never change an answer. A cut point is a slot
of its own, so a feature with few distinct values has nothing open at all.
"""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from cohortloom.functions.columns import as_date, as_time, month_key, month_start, present_double
from cohortloom.operators.drift import DRIFT_THRESHOLD, drift_rows, ks_by_month, shifting_features
from cohortloom.operators.ranks import with_buckets
from cohortloom.plans.stages import SharedFolder
from cohortloom.spec import PipelineSpec

#: Cut points per feature and size of its sketch: what a ledger row set and the sketch's balance depend on.
CUT_POINTS, SKETCH_SIZE = 128, 800
#: Features per job while the cut points are found; bounds what comes to the driver at once.
FEATURES_AT_ONCE = 200
#: Bounds closer than this to each other or to the threshold count as open: sums of shares may differ in their last digits.
NEAR = 1e-9

_COUNTS = "feature string, slot int, n bigint, month date"
_CUTS = "feature string, cuts array<double>"


class DriftLedger:
    """Counts per feature, slot and month in a shared folder.

    ``counts`` is Parquet by month; a month is written by one job, which replaces the
    month's folder when it is complete, so a lost job leaves the month as it was.
    The features are those of the first month added; a ledger belongs to one spec
    and table.
    """

    def __init__(self, spark: SparkSession, path: str, spec: PipelineSpec):
        self.spark, self.spec = spark, spec
        self._folder = SharedFolder(spark, path)
        self._counts, self._cuts = f"{path}/counts", f"{path}/cuts"

    def counts(self) -> DataFrame:
        """``feature, slot, n, month``; slot -1 holds missing values."""
        if not self._folder.exists(self._counts):
            return self.spark.createDataFrame([], _COUNTS)
        return self.spark.read.schema(_COUNTS).parquet(self._counts)

    def months(self) -> list[dt.date]:
        """The months in the ledger, from the names of their folders and a row of each."""
        return sorted(r["month"] for r in self.counts().select("month").distinct().collect())

    def cuts(self) -> dict[str, list[float]]:
        rows = self.spark.read.schema(_CUTS).parquet(self._cuts).collect()  # one row per feature
        return {r["feature"]: r["cuts"] for r in rows}

    def update(self, df: DataFrame) -> list[dt.date]:
        """Add the months that the ledger lacks; only the date column is read to find them. Gives what was added."""
        found = drift_rows(df, self.spec).select(month_start(self.spec.date).alias("month")).distinct().collect()
        new = sorted({r["month"] for r in found} - set(self.months()))
        if new:
            self.add(df, new)
        return new

    def add(self, df: DataFrame, months: Sequence[dt.date]) -> None:
        """Count these months anew, whether the ledger has them or not; other months are not read.

        ``update`` does not look at known months again: a month with late rows is named here. A month
        that has lost all its rows is taken out by ``drop``.
        """
        if not months:
            return
        if not self._folder.exists(f"{self._cuts}/_SUCCESS"):
            self._write_cuts(rows_of(df, self.spec, [min(months)]))
        made = self._slotted(rows_of(df, self.spec, months))
        # One file per month and task of the shuffle would be many small ones: a month has few rows here.
        (
            made.repartition("month")
            .write.mode("overwrite")
            .option("partitionOverwriteMode", "dynamic")
            .partitionBy("month")
            .parquet(self._counts)
        )

    def drop(self, month: dt.date) -> None:
        """Take a month out of the ledger."""
        self._folder.delete(f"{self._counts}/month={month}")

    def _write_cuts(self, first: DataFrame) -> None:
        names = self.spec.features(first.columns)
        values = _doubles(first, names)
        shares = ", ".join(f"{i / CUT_POINTS}D" for i in range(CUT_POINTS + 1))
        rows: list[tuple[str, list[float]]] = []
        for at in range(0, len(names), FEATURES_AT_ONCE):
            part = names[at : at + FEATURES_AT_ONCE]
            # Sketches are combined in groups of tasks first, so that no task merges all of them.
            group = F.spark_partition_id() % int(self.spark.conf.get("spark.sql.shuffle.partitions"))
            sketches = first.groupBy(group.alias("_group")).agg(
                *(
                    F.kll_sketch_agg_double(_finite(values[c]), SKETCH_SIZE).alias(f"k{i}")
                    for i, c in enumerate(part)
                )
            )
            merged = sketches.agg(
                *(F.expr(f"kll_merge_agg_double(k{i})").alias(f"k{i}") for i in range(len(part)))
            ).selectExpr(
                *(
                    f"CASE WHEN kll_sketch_get_n_double(k{i}) > 0 "
                    f"THEN kll_sketch_get_quantile_double(k{i}, array({shares})) END AS k{i}"
                    for i in range(len(part))
                )
            )
            found = merged.first()
            rows += [(c, sorted({p + 0.0 for p in found[f"k{i}"] or []}) or [0.0]) for i, c in enumerate(part)]
        self.spark.createDataFrame(rows, _CUTS).coalesce(1).write.mode("overwrite").parquet(self._cuts)

    def _slotted(self, rows: DataFrame) -> DataFrame:
        """Counts of rows per feature, slot and month; combined on the map side to one row per slot and task."""
        cuts = self.cuts()
        names = list(cuts)
        values = _doubles(rows, names)
        slim = rows.select(
            month_start(self.spec.date).alias("month"), *(values[c].alias(f"v{i}") for i, c in enumerate(names))
        )
        bucketed = with_buckets(slim, {f"v{i}": cuts[c] for i, c in enumerate(names)})
        structs = ", ".join(f"named_struct('feature', {i}, 'slot', {_slot_sql(f'v{i}', cuts[c])})" for i, c in enumerate(names))
        long = bucketed.selectExpr("month", f"inline(array({structs}))")
        counted = long.groupBy("feature", "slot", "month").agg(F.count(F.lit(1)).alias("n"))
        label = F.element_at(F.array(*(F.lit(c) for c in names)), F.col("feature") + 1)
        return counted.select(label.alias("feature"), "slot", "n", "month")

    def bounds(self) -> DataFrame:
        """Least and greatest possible distance of each feature and later month: ``feature, month, least, most``.

        A row per feature, month and slot is all that is moved, whatever the number of rows behind it.
        """
        counts = self.counts()
        features = counts.select("feature").distinct()
        first = self.months()[:1]
        if not first:
            return self.spark.createDataFrame([], "feature string, month date, least double, most double")
        reference = F.lit(first[0])
        present = counts.filter("slot >= 0")
        ref = present.filter(F.col("month") == reference).select("feature", "slot", F.col("n").alias("ref"))
        later = present.filter(F.col("month") != reference)
        # Slots that either month fills: those of the reference are repeated for each later month of the calendar.
        own = later.select("feature", "month", "slot", F.col("n").alias("own"), F.lit(0).cast("bigint").alias("ref"))
        others = F.array(*(F.lit(m) for m in self.months()[1:])).cast("array<date>")
        spread = ref.select("feature", F.explode(others).alias("month"), "slot", F.lit(0).cast("bigint").alias("own"), "ref")
        both = own.unionByName(spread).groupBy("feature", "month", "slot").agg(F.sum("own").alias("own"), F.sum("ref").alias("ref"))
        upto = Window.partitionBy("feature", "month").orderBy("slot")
        whole = Window.partitionBy("feature", "month")
        steps = both.select(
            "feature", "month", "slot", "own", "ref",
            F.sum("own").over(upto).alias("own_upto"), F.sum("ref").over(upto).alias("ref_upto"),
            F.sum("own").over(whole).alias("own_all"), F.sum("ref").over(whole).alias("ref_all"),
        )

        def gap(ref_sum: Column, own_sum: Column) -> Column:
            return F.abs(F.try_divide(ref_sum, F.col("ref_all")) - F.try_divide(own_sum, F.col("own_all")))

        at_end = gap(F.col("ref_upto"), F.col("own_upto"))
        # Inside an open slot, all of one side may come before all of the other.
        ref_first = gap(F.col("ref_upto"), F.col("own_upto") - F.col("own"))
        own_first = gap(F.col("ref_upto") - F.col("ref"), F.col("own_upto"))
        inside = F.when((F.col("slot") % 2 == 0) & (F.col("own") > 0) & (F.col("ref") > 0), F.greatest(ref_first, own_first))
        measured = steps.groupBy("feature", "month").agg(
            F.max(at_end).alias("least"), F.max(F.greatest(at_end, F.coalesce(inside, at_end))).alias("most")
        )
        # A feature or month without values has distance 0.
        every = features.select("feature", F.explode(others).alias("month"))
        nothing = F.lit(0.0)
        return every.join(measured, ["feature", "month"], "left").select(
            "feature", "month", F.coalesce("least", nothing).alias("least"), F.coalesce("most", nothing).alias("most")
        )

    def distances(self, df: DataFrame, threshold: float = DRIFT_THRESHOLD) -> DataFrame:
        """``feature, month, ks`` that ``shifting_features`` answers from as from exact distances.

        A month is exact where its bounds cannot tell on which side of the threshold it lies, or where it may be the peak of
        a shifting feature. Elsewhere the lower bound stands in: it is on the same side, and below the peak.
        """
        bounds = self.bounds()
        peak = F.max("least").over(Window.partitionBy("feature"))
        unsure = (F.col("least") <= threshold + NEAR) & (F.col("most") > threshold - NEAR)
        may_be_peak = (F.col("most") - F.col("least") > NEAR) & (F.col("most") > F.greatest(peak, F.lit(threshold)))
        marked = bounds.withColumn("is_open", unsure | may_be_peak)
        # Names of columns and months of the calendar, bounded by the table's width and span.
        still = marked.filter("is_open").agg(
            F.sort_array(F.collect_set("feature")).alias("features"), F.sort_array(F.collect_set("month")).alias("months")
        ).first()
        known = marked.select("feature", month_key("month").alias("month"), "least", "is_open")
        if not still["features"]:
            return known.select("feature", "month", F.col("least").alias("ks"))
        reference = self.months()[0]
        exact = ks_by_month(rows_of(df, self.spec, [reference, *still["months"]]), self.spec, still["features"])
        joined = known.join(exact.withColumnRenamed("ks", "exact"), ["feature", "month"], "left")
        return joined.select("feature", "month", F.coalesce("exact", "least").alias("ks"))

    def shifting(self, df: DataFrame, threshold: float = DRIFT_THRESHOLD) -> DataFrame:
        """The exact shifting features of all months in the ledger."""
        return shifting_features(self.distances(df, threshold), threshold)


def rows_of(df: DataFrame, spec: PipelineSpec, months: Sequence[dt.date]) -> DataFrame:
    """Rows of these months from the training start on, by ranges of the date that reach the scan; following months are one range."""
    date = F.col(spec.date)
    ranges: list[list[dt.date]] = []
    for month in sorted(set(months)):
        after = (month.replace(day=1) + dt.timedelta(days=32)).replace(day=1)
        if ranges and ranges[-1][1] == month:
            ranges[-1][1] = after
        else:
            ranges.append([month, after])
    bound = as_date if isinstance(df.schema[spec.date].dataType, T.DateType) else as_time
    within = F.lit(False)
    for start, end in ranges:
        within = within | ((date >= bound(start)) & (date < bound(end)))
    return drift_rows(df, spec).filter(within)


def _doubles(df: DataFrame, names: Sequence[str]) -> dict[str, Column]:
    """Values as doubles; a feature that is no number, or is not there, has none."""
    types = {f.name: f.dataType for f in df.schema.fields}
    number = (T.NumericType, T.BooleanType)
    return {c: present_double(c) if isinstance(types.get(c), number) else F.lit(None).cast("double") for c in names}


def _finite(value: Column) -> Column:
    return F.when(F.abs(value) < float("inf"), value)


def _slot_sql(value: str, cuts: Sequence[float]) -> str:
    """Odd for a cut point, even for the gap behind it; 0 is below the first, -1 has no value."""
    points = ", ".join(f"{p!r}D" for p in cuts)
    return (
        f"CASE WHEN {value}_bucket <= 0 THEN {value}_bucket "
        f"WHEN {value} = element_at(array({points}), {value}_bucket) THEN 2 * {value}_bucket - 1 ELSE 2 * {value}_bucket END"
    )
