"""Order statistics over many tasks: value buckets and running totals.

A window ordered by value over a whole table would run in one task. Here every
value gets a bucket from quantile cut points. Buckets rise with the value and
equal values share one, so windows inside a bucket plus the totals of the
buckets below give exact running sums. Cut points only steer balance: any cut
points give the same results.
"""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.ml.feature import Bucketizer
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from cohortloom.session import shuffle_width

#: Columns whose cut points come to the driver in one row: so many times the buckets numbers at most.
COLUMNS_AT_ONCE = 50
_MISSING = -1


def bucket_count(df: DataFrame) -> int:
    """As many as shuffles have partitions: the width that the session is set to."""
    return max(2, shuffle_width(df.sparkSession))


def value_cuts(
    df: DataFrame,
    columns: Sequence[str],
    span: str | None = None,
    buckets: int | None = None,
) -> tuple[dict[str, list[float]], tuple | None]:
    """Quantile cut points of double columns, and the least and greatest ``span``.

    Sketches of all tasks in one task would be too much, so groups of tasks are
    merged first and the quantiles of their quantiles are taken. One row comes
    back: ``buckets - 1`` numbers per column. Many columns take several jobs.
    """
    n = buckets or bucket_count(df)
    found: dict[str, list[float]] = {}
    edges = None
    for at in range(0, max(1, len(columns)), COLUMNS_AT_ONCE):
        part, edges = _cuts_of(df, columns[at : at + COLUMNS_AT_ONCE], span, n)
        found |= part
    return found, edges


def _cuts_of(
    df: DataFrame, columns: Sequence[str], span: str | None, n: int
) -> tuple[dict[str, list[float]], tuple | None]:
    shares = ", ".join(f"{i / n}D" for i in range(1, n))
    accuracy = max(1000, 4 * n)
    names = {c: f"_cuts_{i}" for i, c in enumerate(columns)}
    edge = span or "CAST(NULL AS INT)"
    group = F.spark_partition_id() % shuffle_width(df.sparkSession)
    parts = df.groupBy(group.alias("_group")).agg(
        F.expr(f"min({edge}) AS _first"),
        F.expr(f"max({edge}) AS _last"),
        *(F.expr(f"percentile_approx(`{c}`, array({shares}), {accuracy}) AS {name}") for c, name in names.items()),
    )
    points = parts.withColumn("_at", F.explode(F.sequence(F.lit(1), F.lit(n - 1))))
    row = points.agg(
        F.expr("min(_first) AS first"),
        F.expr("max(_last) AS last"),
        *(
            F.expr(f"percentile_approx(element_at({name}, _at), array({shares}), {accuracy}) AS {name}")
            for name in names.values()
        ),
    ).first()
    edges = None if row["first"] is None else (row["first"], row["last"])
    return {c: sorted(set(row[name] or [])) for c, name in names.items()}, edges


def with_buckets(df: DataFrame, cuts: Mapping[str, Sequence[float]]) -> DataFrame:
    """Add ``<column>_bucket`` for each column; missing values get bucket -1."""
    edges = {c: _edges(points) for c, points in cuts.items()}
    if not edges:
        return df
    names = {c: f"{c}_bucket" for c in edges}
    # The bucketizer puts -0.0 below 0.0, although they are equal values.
    df = df.withColumns({c: F.col(c) + F.lit(0.0) for c in edges})
    bucketizer = Bucketizer(
        splitsArray=list(edges.values()),
        inputCols=list(edges),
        outputCols=list(names.values()),
        handleInvalid="keep",
    )
    # Never null, so that joins on the bucket push no null filter into one side
    # and the sides can share an exchange.
    missing = F.lit(_MISSING)
    return bucketizer.transform(df).withColumns(
        {name: F.coalesce(F.col(name).cast("int"), missing) for name in names.values()}
    )


def _edges(points: Sequence[float]) -> list[float]:
    infinity = float("inf")
    inner = [p + 0.0 for p in points if -infinity < p < infinity] or [0.0]
    return [-infinity, *inner, infinity]


def inside_bucket(group: Sequence[str], value: str, bucket: str = "bucket") -> Window:
    """All rows of the bucket with a value up to the current one, ties included."""
    return Window.partitionBy(*group, bucket).orderBy(value).rangeBetween(
        Window.unboundedPreceding, Window.currentRow
    )


def buckets_below(group: Sequence[str], bucket: str = "bucket") -> Window:
    """The buckets of a group before the current one; for small per-bucket tables."""
    return Window.partitionBy(*group).orderBy(bucket).rangeBetween(Window.unboundedPreceding, -1)


def running_totals(
    counts: DataFrame,
    group: Sequence[str],
    value: str,
    sums: Sequence[str],
    bucket: str = "bucket",
) -> DataFrame:
    """Add exact ``<c>_upto`` (running sum by value) and ``<c>_all`` (group total) for ``sums``.

    ``counts`` has one row per group, bucket and value. The per-bucket totals
    are read from the same exchange; they are joined without a hint, so that
    adaptive execution broadcasts them only when their measured size is small.
    """
    keys = [*group, bucket]
    totals = counts.groupBy(*keys).agg(*(F.sum(c).alias(c) for c in sums))
    below, whole = buckets_below(group, bucket), Window.partitionBy(*group)
    offsets = totals.select(
        *keys,
        *(F.coalesce(F.sum(c).over(below), F.lit(0)).alias(f"{c}_below") for c in sums),
        *(F.sum(c).over(whole).alias(f"{c}_all") for c in sums),
    )
    inner = inside_bucket(group, value, bucket)
    ranked = counts.withColumns({f"{c}_upto": F.sum(c).over(inner) for c in sums})
    joined = ranked.join(offsets, keys)
    return joined.withColumns({f"{c}_upto": F.col(f"{c}_upto") + F.col(f"{c}_below") for c in sums}).drop(
        *(f"{c}_below" for c in sums)
    )
