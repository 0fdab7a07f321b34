"""The drift ledger: its answers are the exact ones, and a new month reads that month."""

import datetime as dt
import random

import pytest

from cohortloom.operators import drift
from cohortloom.operators.ledger import DriftLedger, rows_of
from cohortloom.spec import PipelineSpec

SPEC = PipelineSpec(id_columns=("id",), target="label", date="day", train_start="2024-01-01")
SCHEMA = "id long, label int, day date, smooth double, steps int, hot double, flag boolean, word string, gone double"


def rows(months=6, n=400, seed=1):
    draw = random.Random(seed)
    found = []
    for month in range(1, months + 1):
        for i in range(n):
            smooth = draw.choice([None, float("nan"), float("inf"), -0.0, 0.0]) if i % 17 == 0 else draw.gauss(month / 4, 1)
            # A third of the rows and one value; the rest moves from the fourth month on.
            hot = 7.0 if i % 3 == 0 else draw.random() + (2 if month > 3 else 0)
            day = dt.date(2024, month, draw.randrange(1, 29))
            found.append((i, i % 2, day, smooth, draw.randrange(4), hot, draw.random() < 0.5, "w", None))
    return found + [(1, 0, None, 1.0, 1, 1.0, True, "no date", 1.0), (2, 0, dt.date(2023, 12, 31), 9.0, 9, 9.0, True, "early", 9.0)]


@pytest.fixture(scope="module")
def table(spark):
    return spark.createDataFrame(rows(), SCHEMA).repartition(5).cache()


@pytest.fixture(scope="module")
def exact(table):
    return {(r.feature, r.month): r.ks for r in drift.ks_by_month(table, SPEC).collect()}


@pytest.fixture(scope="module")
def book(spark, table, tmp_path_factory):
    ledger = DriftLedger(spark, str(tmp_path_factory.mktemp("ledger")), SPEC)
    assert ledger.update(table) == [dt.date(2024, m, 1) for m in range(1, 7)]
    return ledger


def test_exact_distances_lie_within_the_bounds(book, exact):
    bounds = {(r.feature, f"{r.month:%Y-%m}"): r for r in book.bounds().collect()}
    assert bounds.keys() == exact.keys()
    for key, ks in exact.items():
        assert bounds[key].least - 1e-12 <= ks <= bounds[key].most + 1e-12, key
    few = [r for (feature, _), r in bounds.items() if feature in ("steps", "flag", "word", "gone")]
    assert all(r.least == r.most for r in few)
    assert all(r.most - r.least < 0.1 for r in bounds.values())


@pytest.mark.parametrize("threshold", [0.0, 0.03, 0.05, 0.1, 0.2, 0.3, 0.5, 0.9])
def test_shifting_features_are_the_exact_ones(book, table, exact, threshold):
    expected = {}
    for (feature, month), ks in sorted(exact.items()):
        if ks > threshold:
            first, peak = expected.get(feature, (month, ks))
            expected[feature] = (first, max(peak, ks))
    found = book.shifting(table, threshold).collect()
    assert {r.feature: r.first_month for r in found} == {f: first for f, (first, _) in expected.items()}
    for r in found:
        assert r.peak_ks == pytest.approx(expected[r.feature][1], abs=1e-9)


def test_a_threshold_equal_to_a_distance(book, table, exact):
    for ks in sorted({ks for (feature, _), ks in exact.items() if feature == "steps"})[-2:]:
        found = {r.feature: r.first_month for r in book.shifting(table, ks).collect()}
        plain = drift.shifting_features(drift.ks_by_month(table, SPEC), ks).collect()
        assert found == {r.feature: r.first_month for r in plain}


def test_months_come_one_by_one(spark, table, book, tmp_path):
    ledger = DriftLedger(spark, str(tmp_path / "one"), SPEC)
    for month in range(2, 8):
        early = table.filter(f"day < DATE '2024-{month:02}-01' OR day IS NULL")
        assert ledger.update(early) == [dt.date(2024, month - 1, 1)]
    assert ledger.update(table) == []
    order = ["month", "feature", "slot", "n"]
    assert ledger.counts().select(order).sort(order).collect() == book.counts().select(order).sort(order).collect()


def test_a_month_is_counted_anew(spark, table, tmp_path):
    ledger = DriftLedger(spark, str(tmp_path / "anew"), SPEC)
    ledger.update(table)
    march = dt.date(2024, 3, 1)
    late = table.unionByName(table.filter("month(day) = 3"))
    ledger.add(late, [march])
    n = {r.month: r.n for r in ledger.counts().filter("feature = 'steps'").groupBy("month").sum("n").toDF("month", "n").collect()}
    assert n[march] == 800 and n[dt.date(2024, 2, 1)] == 400
    ledger.drop(march)
    assert march not in ledger.months() and ledger.update(table) == [march]


def test_cut_points_of_another_month_change_nothing(spark, table, exact, tmp_path):
    ledger = DriftLedger(spark, str(tmp_path / "later"), SPEC)
    ledger.add(table, [dt.date(2024, 6, 1)])
    ledger.update(table)
    for r in ledger.bounds().collect():
        assert r.least - 1e-12 <= exact[r.feature, f"{r.month:%Y-%m}"] <= r.most + 1e-12
    plain = drift.shifting_features(drift.ks_by_month(table, SPEC), 0.3).collect()
    assert [(r.feature, r.first_month) for r in ledger.shifting(table, 0.3).collect()] == [
        (r.feature, r.first_month) for r in plain
    ]


def test_a_new_month_reads_that_month(spark, tmp_path):
    spark.createDataFrame(rows(3, 50), SCHEMA).write.parquet(str(tmp_path / "table"))
    df = spark.read.parquet(str(tmp_path / "table"))
    spark.conf.set("spark.sql.maxMetadataStringLength", 1000)
    try:
        text = rows_of(df, SPEC, [dt.date(2024, 2, 1)])._jdf.queryExecution().executedPlan().toString()
    finally:
        spark.conf.unset("spark.sql.maxMetadataStringLength")
    pushed = next(line for line in text.splitlines() if "PushedFilters" in line)
    assert "2024-02-01" in pushed and "2024-03-01" in pushed


def test_nothing_to_compare(spark, table, tmp_path):
    ledger = DriftLedger(spark, str(tmp_path / "none"), SPEC)
    assert ledger.update(table.limit(0)) == [] and ledger.months() == []
    assert ledger.bounds().count() == 0 and ledger.shifting(table).count() == 0
    ledger.update(table.filter("month(day) = 1"))
    assert ledger.bounds().count() == 0 and ledger.shifting(table).count() == 0
