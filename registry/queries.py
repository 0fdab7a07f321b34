"""One query per operator, each over whole tables: ``query(spark, folder) -> DataFrame``."""

from __future__ import annotations

from dataclasses import replace

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

from cohortloom.functions import columns as C
from cohortloom.operators import drift, evaluate, features, ledger, prepare, quality, runlog, split, tiles
from cohortloom.operators import score as scoring
from cohortloom.operators import train as training
from cohortloom.plans.checked import run_checked
from cohortloom.plans.pipeline import run_pipeline
from cohortloom.plans.stages import StageStore
from cohortloom.session import fresh_folder, use_utc
from cohortloom.sources import readers, writers
from cohortloom.spec import FeatureSpec, PipelineSpec

AS_OF = "2024-01-31"
LOOKBACK_AS_OF = "2024-01-21"
LOOKBACK_DAYS = 14
ZONE = "Asia/Jakarta"
WINDOWS = ("l1d", "l3d", "l7d", "l14d", "l30d", "l60d", "l90d")
SHORT_WINDOWS = ("l1d", "l3d", "l7d", "l14d", "l30d")
CONDITIONS = ["TRUE", {"is_error": "is_error"}, {"is_noterror": "(NOT is_error)"}]
OOT_START = "2000-01-01"
DRIFT_START = "1996-01-01"
LOW_THRESHOLD = 0.1
LEDGER_THRESHOLD = 0.07

ORDERS = PipelineSpec(
    id_columns=("o_orderkey",),
    target="o_orderstatus",
    date="o_orderdate",
    train_start="1995-01-01",
    ignored=("o_custkey",),
)
LINEITEM = PipelineSpec(
    id_columns=("l_orderkey", "l_linenumber"),
    target="l_linestatus",
    date="l_shipdate",
    train_start=DRIFT_START,
    ignored=("l_partkey", "l_suppkey", "l_returnflag"),
)


def table(spark: SparkSession, folder: str, name: str) -> DataFrame:
    return readers.scan_parquet(use_utc(spark), f"{folder}/{name}.parquet")


def event_spec(columns: dict[str, list[str]], windows: tuple[str, ...] = WINDOWS) -> FeatureSpec:
    return FeatureSpec.from_dict(
        {
            "feature_category": "event_hist_l90d_v1",
            "feature_type": "batch",
            "created_by": "events",
            "team_name": "analytics",
            "entities": ["user_id", "partition_date"],
            "col_agg_dict": {
                c: {"conditions": [True, False, False, True], "aggregations": aggs} for c, aggs in columns.items()
            },
            "condition_name_0": CONDITIONS,
            "condition_name_1": ["TRUE"],
            "condition_name_2": ["TRUE"],
            "time_cond_dict": list(windows),
        }
    )


WIDE = {
    "event_id": ["COUNT"],
    "is_error": ["MIN", "MAX", "AVG"],
    "scaled_diff_event_unix_ts": ["MIN", "MAX", "AVG"],
    "event_unix_ts": ["MIN", "MAX"],
    "value": ["MIN", "MAX"],
    "value_cents": ["AVG", "STDDEV"],
}
# Decimals kept where the two engines may add doubles in different orders.
AVERAGE_DIGITS, DEVIATION_DIGITS = 8, 4


def prepared_events(spark: SparkSession, folder: str) -> DataFrame:
    """The events of 90 days before the snapshot with flags, window membership and scaled time."""
    events = table(spark, folder, "events")
    kept = events.filter(readers.lookback_time_range("ts", AS_OF))
    time, as_of = F.col("event_unix_ts"), C.as_of_millis(AS_OF, ZONE)
    return kept.select(
        "user_id",
        C.as_date(AS_OF).alias("partition_date"),
        "event_id",
        "value",
        F.round(F.col("value") * 100).cast("bigint").alias("value_cents"),
        C.flag_case("event_type", "error").alias("is_error"),
        C.epoch_millis("ts").alias("event_unix_ts"),
    ).withColumns(
        {**C.window_flags(time, as_of, WINDOWS), "scaled_diff_event_unix_ts": C.scaled_time(time, as_of)}
    )


def rounded(df: DataFrame) -> DataFrame:
    """Cut averages and deviations to the decimals that do not depend on summation order."""

    def cut(name: str) -> str:
        if name.startswith("stddev_"):
            return f"round({name}, {DEVIATION_DIGITS}) AS {name}"
        if name.startswith("avg_") and "scaled" in name:
            return f"round({name}, {AVERAGE_DIGITS}) AS {name}"
        return name

    return df.selectExpr(*(cut(c) for c in df.columns))


def event_features(columns: dict[str, list[str]], windows: tuple[str, ...] = WINDOWS):
    def query(spark: SparkSession, folder: str) -> DataFrame:
        wide = features.wide_features(prepared_events(spark, folder), event_spec(columns, windows))
        return rounded(wide)

    return query


SNAPSHOTS = tuple(f"2024-01-{day:02}" for day in range(2, 32))
TILED = {
    "event_id": ["COUNT"],
    "is_error": ["MAX", "AVG"],
    "event_unix_ts": ["MAX"],
    "value": ["MIN", "MAX"],
    "value_cents": ["AVG", "STDDEV"],
}


def feat_snapshots(spark, folder):
    """Features of every user for each of 30 snapshots, from one scan."""
    events = table(spark, folder, "events").select(
        "user_id",
        "event_id",
        "value",
        F.round(F.col("value") * 100).cast("bigint").alias("value_cents"),
        C.flag_case("event_type", "error").alias("is_error"),
        C.epoch_millis("ts").alias("event_unix_ts"),
    )
    spec = event_spec(TILED, SHORT_WINDOWS)
    return rounded(tiles.snapshot_features(events, spec, F.col("event_unix_ts"), SNAPSHOTS, ZONE))


# --- scans and sinks


def scan_parquet(spark, folder):
    return table(spark, folder, "orders")


def scan_table(spark, folder):
    table(spark, folder, "events").createOrReplaceTempView("login_events")
    renames = {"customer_id": "user_id", "login_ts": "ts", "login_id": "event_id"}
    return readers.scan_table(spark, "login_events", renames)


def scan_lookback(spark, folder):
    events = table(spark, folder, "events").select("event_id", "user_id", "ts")
    by_time = events.filter(readers.lookback_time_range("ts", LOOKBACK_AS_OF, LOOKBACK_DAYS))
    keyed = by_time.withColumn("create_date", F.date_format("ts", readers.PARTITION_KEY_FORMAT))
    return keyed.filter(readers.lookback_range("create_date", LOOKBACK_AS_OF, LOOKBACK_DAYS))


def sink_csv(spark, folder):
    report = monthly_performance(spark, folder)
    path = writers.write_csv(report, fresh_folder(spark, "csv"))
    return spark.read.schema(report.schema).option("header", True).option("escape", '"').csv(path)


def sink_json(spark, folder):
    report = monthly_stats(spark, folder)
    path = writers.write_json(report, fresh_folder(spark, "json"))
    return spark.read.schema(report.schema).json(path)


def sink_by_date(spark, folder):
    wide = event_features({"event_id": ["COUNT"], "value": ["MIN", "MAX"]}, SHORT_WINDOWS)(spark, folder)
    stamped = C.stamp_date(wide, AS_OF)
    path = writers.write_by_date(stamped, fresh_folder(spark, "by-date"), "partition_date")
    return spark.read.schema(stamped.schema).parquet(path).select(*stamped.columns)


# --- projections, filters, derived columns


def filter_conjunction(spark, folder):
    flags = {"l_returnflag": "R", "l_linestatus": "F", "l_linenumber": 1}
    return readers.filter_equal(table(spark, folder, "lineitem"), flags)


def flag_case(spark, folder):
    events = table(spark, folder, "events")
    kind = F.nullif(F.col("event_type"), F.lit("view"))
    return events.select("event_id", kind.alias("kind")).withColumn("is_error", C.flag_case("kind", "error"))


def as_of_millis(spark, folder):
    date = F.col("o_orderdate").cast("date")
    return table(spark, folder, "orders").select("o_orderkey", C.as_of_millis(date, ZONE).alias("as_of_ms"))


def window_flags(spark, folder):
    events = table(spark, folder, "events")
    flags = C.window_flags(C.epoch_millis("ts"), C.as_of_millis(AS_OF, ZONE), WINDOWS)
    return events.select("event_id", *(flag.alias(name) for name, flag in flags.items()))


def scaled_time(spark, folder):
    events = table(spark, folder, "events")
    scaled = C.scaled_time(C.epoch_millis("ts"), C.as_of_millis(AS_OF, ZONE))
    return events.select("event_id", scaled.alias("scaled_ts"))


def days_since(spark, folder):
    orders = table(spark, folder, "orders")
    days = C.days_since(C.epoch_millis("o_orderdate"), C.as_of_millis(AS_OF, ZONE))
    return orders.select("o_orderkey", days.alias("days_since"))


def stamp_etl_date(spark, folder):
    return C.stamp_date(table(spark, folder, "nation"), AS_OF)


def project_roles(spark, folder):
    return prepare.project_roles(table(spark, folder, "orders"), ORDERS)


def holed_orders(spark: SparkSession, folder: str) -> DataFrame:
    """Orders with nulls and NaN put into a number and a text column."""
    price = (
        F.when(F.col("o_orderstatus") == "P", F.lit(None))
        .when(F.col("o_orderpriority") == "2-HIGH", F.lit(float("nan")))
        .otherwise(F.col("o_totalprice"))
    )
    return table(spark, folder, "orders").withColumns(
        {"o_totalprice": price, "o_orderpriority": F.nullif(F.col("o_orderpriority"), F.lit("5-LOW"))}
    )


def fill_sentinel(spark, folder):
    key = F.col("o_orderkey")
    gap = key % 7 == 0
    narrow = holed_orders(spark, folder).withColumns(
        {
            "tiny": F.when(~gap, key % 100).cast("tinyint"),
            "small": F.when(~gap, key % 1000).cast("smallint"),
            "cents": F.when(~gap, (key % 10) / 4).cast("decimal(5,2)"),
            "even": F.when(~gap, key % 2 == 0),
        }
    )
    return prepare.fill_sentinel(narrow)


def ceil_2dp(spark, folder):
    columns = ["l_quantity", "l_extendedprice", "l_tax", "l_linenumber", "l_returnflag"]
    taxed = table(spark, folder, "lineitem").withColumn("l_tax", F.col("l_extendedprice") * F.col("l_tax"))
    return prepare.ceil_2dp(taxed, columns).select("l_orderkey", *columns)


def coerce_date(spark, folder):
    text = F.date_format("o_orderdate", "yyyy-MM-dd")
    orders = table(spark, folder, "orders").select("o_orderkey", text.alias("o_orderdate"))
    return prepare.coerce_date(orders, "o_orderdate")


def month_key(spark, folder):
    return table(spark, folder, "orders").select("o_orderkey", C.month_key("o_orderdate").alias("month"))


def narrow_integers(spark, folder):
    columns = ["l_orderkey", "l_partkey", "l_suppkey", "l_linenumber", "l_quantity"]
    return prepare.narrow_integers(table(spark, folder, "lineitem").select(*columns))


# --- data quality


def dup_count(spark, folder):
    return quality.duplicate_count(table(spark, folder, "lineitem"), [*LINEITEM.id_columns, LINEITEM.target])


def class_count(spark, folder):
    return quality.class_count(table(spark, folder, "labels"), "quality").select("class_count")


def date_overlap(spark, folder):
    return quality.date_span(table(spark, folder, "orders"), "o_orderdate").withColumn(
        "passed", ~((F.col("min_date") > C.as_time(DRIFT_START)) | (F.col("max_date") < C.as_time(DRIFT_START)))
    )


def binary_target(spark, folder):
    orders = table(spark, folder, "orders").withColumn(
        "o_orderstatus", F.nullif(F.col("o_orderstatus"), F.lit("P"))
    )
    counts = quality.class_count(orders, "o_orderstatus")
    return counts.withColumn("passed", F.col("value_count") == 2)


def validation_report(spark, folder):
    return quality.validation_report(table(spark, folder, "orders"), ORDERS)


# --- splits


def tagged(df: DataFrame, part: Column) -> DataFrame:
    return split.union_splits(df, part).withColumn("split", part)


def orders_part(date: str = "o_orderdate") -> Column:
    return split.part_of(replace(ORDERS, date=date), OOT_START)


def split_oot(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderstatus", "o_orderdate")
    dated = orders.withColumn("o_orderdate", F.when(F.col("o_orderstatus") != "P", F.col("o_orderdate")))
    return tagged(dated, orders_part())


def split_last_month(spark, folder):
    events = table(spark, folder, "events").select("event_id", "ts")
    return tagged(events, split.part_of(replace(ORDERS, date="ts"), split.last_month_start(events, "ts").scalar()))


def sort_by_date(spark, folder):
    orders = table(spark, folder, "orders").select("o_orderkey", "o_orderdate")
    return split.sort_by_date(orders, "o_orderdate")


def split_summary(spark, folder):
    return split.split_summary(table(spark, folder, "orders"), "o_orderdate", orders_part())


def union_splits(spark, folder):
    return split.union_splits(table(spark, folder, "orders"), orders_part())


def distinct_months(spark, folder):
    return split.distinct_months(table(spark, folder, "orders"), "o_orderdate")


def separation(spark: SparkSession, folder: str) -> DataFrame:
    """An importance table from the data itself: the gap between class means of each line item feature.

    Features are in cents, so their sums are exact in any order.
    """
    lineitem = table(spark, folder, "lineitem")
    names = LINEITEM.features(lineitem.columns)
    of = {c: F.round(F.col(c) * 100).cast("bigint") for c in names}
    closed = F.col("l_linestatus") == "F"
    gaps = [
        F.struct(
            F.lit(c).alias("feature"),
            F.abs(F.avg(F.when(closed, v)) - F.avg(F.when(~closed, v))).alias("importance"),
        )
        for c, v in of.items()
    ]
    return lineitem.agg(F.array(*gaps).alias("gaps")).select(F.inline("gaps"))


def top_n_features(spark, folder):
    return training.top_n_features(separation(spark, folder), 3)


def final_features(spark, folder):
    order = Window.orderBy(F.col("importance").desc(), "feature")  # one row per feature name
    ranked = separation(spark, folder).select("feature", F.row_number().over(order).alias("rank"))
    shifting = drift.shifting_features(ks_of_lineitem(spark, folder), LOW_THRESHOLD)
    return training.final_features(ranked, shifting).select("feature", "rank", "fell_back")


# --- drift


def ks_of_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    return drift.ks_by_month(table(spark, folder, "lineitem"), LINEITEM)


def drift_months(spark, folder):
    return drift.drift_months(table(spark, folder, "lineitem"), LINEITEM)


def ks_stat(spark, folder):
    return ks_of_lineitem(spark, folder).withColumn("ks", F.round("ks", 9))


def shifting_features(spark, folder):
    orders = table(spark, folder, "orders")
    ks = drift.ks_by_month(orders, ORDERS)
    return drift.shifting_features(ks).withColumn("peak_ks", F.round("peak_ks", 9))


def shifting_by_ledger(spark, folder):
    """A ledger of the line items' first two years, then the months that it lacks; answered from its counts."""
    lineitem = table(spark, folder, "lineitem")
    book = ledger.DriftLedger(spark, fresh_folder(spark, "ledger"), LINEITEM)
    book.update(lineitem.filter(F.col("l_shipdate") < C.as_time("1998-01-01")))
    book.update(lineitem)
    return book.shifting(lineitem, LEDGER_THRESHOLD).withColumn("peak_ks", F.round("peak_ks", 9))


# --- evaluation


def scored_lineitem(spark: SparkSession, folder: str) -> DataFrame:
    """A tie-heavy score; a division by 64 is exact, so sums do not depend on their order."""
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_shipdate",
        (F.col("l_linestatus") == "F").cast("int").alias("label"),
        (F.col("l_quantity") / 64).alias("score"),
        F.when(F.col("l_shipdate") < C.as_time(OOT_START), "train").otherwise("valid").alias("part"),
    )


def monthly_stats(spark, folder):
    return evaluate.monthly_stats(scored_lineitem(spark, folder), "l_shipdate", "score", "label")


def monthly_auc(spark, folder):
    return evaluate.monthly_auc(scored_lineitem(spark, folder), "l_shipdate", "score", "label")


def monthly_performance(spark, folder):
    return evaluate.monthly_performance(scored_lineitem(spark, folder), "l_shipdate", "score", "label")


def model_auc(spark, folder):
    return evaluate.model_auc(scored_lineitem(spark, folder), "part", "score", "label")


def confusion_best_f1(spark, folder):
    return evaluate.confusion_best_f1(scored_lineitem(spark, folder), "score", "label")


def cv_summary(spark, folder):
    fold = F.nullif(F.col("l_linenumber"), F.lit(7))  # one fold without a number
    scored = scored_lineitem(spark, folder).withColumn("fold", fold)
    folds = evaluate.fold_metrics(scored, "fold", "score", "label")
    return evaluate.cv_summary(folds).withColumns({c: F.round(c, 9) for c in ("mean", "std")})


# --- ranking, training, scoring


def learnable(spark: SparkSession, folder: str) -> DataFrame:
    """Line items with a label that follows from the quantity, missing inputs, and texts that are hard to store."""
    line, quantity = F.col("l_linenumber"), F.col("l_quantity")
    given = F.when(~((line == 2) & (quantity < 5)), quantity)
    return table(spark, folder, "lineitem").select(
        "l_orderkey",
        "l_linenumber",
        "l_shipdate",
        (F.coalesce(given, F.lit(0.0)) > BIG).cast("int").alias("is_big"),
        given.alias("quantity"),
        F.when(line == 3, F.lit(float("nan"))).when(line != 4, F.col("l_discount")).alias("discount"),
        F.when(line != 5, F.col("l_tax")).alias("tax"),
        F.when(line != 6, F.col("l_returnflag") == "R").alias("returned"),
        F.when(line == 1, "")
        .when(line == 2, 'a "b"\nc')
        .when(line == 3, "x,\r\ny")
        .when(line != 4, F.col("l_returnflag"))
        .alias("note"),
    )


BIG = 25.0
INPUTS = ("quantity", "discount", "tax", "returned")
LEARNABLE = PipelineSpec(("l_orderkey", "l_linenumber"), "is_big", "l_shipdate", DRIFT_START, ignored=("note",))


def partly_explained(spark: SparkSession, folder: str) -> DataFrame:
    """The same inputs with a label of which they explain a part; the rest follows from the key."""
    noise = (F.col("l_orderkey") * 7 + F.col("l_linenumber") * 3) % 11
    pull = F.coalesce("quantity", F.lit(0.0)) + F.col("l_linenumber") * F.coalesce(F.col("returned").cast("int"), F.lit(2))
    return learnable(spark, folder).withColumn("is_big", (pull + 4 * noise > 48).cast("int"))


def feature_importance(spark, folder):
    ranked = training.feature_importance(learnable(spark, folder), INPUTS, LEARNABLE.target)
    return ranked.withColumn("importance", F.round("importance", 6))


def split_gains(spark, folder):
    gains = training.split_gains(partly_explained(spark, folder), INPUTS, LEARNABLE.target)
    return gains.withColumn("gain", F.round("gain", 1))


def class_weights(spark, folder):
    return training.class_weights(table(spark, folder, "labels"), "quality")


def class_balance(spark, folder):
    drawn = training.balanced_rows(table(spark, folder, "labels"), "toxic", ["doc_id"])
    return drawn.groupBy(F.col("toxic").alias("class")).agg(
        F.count(F.lit(1)).alias("n_drawn"),
        F.count_distinct("doc_id").alias("n_rows"),
        F.max("replica").cast("bigint").alias("max_replica"),
        F.sum(F.col("doc_id") * (F.col("replica") + 1)).alias("checksum"),
    )


def permutation_drops(spark, folder):
    rows = pipeline_rows(spark, folder).select(
        "l_orderkey", "l_linenumber", "l_linestatus", "quantity",
        F.round(F.col("discount") * 100).alias("discount"), F.round(F.col("tax") * 100).alias("tax"),
    )
    noise = (F.col("l_orderkey") * 7 + F.col("l_linenumber") * 3) % 11
    rows = rows.withColumn("label", (F.col("quantity") + 2 * F.col("discount") + 4 * noise > 55).cast("int"))
    drops = training.permutation_drops(
        rows,
        ["quantity", "discount", "tax"],
        lambda df: df.withColumn("score", 3 * F.col("quantity") + 5 * F.col("discount") - F.col("tax")),
        "label",
        "score",
        ["l_orderkey", "l_linenumber", "l_linestatus"],
        rings=16,
    )
    return drops.withColumns({c: F.round(c, 9) for c in ("auc", "auc_drop")})


def train_leaderboard(spark, folder):
    board = training.train(partly_explained(spark, folder), LEARNABLE, INPUTS).leaderboard
    return board.select("rank", "model", "settings", "auc", "rung")


def stacked_model(spark, folder):
    rows = learnable(spark, folder)
    model = training.train(rows, LEARNABLE, INPUTS).models[training.STACK]
    return training.score(model, rows).select("l_orderkey", "l_linenumber", "is_big", "prediction")


def varimp(spark, folder):
    rows = learnable(spark, folder)
    trained = training.train(rows, LEARNABLE, INPUTS)
    table_ = training.varimp(rows, trained.leader, INPUTS, LEARNABLE.target, trained.positive)
    return table_.withColumn("relative_importance", F.round("relative_importance", 6))


def batch_predict(spark, folder):
    rows, path = learnable(spark, folder), fresh_folder(spark, "model")
    training.train(rows, LEARNABLE, INPUTS).leader.write().save(path)
    scored = scoring.batch_predict(path, rows, fresh_folder(spark, "scored"))
    return scored.select(*rows.columns, "prediction")


def predict_registered(spark, folder):
    rows, home = learnable(spark, folder), fresh_folder(spark, "models")
    model = training.fit_one(rows, LEARNABLE, INPUTS, training.DEFAULT_GRID[0])
    scoring.save_model(model, f"{home}/9", rows)
    listed = [("big", "10", "Staging", f"{home}/10"), ("big", "9", "Production", f"{home}/9"), ("big", "8", "Production", f"{home}/8")]
    versions = spark.createDataFrame(listed, "name string, version string, stage string, source string")
    scored = scoring.predict_registered(rows, versions, "big", stage="Production")
    return scored.select("l_orderkey", "l_linenumber", "is_big", "prediction")


def predict_proba(spark, folder):
    scored = scored_lineitem(spark, folder).select(
        "l_orderkey",
        (F.col("score") > 0.5).cast("int").alias("predict"),
        (1 - F.col("score")).alias("p0"),
        F.col("score").alias("p1"),
    )
    return scoring.predict_proba(scored)


# --- stages


def run_stage(spark, folder):
    store = StageStore(spark, fresh_folder(spark, "stages"))
    for _ in range(2):  # computed, then loaded
        stored = store.run_stage(
            "preprocessed_data", lambda: prepare.preprocess(holed_orders(spark, folder), ORDERS, check=False)
        )
    return stored


def run_stage_months(spark, folder):
    store, rows = StageStore(spark, fresh_folder(spark, "stages")), holed_orders(spark, folder)
    month = C.month_key(C.month_start("o_orderdate"))
    for part in (rows.filter(F.col("o_orderdate") < "1998-01-01"), rows):  # the second run adds the months of 1998
        stored = store.run_parts("preprocessed_data", part, month, lambda df: prepare.preprocess(df, ORDERS, check=False))
    return stored


def run_stage_checked(spark, folder):
    """Orders of two states, checked while they are stored in buckets of their key; then loaded."""
    open_ = F.when(F.col("o_orderstatus") == "P", "O").otherwise(F.col("o_orderstatus"))
    orders = holed_orders(spark, folder).withColumn("o_orderstatus", open_)
    store = StageStore(spark, fresh_folder(spark, "stages"))
    for _ in range(2):
        stored = run_checked(store, "preprocessed_data", orders, ORDERS)
    return stored


def pipeline_rows(spark: SparkSession, folder: str) -> DataFrame:
    """Line items are not unique by key, so each key and status is summed up to one row first."""
    lineitem = table(spark, folder, "lineitem")
    return lineitem.groupBy("l_orderkey", "l_linenumber", "l_linestatus").agg(
        F.min("l_shipdate").alias("l_shipdate"),
        F.max("l_quantity").alias("quantity"),
        F.max("l_extendedprice").alias("price"),
        F.max("l_discount").alias("discount"),
        F.max("l_tax").alias("tax"),
    )


PIPELINE = PipelineSpec(
    id_columns=("l_orderkey", "l_linenumber"),
    target="l_linestatus",
    date="l_shipdate",
    train_start=DRIFT_START,
    oot_start=OOT_START,
)


def run_all_stages(spark, folder):
    home = fresh_folder(spark, "run")
    rows = pipeline_rows(spark, folder)
    result = run_pipeline(rows, PIPELINE, f"{home}/stages", output=f"{home}/output")
    return result["monthly_performance"].select("month", "population", "positive_count", "positive_rate")


# --- run log


def run_metrics(spark: SparkSession, folder: str) -> DataFrame:
    """Users as runs and event types as metrics; the last event gives the value."""
    events = table(spark, folder, "events")
    return events.groupBy(F.col("user_id").alias("run_id"), F.col("event_type").alias("metric")).agg(
        F.max_by("value", "event_id").alias("value"), F.max("ts").alias("start_time")
    )


def valid_metrics(spark, folder):
    value = (
        F.when(F.col("event_type") == "error", F.lit(float("nan")))
        .when(F.col("event_type") == "view", F.lit(float("inf")))
        .when(F.col("event_type") == "click", F.lit(float("-inf")))
        .when(F.col("event_type") == "signup", F.lit(None))
        .otherwise(F.col("value"))
    )
    events = table(spark, folder, "events")
    return runlog.valid_metrics(events.select("event_id", "user_id", "event_type", value.alias("value")))


def staged(runs: DataFrame) -> DataFrame:
    """Runs with a life cycle and an experiment, from their ids."""
    stage = F.when(F.col("run_id") % 7 == 0, "deleted").otherwise("active")
    return runs.withColumns({"lifecycle_stage": stage, "experiment_id": F.col("run_id") % 3})


def best_run(spark, folder):
    return runlog.best_run(staged(run_metrics(spark, folder)), "purchase", experiment=1)


def recent_runs(spark, folder):
    events = table(spark, folder, "events")
    runs = events.groupBy(F.col("user_id").alias("run_id")).agg(F.max("ts").alias("start_time"))
    return runlog.recent_runs(staged(runs), 20, experiment=1).select("run_id", "start_time")


def latest_per_key(spark, folder):
    versions = table(spark, folder, "events").select(
        F.col("user_id").alias("name"), F.col("event_id").cast("string").alias("version"), "event_type", "value"
    )
    return runlog.latest_per_key(versions)


QUERIES = {
    "scan_parquet": scan_parquet,
    "scan_table": scan_table,
    "scan_lookback": scan_lookback,
    "sink_csv": sink_csv,
    "sink_json": sink_json,
    "sink_by_date": sink_by_date,
    "filter_conjunction": filter_conjunction,
    "flag_case": flag_case,
    "as_of_millis": as_of_millis,
    "window_flags": window_flags,
    "scaled_time": scaled_time,
    "days_since": days_since,
    "stamp_etl_date": stamp_etl_date,
    "project_roles": project_roles,
    "fill_sentinel": fill_sentinel,
    "ceil_2dp": ceil_2dp,
    "coerce_date": coerce_date,
    "month_key": month_key,
    "narrow_integers": narrow_integers,
    "dup_count": dup_count,
    "class_count": class_count,
    "date_overlap": date_overlap,
    "binary_target": binary_target,
    "validation_report": validation_report,
    "split_oot": split_oot,
    "split_last_month": split_last_month,
    "sort_by_date": sort_by_date,
    "split_summary": split_summary,
    "top_n_features": top_n_features,
    "final_features": final_features,
    "union_splits": union_splits,
    "distinct_months": distinct_months,
    "feat_count": event_features({"event_id": ["COUNT"]}),
    "feat_min": event_features({"value": ["MIN"], "is_error": ["MIN"]}),
    "feat_max": event_features({"value": ["MAX"], "is_error": ["MAX"]}),
    "feat_avg": event_features({"value_cents": ["AVG"], "is_error": ["AVG"]}),
    "feat_stddev": event_features({"value_cents": ["STDDEV"]}),
    "feat_wide": event_features(WIDE),
    "feat_snapshots": feat_snapshots,
    "drift_months": drift_months,
    "ks_stat": ks_stat,
    "shifting_features": shifting_features,
    "shifting_by_ledger": shifting_by_ledger,
    "feature_importance": feature_importance,
    "split_gains": split_gains,
    "class_weights": class_weights,
    "class_balance": class_balance,
    "permutation_drops": permutation_drops,
    "train_leaderboard": train_leaderboard,
    "stacked_model": stacked_model,
    "confusion_best_f1": confusion_best_f1,
    "cv_summary": cv_summary,
    "model_auc": model_auc,
    "varimp": varimp,
    "batch_predict": batch_predict,
    "predict_registered": predict_registered,
    "predict_proba": predict_proba,
    "monthly_stats": monthly_stats,
    "monthly_auc": monthly_auc,
    "monthly_performance": monthly_performance,
    "run_stage": run_stage,
    "run_stage_months": run_stage_months,
    "run_stage_checked": run_stage_checked,
    "run_pipeline": run_all_stages,
    "valid_metrics": valid_metrics,
    "best_run": best_run,
    "recent_runs": recent_runs,
    "latest_per_key": latest_per_key,
}


def flagship(spark: SparkSession, folder: str) -> DataFrame:
    """Count, min, max, avg and deviation of event values per user, for three conditions and five look-backs."""
    columns = {"event_id": ["COUNT"], "value": ["MIN", "MAX", "AVG", "STDDEV"]}
    return features.wide_features(prepared_events(spark, folder), event_spec(columns, SHORT_WINDOWS))
