"""SQL for DuckDB over the same tables, with the same column names as the queries."""

from __future__ import annotations

from registry.sql import CRC_TABLE, crc32

WINDOW_DAYS = {"l1d": 1, "l3d": 3, "l7d": 7, "l14d": 14, "l30d": 30, "l60d": 60, "l90d": 90}
SHORT_WINDOWS = ("l1d", "l3d", "l7d", "l14d", "l30d")
CONDITIONS = {"": "", "is_error_": "is_error AND ", "is_noterror_": "NOT is_error AND "}

# Midnight of 2024-01-31 in a zone seven hours ahead of UTC.
AS_OF_MS = "epoch_ms(TIMESTAMP '2024-01-31 00:00:00' - INTERVAL 7 HOURS)"

# The inputs of the training queries, with their gaps.
LEARNABLE_INPUTS = """
    CASE WHEN NOT (l_linenumber = 2 AND l_quantity < 5) THEN l_quantity END AS quantity,
    CASE WHEN l_linenumber = 3 THEN CAST('nan' AS DOUBLE) WHEN l_linenumber <> 4 THEN l_discount END AS discount,
    CASE WHEN l_linenumber <> 5 THEN l_tax END AS tax,
    CASE WHEN l_linenumber <> 6 THEN l_returnflag = 'R' END AS returned"""

PREPARED = f"""
  SELECT user_id, DATE '2024-01-31' AS partition_date, event_id, value,
         CAST(round(value * 100) AS BIGINT) AS value_cents,
         COALESCE(event_type = 'error', FALSE) AS is_error,
         (epoch_us(ts) // 1000) AS event_unix_ts,
         CAST((epoch_us(ts) // 1000) - 631152000000 AS DOUBLE)
           / CAST({AS_OF_MS} - 631152000000 AS DOUBLE) AS scaled_diff_event_unix_ts,
         {", ".join(
             f"(epoch_us(ts) // 1000) BETWEEN {AS_OF_MS} - {days} * CAST(86400000 AS BIGINT) AND {AS_OF_MS} AS {name}"
             for name, days in WINDOW_DAYS.items()
         )}
  FROM events
  WHERE ts >= TIMESTAMP '2023-11-02' AND ts < TIMESTAMP '2024-01-31'
"""


def feature_sql(columns: dict[str, list[str]], windows=tuple(WINDOW_DAYS), extra: str = "") -> str:
    lines = []
    for column, aggregations in columns.items():
        for prefix, condition in CONDITIONS.items():
            for agg in aggregations:
                for window in windows:
                    value = column
                    if column == "is_error" and agg == "AVG":
                        value = "CAST(CAST(is_error AS INTEGER) AS DOUBLE)"
                    call = f"{agg}(CASE WHEN {condition}{window} THEN {value} END)"
                    if agg == "STDDEV":
                        call = f"round(STDDEV_SAMP(CASE WHEN {condition}{window} THEN {value} END), 4)"
                    elif agg == "AVG" and column.startswith("scaled"):
                        call = f"round({call}, 8)"
                    lines.append(f"{call} AS {agg.lower()}_{prefix}{column}_{window}")
    body = ",\n       ".join(lines)
    return (
        f"WITH prep AS ({PREPARED})\nSELECT user_id, partition_date{extra},\n       {body}\n"
        "FROM prep GROUP BY user_id, partition_date"
    )


def snapshot_sql(columns: dict[str, list[str]]) -> str:
    """The features of 30 snapshots: events joined to every snapshot whose longest look-back holds them."""
    windows = ",\n         ".join(
        f"(epoch_us(ts) // 1000) BETWEEN as_of_ms - {WINDOW_DAYS[name]} * CAST(86400000 AS BIGINT) AND as_of_ms AS {name}"
        for name in SHORT_WINDOWS
    )
    prepared = f"""
  SELECT user_id, partition_date, event_id, value, CAST(round(value * 100) AS BIGINT) AS value_cents,
         COALESCE(event_type = 'error', FALSE) AS is_error, (epoch_us(ts) // 1000) AS event_unix_ts,
         {windows}
  FROM events, (
    SELECT CAST(d AS DATE) AS partition_date, epoch_ms(d - INTERVAL 7 HOURS) AS as_of_ms
    FROM range(TIMESTAMP '2024-01-02', TIMESTAMP '2024-02-01', INTERVAL 1 DAY) AS t(d)) AS s
  WHERE (epoch_us(ts) // 1000) BETWEEN as_of_ms - 30 * CAST(86400000 AS BIGINT) AND as_of_ms
"""
    return feature_sql(columns, SHORT_WINDOWS).replace(PREPARED, prepared)


SCORED = """
  SELECT l_orderkey, l_linenumber, strftime(l_shipdate, '%Y-%m') AS month,
         CASE WHEN l_linestatus = 'F' THEN 1 ELSE 0 END AS label,
         l_quantity / CAST(64 AS DOUBLE) AS score,
         CASE WHEN l_shipdate < TIMESTAMP '2000-01-01' THEN 'train' ELSE 'valid' END AS part
  FROM lineitem
"""


def auc_ctes(group: str) -> str:
    """AUC per group from average ranks: (rank sum of positives - P(P+1)/2) / (P * N)."""
    return f"""
scored AS ({SCORED}),
ranked AS (
  SELECT {group} AS g, label,
         rank() OVER (PARTITION BY {group} ORDER BY score)
           + (count(*) OVER (PARTITION BY {group}, score) - 1) / CAST(2 AS DOUBLE) AS r
  FROM scored
),
areas AS (
  SELECT g,
         CASE WHEN min(label) < max(label) THEN
           (sum(CASE WHEN label = 1 THEN r ELSE 0 END)
             - CAST(sum(label) AS DOUBLE) * (sum(label) + 1) / CAST(2 AS DOUBLE))
           / (CAST(sum(label) AS DOUBLE) * (count(*) - sum(label))) END AS auc
  FROM ranked GROUP BY g
)"""


def best_f1_ctes(group: str) -> str:
    return f"""
steps AS (
  SELECT DISTINCT {group} AS g, score,
         sum(label) OVER (PARTITION BY {group} ORDER BY score DESC) AS tp,
         count(*) OVER (PARTITION BY {group} ORDER BY score DESC) AS called,
         sum(label) OVER (PARTITION BY {group}) AS p,
         count(*) OVER (PARTITION BY {group}) AS n
  FROM scored
),
curve AS (
  SELECT g, score AS threshold, CAST(tp AS BIGINT) AS tp, CAST(called - tp AS BIGINT) AS fp,
         CAST(p - tp AS BIGINT) AS fn, CAST(n - p - called + tp AS BIGINT) AS tn,
         CASE WHEN p + called > 0 THEN CAST(2 AS DOUBLE) * tp / CAST(p + called AS DOUBLE) ELSE 0 END AS f1
  FROM steps
),
chosen AS (
  SELECT g, f1, threshold, tp, fp, fn, tn,
         CASE WHEN tp + fp > 0 THEN CAST(tp AS DOUBLE) / (tp + fp) END AS "precision",
         CASE WHEN tp + fn > 0 THEN CAST(tp AS DOUBLE) / (tp + fn) END AS recall,
         CAST(tp + tn AS DOUBLE) / (tp + fp + fn + tn) AS accuracy
  FROM (SELECT *, row_number() OVER (PARTITION BY g ORDER BY f1 DESC, threshold DESC) AS k FROM curve) AS c
  WHERE k = 1
)"""


MONTHLY_STATS = """
SELECT month, count(*) AS population, CAST(sum(label) AS BIGINT) AS positive_count,
       avg(label) AS positive_rate, avg(score) AS prediction_mean
FROM scored GROUP BY month
"""

MONTHLY_PERFORMANCE = f"""
WITH {auc_ctes("month")}, stats AS ({MONTHLY_STATS})
SELECT month, auc, population, positive_count, positive_rate, prediction_mean
FROM stats JOIN areas ON areas.g = stats.month
"""

HOLED_ORDERS = """
  SELECT o_orderkey, o_custkey, o_orderstatus,
         CASE WHEN o_orderstatus = 'P' OR o_orderpriority = '2-HIGH' THEN NULL ELSE o_totalprice END AS o_totalprice,
         o_orderdate, NULLIF(o_orderpriority, '5-LOW') AS o_orderpriority
  FROM orders
"""


def ks_ctes(table: str, date: str, start: str, features: list[str]) -> str:
    """The definition: both step functions at every value of either month."""
    long = " UNION ALL ".join(
        f"SELECT '{c}' AS feature, date_trunc('month', {date}) AS m, {c} AS v FROM {table} "
        f"WHERE {date} >= TIMESTAMP '{start}'"
        for c in features
    )
    return f"""
long AS ({long}),
counts AS (SELECT feature, m, v, count(*) AS n FROM long GROUP BY feature, m, v),
months AS (SELECT DISTINCT m FROM long),
base AS (SELECT min(m) AS m FROM months),
pairs AS (
  SELECT c.feature, c.m, c.v, CAST(0 AS BIGINT) AS ref_n, c.n AS own_n
  FROM counts AS c WHERE c.m <> (SELECT m FROM base)
  UNION ALL
  SELECT c.feature, o.m, c.v, c.n, CAST(0 AS BIGINT)
  FROM counts AS c JOIN months AS o ON o.m <> c.m WHERE c.m = (SELECT m FROM base)
),
curves AS (
  SELECT feature, m,
         CAST(sum(ref_n) OVER (PARTITION BY feature, m ORDER BY v) AS DOUBLE)
           / CAST(sum(ref_n) OVER (PARTITION BY feature, m) AS DOUBLE) AS f_ref,
         CAST(sum(own_n) OVER (PARTITION BY feature, m ORDER BY v) AS DOUBLE)
           / CAST(sum(own_n) OVER (PARTITION BY feature, m) AS DOUBLE) AS f_own
  FROM pairs
),
ks AS (
  SELECT feature, strftime(m, '%Y-%m') AS month, max(abs(f_ref - f_own)) AS ks
  FROM curves GROUP BY feature, m
)"""


LINEITEM_FEATURES = ["l_quantity", "l_extendedprice", "l_discount", "l_tax"]
KS_LINEITEM = ks_ctes("lineitem", "l_shipdate", "1996-01-01", LINEITEM_FEATURES)
SEPARATION = " UNION ALL ".join(
    f"SELECT '{c}' AS feature, abs(avg(CASE WHEN l_linestatus = 'F' THEN CAST(round({c} * 100) AS BIGINT) END)"
    f" - avg(CASE WHEN l_linestatus <> 'F' THEN CAST(round({c} * 100) AS BIGINT) END)) AS importance FROM lineitem"
    for c in LINEITEM_FEATURES
)

SPLIT_ORDERS = """
  SELECT *, CASE WHEN o_orderdate < TIMESTAMP '2000-01-01' THEN 'train'
                 WHEN o_orderdate >= TIMESTAMP '2000-01-01' THEN 'test' END AS split
"""

ORACLES = {
    "scan_parquet": "SELECT * FROM orders",
    "scan_table": "SELECT user_id AS customer_id, ts AS login_ts, event_id AS login_id FROM events",
    "scan_lookback": """
        SELECT event_id, user_id, ts, strftime(ts, '%Y%m%d') AS create_date FROM events
        WHERE strftime(ts, '%Y%m%d') >= '20240107' AND strftime(ts, '%Y%m%d') < '20240121'""",
    "sink_csv": MONTHLY_PERFORMANCE,
    "sink_json": f"WITH scored AS ({SCORED}) {MONTHLY_STATS}",
    "sink_by_date": feature_sql(
        {"event_id": ["COUNT"], "value": ["MIN", "MAX"]}, SHORT_WINDOWS, ", DATE '2024-01-31' AS etl_date"
    ),
    "filter_conjunction": "SELECT * FROM lineitem WHERE l_returnflag = 'R' AND l_linestatus = 'F' AND l_linenumber = 1",
    "flag_case": """
        SELECT event_id, NULLIF(event_type, 'view') AS kind,
               CASE WHEN event_type = 'error' THEN TRUE ELSE FALSE END AS is_error FROM events""",
    "as_of_millis": """
        SELECT o_orderkey, epoch_ms(CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) - INTERVAL 7 HOURS) AS as_of_ms
        FROM orders""",
    "window_flags": f"""
        SELECT event_id, {", ".join(
            f"(epoch_us(ts) // 1000) BETWEEN {AS_OF_MS} - {days} * CAST(86400000 AS BIGINT) AND {AS_OF_MS} AS {name}"
            for name, days in WINDOW_DAYS.items()
        )} FROM events""",
    "scaled_time": f"""
        SELECT event_id, CAST((epoch_us(ts) // 1000) - 631152000000 AS DOUBLE)
          / CAST({AS_OF_MS} - 631152000000 AS DOUBLE) AS scaled_ts FROM events""",
    "days_since": f"""
        SELECT o_orderkey, CAST({AS_OF_MS} - epoch_ms(o_orderdate) AS DOUBLE) / CAST(86400000 AS DOUBLE) AS days_since
        FROM orders""",
    "stamp_etl_date": "SELECT *, DATE '2024-01-31' AS etl_date FROM nation",
    "project_roles": "SELECT o_orderkey, o_orderstatus, o_orderdate, o_totalprice, o_orderpriority FROM orders",
    "fill_sentinel": f"""
        SELECT o_orderkey, o_custkey, o_orderstatus, COALESCE(o_totalprice, -999999) AS o_totalprice, o_orderdate,
               COALESCE(o_orderpriority, '-999999') AS o_orderpriority,
               CAST(CASE WHEN o_orderkey % 7 = 0 THEN -999999 ELSE o_orderkey % 100 END AS INTEGER) AS tiny,
               CAST(CASE WHEN o_orderkey % 7 = 0 THEN -999999 ELSE o_orderkey % 1000 END AS INTEGER) AS small,
               CAST(CASE WHEN o_orderkey % 7 = 0 THEN -999999 ELSE (o_orderkey % 10) / 4.0 END AS DECIMAL(8,2)) AS cents,
               CAST(CASE WHEN o_orderkey % 7 = 0 THEN -999999 WHEN o_orderkey % 2 = 0 THEN 1 ELSE 0 END AS INTEGER) AS even
        FROM ({HOLED_ORDERS}) AS o""",
    "ceil_2dp": """
        SELECT l_orderkey, ceil(l_quantity * 100) / 100 AS l_quantity,
               ceil(l_extendedprice * 100) / 100 AS l_extendedprice,
               ceil(l_extendedprice * l_tax * 100) / 100 AS l_tax,
               ceil(CAST(l_linenumber AS DOUBLE) * 100) / 100 AS l_linenumber, l_returnflag FROM lineitem""",
    "coerce_date": "SELECT o_orderkey, CAST(CAST(o_orderdate AS DATE) AS TIMESTAMP) AS o_orderdate FROM orders",
    "month_key": "SELECT o_orderkey, strftime(o_orderdate, '%Y-%m') AS month FROM orders",
    "narrow_integers": """
        SELECT CAST(l_orderkey AS SMALLINT) AS l_orderkey, CAST(l_partkey AS SMALLINT) AS l_partkey,
               CAST(l_suppkey AS TINYINT) AS l_suppkey, CAST(l_linenumber AS TINYINT) AS l_linenumber, l_quantity
        FROM lineitem""",
    "dup_count": """
        SELECT CAST(sum(n - 1) AS BIGINT) AS dup_count FROM (
          SELECT count(*) AS n FROM lineitem GROUP BY l_orderkey, l_linenumber, l_linestatus) AS g""",
    "class_count": "SELECT count(DISTINCT quality) AS class_count FROM labels",
    "date_overlap": """
        SELECT min(o_orderdate) AS min_date, max(o_orderdate) AS max_date,
               NOT (min(o_orderdate) > TIMESTAMP '1996-01-01' OR max(o_orderdate) < TIMESTAMP '1996-01-01') AS passed
        FROM orders""",
    "binary_target": """
        SELECT count(DISTINCT s) AS class_count,
               count(DISTINCT s) + max(CASE WHEN s IS NULL THEN 1 ELSE 0 END) AS value_count,
               count(DISTINCT s) + max(CASE WHEN s IS NULL THEN 1 ELSE 0 END) = 2 AS passed
        FROM (SELECT NULLIF(o_orderstatus, 'P') AS s FROM orders) AS o""",
    "validation_report": """
        WITH facts AS (
          SELECT count(*) - count(DISTINCT (o_orderkey, o_orderstatus)) AS extra,
                 count(DISTINCT o_orderstatus) AS classes,
                 min(o_orderdate) AS first, max(o_orderdate) AS last FROM orders)
        SELECT 1 AS step, 'dup_count' AS rule, CAST(extra AS VARCHAR) AS value, extra = 0 AS passed FROM facts
        UNION ALL SELECT 2, 'class_count', CAST(classes AS VARCHAR), classes > 1 FROM facts
        UNION ALL SELECT 3, 'date_overlap', strftime(first, '%Y-%m-%d') || '..' || strftime(last, '%Y-%m-%d'),
               NOT (first > TIMESTAMP '1995-01-01' OR last < TIMESTAMP '1995-01-01') FROM facts
        UNION ALL SELECT 4, 'binary_target', CAST(classes AS VARCHAR), classes = 2 FROM facts
        UNION ALL SELECT 5, 'target_type', 'string', TRUE
        UNION ALL SELECT 6, 'column_names', '[]', TRUE""",
    "split_oot": f"""
        WITH dated AS (
          SELECT o_orderkey, o_orderstatus, CASE WHEN o_orderstatus <> 'P' THEN o_orderdate END AS o_orderdate
          FROM orders)
        SELECT * FROM ({SPLIT_ORDERS} FROM dated) AS s WHERE split IS NOT NULL""",
    "split_last_month": """
        WITH edge AS (SELECT max(ts) - (day(max(ts)) - 1) * INTERVAL 1 DAY AS cut FROM events)
        SELECT event_id, ts, CASE WHEN ts < cut THEN 'train' ELSE 'test' END AS split FROM events, edge""",
    "sort_by_date": "SELECT o_orderkey, o_orderdate FROM orders ORDER BY o_orderdate",
    "split_summary": f"""
        SELECT split, count(*) AS n_rows, min(o_orderdate) AS min_date, max(o_orderdate) AS max_date
        FROM ({SPLIT_ORDERS} FROM orders) AS s GROUP BY split""",
    "top_n_features": f"SELECT * FROM ({SEPARATION}) AS s ORDER BY importance DESC, feature LIMIT 3",
    "final_features": f"""
        WITH {KS_LINEITEM},
        shifting AS (SELECT feature FROM ks GROUP BY feature HAVING max(ks) > 0.1),
        ranked AS (
          SELECT feature, CAST(row_number() OVER (ORDER BY importance DESC, feature) AS INTEGER) AS rank
          FROM ({SEPARATION}) AS s),
        kept AS (SELECT * FROM ranked WHERE feature NOT IN (SELECT feature FROM shifting))
        SELECT feature, rank, FALSE AS fell_back FROM kept WHERE (SELECT count(*) FROM kept) >= 2
        UNION ALL SELECT feature, rank, TRUE FROM ranked WHERE (SELECT count(*) FROM kept) < 2""",
    "union_splits": "SELECT * FROM orders WHERE o_orderdate IS NOT NULL",
    "distinct_months": "SELECT DISTINCT strftime(o_orderdate, '%Y-%m') AS month FROM orders ORDER BY month",
    "feat_count": feature_sql({"event_id": ["COUNT"]}),
    "feat_min": feature_sql({"value": ["MIN"], "is_error": ["MIN"]}),
    "feat_max": feature_sql({"value": ["MAX"], "is_error": ["MAX"]}),
    "feat_avg": feature_sql({"value_cents": ["AVG"], "is_error": ["AVG"]}),
    "feat_stddev": feature_sql({"value_cents": ["STDDEV"]}),
    "feat_wide": feature_sql(
        {
            "event_id": ["COUNT"],
            "is_error": ["MIN", "MAX", "AVG"],
            "scaled_diff_event_unix_ts": ["MIN", "MAX", "AVG"],
            "event_unix_ts": ["MIN", "MAX"],
            "value": ["MIN", "MAX"],
            "value_cents": ["AVG", "STDDEV"],
        }
    ),
    "feat_snapshots": snapshot_sql(
        {
            "event_id": ["COUNT"],
            "is_error": ["MAX", "AVG"],
            "event_unix_ts": ["MAX"],
            "value": ["MIN", "MAX"],
            "value_cents": ["AVG", "STDDEV"],
        }
    ),
    "drift_months": """
        WITH months AS (
          SELECT strftime(l_shipdate, '%Y-%m') AS month, count(*) AS n_rows FROM lineitem
          WHERE l_shipdate >= TIMESTAMP '1996-01-01' GROUP BY 1)
        SELECT month, n_rows, month = (SELECT min(month) FROM months) AS is_reference FROM months
        WHERE (SELECT count(*) FROM months) >= 2""",
    "ks_stat": f"WITH {KS_LINEITEM} SELECT feature, month, round(ks, 9) AS ks FROM ks",
    "shifting_features": f"""
        WITH {ks_ctes("orders", "o_orderdate", "1995-01-01", ["o_totalprice"])}
        SELECT feature, round(max(ks), 9) AS peak_ks, min(CASE WHEN ks > 0.3 THEN month END) AS first_month
        FROM ks GROUP BY feature HAVING max(ks) > 0.3""",
    "shifting_by_ledger": f"""
        WITH {KS_LINEITEM}
        SELECT feature, round(max(ks), 9) AS peak_ks, min(CASE WHEN ks > 0.07 THEN month END) AS first_month
        FROM ks GROUP BY feature HAVING max(ks) > 0.07""",
    "class_weights": """
        SELECT quality AS class, count(*) AS n,
               ((SELECT count(*) FROM labels WHERE quality IS NOT NULL)
                 / CAST((SELECT count(DISTINCT quality) FROM labels) AS DOUBLE)) / CAST(count(*) AS DOUBLE) AS weight
        FROM labels WHERE quality IS NOT NULL GROUP BY quality""",
    "confusion_best_f1": f"""
        WITH scored AS ({SCORED}), {best_f1_ctes("1")}
        SELECT f1, threshold, tp, fp, fn, tn, "precision", recall, accuracy FROM chosen""",
    "cv_summary": f"""
        WITH {auc_ctes("NULLIF(l_linenumber, 7)")}, {best_f1_ctes("NULLIF(l_linenumber, 7)")},
        folds AS (SELECT c.*, a.auc FROM chosen AS c JOIN areas AS a ON a.g IS NOT DISTINCT FROM c.g),
        long AS (
          SELECT 'auc' AS metric, auc AS value FROM folds
          UNION ALL SELECT 'accuracy', accuracy FROM folds
          UNION ALL SELECT 'precision', "precision" FROM folds
          UNION ALL SELECT 'recall', recall FROM folds
          UNION ALL SELECT 'f1', f1 FROM folds)
        SELECT metric, round(avg(value), 9) AS mean, round(stddev_samp(value), 9) AS std FROM long GROUP BY metric""",
    "model_auc": f"""
        WITH {auc_ctes("part")}
        SELECT max(CASE WHEN g = 'train' THEN auc END) AS training_auc,
               max(CASE WHEN g = 'valid' THEN auc END) AS validation_auc FROM areas""",
    "predict_proba": f"""
        WITH scored AS ({SCORED})
        SELECT l_orderkey, CASE WHEN score > 0.5 THEN 1 ELSE 0 END AS predict, 1 - score AS p0, score AS p1,
               score AS probability FROM scored""",
    "monthly_stats": f"WITH scored AS ({SCORED}) {MONTHLY_STATS}",
    "monthly_auc": f"WITH {auc_ctes('month')} SELECT g AS month, auc FROM areas",
    "monthly_performance": MONTHLY_PERFORMANCE,
    "run_stage": f"""
        SELECT o_orderkey, o_orderstatus, o_orderdate,
               ceil(COALESCE(o_totalprice, -999999) * 100) / 100 AS o_totalprice,
               COALESCE(o_orderpriority, '-999999') AS o_orderpriority FROM ({HOLED_ORDERS}) AS o""",
    "run_stage_months": f"""
        SELECT o_orderkey, o_orderstatus, o_orderdate,
               ceil(COALESCE(o_totalprice, -999999) * 100) / 100 AS o_totalprice,
               COALESCE(o_orderpriority, '-999999') AS o_orderpriority FROM ({HOLED_ORDERS}) AS o""",
    "run_stage_checked": f"""
        SELECT o_orderkey, CASE WHEN o_orderstatus = 'P' THEN 'O' ELSE o_orderstatus END AS o_orderstatus, o_orderdate,
               ceil(COALESCE(o_totalprice, -999999) * 100) / 100 AS o_totalprice,
               COALESCE(o_orderpriority, '-999999') AS o_orderpriority FROM ({HOLED_ORDERS}) AS o""",
    "valid_metrics": """
        SELECT event_id, user_id, event_type, value FROM events
        WHERE event_type NOT IN ('error', 'view', 'click', 'signup') AND value IS NOT NULL AND isfinite(value)""",
    "best_run": """
        WITH runs AS (
          SELECT user_id AS run_id, arg_max(value, event_id) AS value, max(ts) AS start_time
          FROM events WHERE event_type = 'purchase' AND user_id % 7 <> 0 AND user_id % 3 = 1 GROUP BY user_id)
        SELECT run_id, value FROM runs ORDER BY value DESC, start_time DESC, run_id DESC LIMIT 1""",
    "recent_runs": """
        SELECT user_id AS run_id, max(ts) AS start_time FROM events WHERE user_id % 7 <> 0 AND user_id % 3 = 1
        GROUP BY user_id ORDER BY start_time DESC, run_id LIMIT 20""",
    "latest_per_key": """
        SELECT user_id AS name, CAST(event_id AS VARCHAR) AS version, event_type, value FROM events
        QUALIFY row_number() OVER (PARTITION BY user_id ORDER BY event_id DESC) = 1""",
    # A label that follows from one column: trees find that column and no other, and predict without error.
    "feature_importance": """
        SELECT feature, CASE WHEN feature = 'quantity' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END AS importance
        FROM (SELECT unnest(['quantity', 'discount', 'tax', 'returned']) AS feature) AS f
        WHERE (SELECT count(DISTINCT l_quantity > 25) FROM lineitem) = 2""",
    # The first split of each feature over all rows; discount and tax have gaps, quantity and returned too.
    "split_gains": f"""
        WITH inputs AS (
          SELECT *, CASE WHEN COALESCE(quantity, 0) + l_linenumber * COALESCE(CAST(returned AS INTEGER), 2)
                      + 4 * ((l_orderkey * 7 + l_linenumber * 3) % 11) > 48 THEN 1 ELSE 0 END AS y
          FROM (SELECT l_orderkey, l_linenumber, {LEARNABLE_INPUTS} FROM lineitem)),
        long AS (
          SELECT 'quantity' AS feature, COALESCE(quantity, -999999) AS x, y FROM inputs
          UNION ALL SELECT 'discount', CASE WHEN discount IS NULL OR isnan(discount) THEN -999999 ELSE discount END, y FROM inputs
          UNION ALL SELECT 'tax', COALESCE(tax, -999999), y FROM inputs
          UNION ALL SELECT 'returned', COALESCE(CAST(CAST(returned AS INTEGER) AS DOUBLE), -999999), y FROM inputs),
        counts AS (SELECT feature, x, count(*) AS n, sum(y) AS pos FROM long GROUP BY feature, x),
        sums AS (
          SELECT feature, x, sum(n) OVER w AS n, sum(pos) OVER w AS pos, sum(n) OVER v AS all_n, sum(pos) OVER v AS all_pos
          FROM counts WINDOW w AS (PARTITION BY feature ORDER BY x), v AS (PARTITION BY feature)),
        shares AS (SELECT *, CAST(all_pos AS DOUBLE) / all_n AS p FROM sums WHERE n < all_n),
        parts AS (
          SELECT feature, x, n * p - pos AS g, (all_n - n) * p - (all_pos - pos) AS other, n, all_n - n AS m, p * (1 - p) AS h
          FROM shares WHERE least(n, all_n - n) >= 20),
        gains AS (SELECT feature, x, g * g / (n * h) + other * other / (m * h) AS gain FROM parts)
        SELECT feature, arg_max(x, gain) AS cut, round(max(gain), 1) AS gain FROM gains GROUP BY feature""",
    "class_balance": """
        WITH sizes AS (SELECT toxic, count(*) AS n FROM labels WHERE toxic IS NOT NULL GROUP BY toxic),
        rates AS (SELECT toxic, CAST((SELECT max(n) FROM sizes) AS DOUBLE) / n AS rate FROM sizes),
        draws AS (
          SELECT toxic, rate, CAST(ceil(rate / 16.0) AS BIGINT) AS k, rate / ceil(rate / 16.0) AS mean FROM rates),
        steps AS (
          SELECT toxic, list_transform(range(0, 100), lambda j: list_sum(
            list_transform(range(0, j + 1), lambda i: exp(-mean + i * ln(mean) - lgamma(i + 1))))) AS cdf
          FROM draws),
        places AS (
          SELECT l.doc_id, l.toxic, rate, k, unnest(range(0, greatest(k, 1))) AS i FROM labels AS l JOIN draws USING (toxic)),
        drawn AS (
          SELECT doc_id, toxic, CASE WHEN rate <= 1 THEN 1 ELSE
            len(list_filter(cdf, lambda s: s <= place)) END AS times
          FROM (SELECT *, (CAST('0x' || substr(md5('42:' || i || ':' || doc_id), 1, 8) AS BIGINT) + 0.5) / 4294967296.0 AS place
                FROM places JOIN steps USING (toxic))),
        each AS (SELECT doc_id, toxic, sum(times) AS times FROM drawn GROUP BY doc_id, toxic)
        SELECT toxic AS class, CAST(sum(times) AS BIGINT) AS n_drawn, count(*) AS n_rows,
               CAST(max(times) - 1 AS BIGINT) AS max_replica,
               CAST(sum(doc_id * (times * (times + 1)) / 2) AS BIGINT) AS checksum
        FROM each WHERE times > 0 GROUP BY toxic""",
    "permutation_drops": f"""
        WITH crc AS ({CRC_TABLE}),
        base AS (
          SELECT l_orderkey, l_linenumber, l_linestatus, max(l_quantity) AS quantity,
                 round(max(l_discount) * 100) AS discount, round(max(l_tax) * 100) AS tax
          FROM lineitem GROUP BY l_orderkey, l_linenumber, l_linestatus),
        keyed AS (
          SELECT *, CASE WHEN quantity + 2 * discount + 4 * ((l_orderkey * 7 + l_linenumber * 3) % 11) > 55
                    THEN 1 ELSE 0 END AS label,
                 l_orderkey || '|' || l_linenumber || '|' || l_linestatus AS key
          FROM base),
        placed AS (SELECT *, {crc32("key")} AS h FROM keyed, crc),
        turned AS (
          SELECT quantity, discount, tax, label,
                 COALESCE(lead(quantity) OVER w, first_value(quantity) OVER w) AS q,
                 COALESCE(lead(discount) OVER w, first_value(discount) OVER w) AS d,
                 COALESCE(lead(tax) OVER w, first_value(tax) OVER w) AS t
          FROM placed WINDOW w AS (PARTITION BY h % 16 ORDER BY h, key)),
        long AS (
          SELECT '' AS feature, 3 * quantity + 5 * discount - tax AS score, label FROM turned
          UNION ALL SELECT 'quantity', 3 * q + 5 * discount - tax, label FROM turned
          UNION ALL SELECT 'discount', 3 * quantity + 5 * d - tax, label FROM turned
          UNION ALL SELECT 'tax', 3 * quantity + 5 * discount - t, label FROM turned),
        counts AS (
          SELECT feature, score, sum(label) AS pos, count(*) - sum(label) AS neg FROM long GROUP BY feature, score),
        below AS (
          SELECT feature, pos, neg, sum(neg) OVER (PARTITION BY feature ORDER BY score) - neg AS lower FROM counts),
        areas AS (
          SELECT feature, CAST(sum(pos * (lower + neg / 2)) AS DOUBLE) / (sum(pos) * sum(neg)) AS auc
          FROM below GROUP BY feature)
        SELECT a.feature, round(b.auc, 9) AS auc, round(b.auc - a.auc, 9) AS auc_drop
        FROM areas AS a, areas AS b WHERE a.feature <> '' AND b.feature = ''""",
    # A label that follows from one column: no model's order suffers when another column's values change rows.
    "varimp": """
        SELECT variable, CASE WHEN variable = 'quantity' THEN CAST(1 AS DOUBLE) ELSE CAST(0 AS DOUBLE) END
                 AS relative_importance
        FROM (SELECT unnest(['quantity', 'discount', 'tax', 'returned']) AS variable) AS f
        WHERE (SELECT count(DISTINCT l_quantity > 25) FROM lineitem) = 2""",
    "stacked_model": """
        SELECT l_orderkey, l_linenumber, CAST(l_quantity > 25 AS INTEGER) AS is_big,
               CAST(l_quantity > 25 AS INTEGER) AS prediction FROM lineitem""",
    "predict_registered": """
        SELECT l_orderkey, l_linenumber, CAST(l_quantity > 25 AS INTEGER) AS is_big,
               CAST(l_quantity > 25 AS INTEGER) AS prediction FROM lineitem""",
    "batch_predict": """
        SELECT l_orderkey, l_linenumber, l_shipdate, CAST(l_quantity > 25 AS INTEGER) AS is_big,
               CASE WHEN NOT (l_linenumber = 2 AND l_quantity < 5) THEN l_quantity END AS quantity,
               CASE WHEN l_linenumber = 3 THEN CAST('nan' AS DOUBLE) WHEN l_linenumber <> 4 THEN l_discount END AS discount,
               CASE WHEN l_linenumber <> 5 THEN l_tax END AS tax,
               CASE WHEN l_linenumber <> 6 THEN l_returnflag = 'R' END AS returned,
               CASE WHEN l_linenumber = 1 THEN '' WHEN l_linenumber = 2 THEN 'a "b"' || chr(10) || 'c'
                    WHEN l_linenumber = 3 THEN 'x,' || chr(13) || chr(10) || 'y'
                    WHEN l_linenumber <> 4 THEN l_returnflag END AS note,
               CAST(l_quantity > 25 AS INTEGER) AS prediction FROM lineitem""",
    "run_pipeline": """
        WITH whole AS (
          SELECT l_linestatus, min(l_shipdate) AS d FROM lineitem GROUP BY l_orderkey, l_linenumber, l_linestatus)
        SELECT strftime(d, '%Y-%m') AS month, count(*) AS population,
               CAST(sum(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS BIGINT) AS positive_count,
               avg(CASE WHEN l_linestatus = 'O' THEN 1 ELSE 0 END) AS positive_rate
        FROM whole WHERE d IS NOT NULL GROUP BY month""",
}
