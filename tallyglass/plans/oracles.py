"""SQL equivalents of the registered queries, for an independent engine on the same tables."""

from __future__ import annotations

from tallyglass.config import VOCABULARY, Settings
from tallyglass.sources.daily import LARGE_FROM, MID_FROM, SEGMENT_SECTOR

ORACLES: dict[str, str] = {}

_SETTINGS = Settings()
_DRIFT_COLUMNS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")

_SECTOR = "CASE c_mktsegment " + " ".join(f"WHEN '{k}' THEN '{v}'" for k, v in SEGMENT_SECTOR.items())

_DAILY = f"""
day_market AS (
  SELECT user_id, CAST(ts AS DATE) AS date,
         min_by(value, event_id) AS open_price, max_by(value, event_id) AS close_price,
         max(value) AS high_price, min(value) AS low_price, count(*) AS volume
  FROM events GROUP BY 1, 2),
market AS (
  SELECT m.user_id, m.date, 'S' || CAST(c_nationkey AS VARCHAR) AS stock_id,
         open_price, close_price, high_price, low_price, volume,
         avg(volume) OVER (PARTITION BY m.user_id ORDER BY m.date
           RANGE BETWEEN INTERVAL 30 DAY PRECEDING AND INTERVAL 1 DAY PRECEDING) AS avg_volume_30d,
         {_SECTOR} ELSE 'Other' END AS sector,
         CASE WHEN c_acctbal >= {LARGE_FROM} THEN 'Large' WHEN c_acctbal >= {MID_FROM} THEN 'Mid'
              ELSE 'Small' END AS market_cap_category,
         dayname(m.date) AS day_of_week
  FROM day_market m LEFT JOIN customer ON c_custkey = m.user_id),
day_user AS (
  SELECT user_id, CAST(ts AS DATE) AS date,
         max(CASE WHEN event_type = 'purchase' THEN 1 ELSE 0 END) AS purchased_stock
  FROM events GROUP BY 1, 2),
users AS (
  SELECT user_id, date,
         max(CASE WHEN purchased_stock = 1 THEN date END) OVER before AS last_purchase_date,
         date AS as_of_date,
         coalesce(avg(purchased_stock) OVER before, 0.0) AS risk_tolerance,
         purchased_stock
  FROM day_user
  WINDOW before AS (PARTITION BY user_id ORDER BY date ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING)),
joined AS (
  SELECT m.*, u.last_purchase_date, u.as_of_date, u.risk_tolerance, u.purchased_stock
  FROM market m JOIN users u ON m.user_id = u.user_id AND m.date = u.date)"""

_DERIVED = {
    "price_momentum": "(close_price - open_price) / nullif(open_price, 0)",
    "volume_ratio": "CAST(volume AS DOUBLE) / nullif(avg_volume_30d, 0)",
    "volatility": "high_price - low_price",
    "days_since_last_purchase": "CAST(date_diff('day', last_purchase_date, as_of_date) AS INTEGER)",
}
_ONE_HOT = {f"{c}_{v}": f"CASE WHEN {c} = '{v}' THEN 1 ELSE 0 END" for c, vs in VOCABULARY.items() for v in vs}

_FEATURES = (
    _DAILY
    + ",\nfeatures AS (SELECT *, "
    + ", ".join(f"{x} AS {n}" for n, x in (_DERIVED | _ONE_HOT).items())
    + " FROM joined)"
)


def _with(ctes: str, select: str) -> str:
    return f"WITH {ctes.strip()}\n{select}"


def _r(expression: str, name: str | None = None) -> str:
    return f"round({expression}, 6) AS {name or expression}"


def _d(name: str) -> str:
    return f"CAST(CAST({name} AS DATE) AS VARCHAR) AS {name}"


_MARKET_COLUMNS = ", ".join(
    [
        "user_id",
        _d("date"),
        "stock_id",
        "open_price",
        "close_price",
        "high_price",
        "low_price",
        "volume",
        "avg_volume_30d",
        "sector",
        "market_cap_category",
        "day_of_week",
    ]
)
_USER_COLUMNS = ", ".join([_d("last_purchase_date"), _d("as_of_date"), "risk_tolerance", "purchased_stock"])
_FEATURE_COLUMNS = ", ".join(
    [
        _MARKET_COLUMNS,
        _USER_COLUMNS,
        *_DERIVED,
        *_ONE_HOT,
    ]
)

# --- scans ---

ORACLES["scan_date_range"] = f"""
SELECT event_id, user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS date, value
FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-08' AND DATE '2024-01-20'"""
ORACLES["scan_user_range"] = f"""
SELECT o_orderkey, o_custkey, CAST(CAST(o_orderdate AS DATE) AS VARCHAR) AS date, o_totalprice
FROM orders WHERE CAST(o_orderdate AS DATE) BETWEEN DATE '1996-01-01' AND DATE '1996-12-31'"""
ORACLES["scan_default_range"] = f"""
SELECT event_id, user_id, CAST(CAST(ts AS DATE) AS VARCHAR) AS date, value
FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-29' AND DATE '2024-01-30'"""
ORACLES["row_counts"] = _with(
    _DAILY,
    """SELECT 'market' AS step, count(*) AS rows FROM market
UNION ALL SELECT 'user', count(*) FROM users
UNION ALL SELECT 'joined', count(*) FROM joined""",
)
ORACLES["actual_purchases"] = _with(
    _DAILY,
    f"""SELECT user_id, {_d("date")}, CAST(purchased_stock AS DOUBLE) AS purchased_stock
FROM users WHERE date BETWEEN DATE '2024-01-23' AND DATE '2024-01-30'""",
)

# --- join and features ---

ORACLES["join_market_user"] = _with(_DAILY, f"SELECT {_MARKET_COLUMNS}, {_USER_COLUMNS} FROM joined")
ORACLES["join_market_user_salted"] = ORACLES["join_market_user"]
for _name in ("price_momentum", "volume_ratio", "volatility"):
    ORACLES[_name] = _with(
        _DAILY, f"SELECT user_id, {_d('date')}, {_DERIVED[_name]} AS {_name} FROM market"
    )
ORACLES["days_since_last_purchase"] = _with(
    _DAILY,
    f"""SELECT user_id, {_d("date")}, {_DERIVED["days_since_last_purchase"]} AS days_since_last_purchase
FROM users""",
)
ORACLES["features"] = _with(_FEATURES, f"SELECT {_FEATURE_COLUMNS} FROM features")
ORACLES["features_learned_vocab"] = _with(
    _DAILY,
    "\nUNION ALL ".join(f"SELECT user_id, {_d('date')}, '{c}_' || {c} AS feature FROM joined" for c in VOCABULARY),
)
ORACLES["features_yesterday"] = _with(
    _FEATURES, f"SELECT {_FEATURE_COLUMNS} FROM features WHERE date = DATE '2024-01-29'"
)
ORACLES["features_from_state"] = ORACLES["features_yesterday"]
ORACLES["training_window"] = _with(
    _FEATURES,
    f"SELECT {_FEATURE_COLUMNS} FROM features WHERE date BETWEEN DATE '2023-12-31' AND DATE '2024-01-30'",
)

# --- encoding, filling, scaling, splitting ---

ORACLES["distinct_categories"] = """
SELECT DISTINCT 'c_mktsegment' AS "column", c_mktsegment AS category FROM customer
UNION ALL SELECT DISTINCT 'event_type', event_type FROM events"""
ORACLES["one_hot_learned_vocab"] = """
SELECT c_custkey, 'c_mktsegment_' || c_mktsegment AS feature FROM customer
WHERE c_mktsegment IN (SELECT c_mktsegment FROM customer WHERE c_nationkey < 12)
UNION ALL SELECT c_custkey, 'c_nationkey_' || CAST(c_nationkey AS VARCHAR) FROM customer WHERE c_nationkey < 12"""
ORACLES["one_hot_fixed_vocab"] = _with(
    _DAILY,
    f"SELECT user_id, {_d('date')}, " + ", ".join(f"{x} AS {n}" for n, x in _ONE_HOT.items()) + " FROM market",
)


def _aligned(fill: bool) -> str:
    columns = []
    for c in _SETTINGS.feature_columns:
        if c == "portfolio_diversity_score":
            columns.append(f"0 AS {c}")
        else:
            columns.append(f"coalesce({c}, 0) AS {c}" if fill else c)
    return ", ".join(columns)


ORACLES["align_features"] = _with(
    _FEATURES, f"SELECT user_id, stock_id, {_d('date')}, {_aligned(fill=False)} FROM features"
)
ORACLES["fill_missing"] = _with(
    _FEATURES,
    f"""SELECT user_id, {_d("date")}, coalesce(price_momentum, 0) AS price_momentum,
  coalesce(volume_ratio, 0) AS volume_ratio, coalesce(volatility, 0) AS volatility,
  coalesce(days_since_last_purchase, 0) AS days_since_last_purchase, purchased_stock
FROM features""",
)
ORACLES["feature_matrix"] = _with(
    _FEATURES,
    f"SELECT user_id, {_d('date')}, {_aligned(fill=True)}, purchased_stock FROM features "
    "WHERE purchased_stock IS NOT NULL",
)
ORACLES["standard_scale"] = (
    "SELECT l_orderkey, l_linenumber, "
    + ", ".join(_r(f"({c} - m_{c}) / s_{c}", c) for c in _DRIFT_COLUMNS)
    + " FROM lineitem, (SELECT "
    + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _DRIFT_COLUMNS)
    + " FROM lineitem) AS statistics"
)
_SCALED = ("price_momentum", "volume_ratio", "volatility", "days_since_last_purchase", "risk_tolerance")
ORACLES["scaled_features"] = _with(
    _FEATURES
    + ",\nfilled AS (SELECT user_id, date, "
    + ", ".join(f"coalesce({c}, 0.0) AS {c}" for c in _SCALED)
    + " FROM features),\nstatistics AS (SELECT "
    + ", ".join(f"avg({c}) AS m_{c}, stddev_pop({c}) AS s_{c}" for c in _SCALED)
    + " FROM filled WHERE substr(md5('42:' || CAST(user_id AS VARCHAR) || ':' || CAST(date AS VARCHAR)), 1, 8)"
    + " >= '33333333')",
    f"SELECT user_id, {_d('date')}, "
    + ", ".join(_r(f"({c} - m_{c}) / s_{c}", c) for c in _SCALED)
    + " FROM filled, statistics",
)
ORACLES["train_test_split"] = """
SELECT event_id,
       CASE WHEN substr(md5('42:' || CAST(event_id AS VARCHAR)), 1, 8) < '33333333' THEN 'test'
            ELSE 'train' END AS part
FROM events"""

# --- decisions ---

ORACLES["threshold_predictions"] = """
SELECT doc_id, n_chars / (n_chars + 1000.0::DOUBLE) AS probability,
       CASE WHEN n_chars / (n_chars + 1000.0::DOUBLE) >= 0.5 THEN 1 ELSE 0 END AS prediction
FROM documents"""

_REQUESTS = (
    _FEATURES
    + f""",
scored AS (
  SELECT CAST(user_id AS VARCHAR) AS user_id, stock_id,
    1.0 / (1.0 + exp(-(
      least(greatest(coalesce(price_momentum, 0.0), -1.0), 1.0)
      + 0.5 * coalesce(CAST(volume AS DOUBLE) / nullif(coalesce(floor(avg_volume_30d), volume), 0), 0.0)
      - 0.05 * coalesce(days_since_last_purchase, 0)
      + 2.0 * risk_tolerance + 0.3 * sector_Technology - 0.2 * market_cap_category_Small
      + 0.1 * day_of_week_Monday - 1.0))) AS probability
  FROM features),
decided AS (
  SELECT user_id, stock_id, round(probability, 6) AS probability,
         CASE WHEN probability >= 0.5 THEN 1 ELSE 0 END AS prediction,
         '2024-01-30 00:00:00' AS prediction_time, '{_SETTINGS.model_version}' AS model_version,
         '2024-01-30' AS prediction_date
  FROM scored)"""
)
ORACLES["score_output"] = _with(_REQUESTS, "SELECT * FROM decided")
ORACLES["score_summary"] = _with(
    _REQUESTS, f"SELECT count(*) AS count, '{_SETTINGS.model_version}' AS model_version FROM decided"
)
ORACLES["stream_scoring"] = _with(
    _REQUESTS, "SELECT user_id, stock_id, probability, prediction, prediction_date FROM decided"
)

ORACLES["batch_requests"] = _with(
    _FEATURES
    + """,
placed AS (
  SELECT *, row_number() OVER (PARTITION BY user_id ORDER BY volume, close_price, open_price, high_price, low_price, day_of_week,
    coalesce(floor(avg_volume_30d), volume), coalesce(days_since_last_purchase, 0), risk_tolerance) - 1 AS position
  FROM features),
judged AS (
  SELECT position, CASE WHEN position % 4 IN (1, 3) THEN 'malformed' ELSE 'accepted' END AS verdict,
    1.0 / (1.0 + exp(-(
      least(greatest(coalesce(price_momentum, 0.0), -1.0), 1.0)
      + 0.5 * coalesce(CAST(volume AS DOUBLE) / nullif(coalesce(floor(avg_volume_30d), volume), 0), 0.0)
      - 0.05 * coalesce(days_since_last_purchase, 0)
      + 2.0 * risk_tolerance + 0.3 * sector_Technology - 0.2 * market_cap_category_Small
      + 0.1 * day_of_week_Monday - 1.0))) AS probability
  FROM placed)""",
    """SELECT CAST(position AS INTEGER) AS position, verdict, count(*) AS requests,
  round(sum(CASE WHEN verdict = 'accepted' THEN probability END), 6) AS probability FROM judged GROUP BY 1, 2""",
)
ORACLES["stream_dedup"] = _with(
    _FEATURES
    + """,
sent AS (
  SELECT DISTINCT user_id, stock_id, close_price, open_price, high_price, low_price, volume, coalesce(floor(avg_volume_30d), volume) AS avg_volume,
    sector, market_cap_category, day_of_week, coalesce(days_since_last_purchase, 0) AS days, risk_tolerance FROM features),
late AS (
  SELECT user_id, CASE user_id % 10 WHEN 4 THEN 'late' ELSE 'ahead of time' END AS reason, 2 * count(*) AS requests
  FROM features WHERE user_id % 10 IN (4, 6) GROUP BY 1, 2)""",
    """SELECT CAST(user_id AS VARCHAR) AS user_id, 'accepted' AS reason, count(*) AS requests FROM sent WHERE user_id % 10 NOT IN (4, 6) GROUP BY 1
UNION ALL SELECT CAST(user_id AS VARCHAR), reason, requests FROM late""",
)

# --- quality ---

_DECISIONS = (
    _DAILY
    + """,
predictions AS (
  SELECT user_id, date, CASE WHEN close_price >= open_price THEN 1 ELSE 0 END AS prediction FROM market),
actuals AS (SELECT user_id, date, CAST(purchased_stock AS DOUBLE) AS purchased_stock FROM users)"""
)


def _cells(frame: str) -> str:
    return f"""
cells AS (
  SELECT CAST(count(*) AS DOUBLE) AS total,
         CAST(count(*) FILTER (WHERE prediction = purchased_stock) AS DOUBLE) AS correct,
         CAST(count(*) FILTER (WHERE prediction = 1 AND purchased_stock = 1) AS DOUBLE) AS tp,
         CAST(count(*) FILTER (WHERE prediction = 1 AND purchased_stock = 0) AS DOUBLE) AS fp,
         CAST(count(*) FILTER (WHERE prediction = 0 AND purchased_stock = 1) AS DOUBLE) AS fn,
         CAST(count(*) FILTER (WHERE prediction = 0 AND purchased_stock = 0) AS DOUBLE) AS tn
  FROM {frame} WHERE prediction IS NOT NULL AND purchased_stock IS NOT NULL)"""


_METRICS = """
metrics AS (
  SELECT total AS total_predictions,
         coalesce(correct / nullif(total, 0), 0.0) AS accuracy,
         coalesce(tp / nullif(tp + fp, 0), 0.0) AS "precision",
         coalesce(tp / nullif(tp + fn, 0), 0.0) AS recall,
         coalesce(2 * tp / nullif(2 * tp + fp + fn, 0), 0.0) AS f1_score,
         coalesce(tp / nullif(tp + fn, 0), 0.0) AS true_positive_rate,
         coalesce(fp / nullif(fp + tn, 0), 0.0) AS false_positive_rate
  FROM cells)"""
_METRIC_NAMES = (
    "total_predictions",
    "accuracy",
    "precision",
    "recall",
    "f1_score",
    "true_positive_rate",
    "false_positive_rate",
)
_METRIC_COLUMNS = ", ".join(f'"{m}"' for m in _METRIC_NAMES)

for _suffix, _on in (("", "user_id"), ("_by_date", "user_id, date")):
    _paired = f"{_DECISIONS},\npaired AS (SELECT * FROM predictions JOIN actuals USING ({_on}))"
    _shown = "user_id, CAST(date AS VARCHAR) AS date" if _suffix else "user_id"
    ORACLES[f"join_pred_actual{_suffix}"] = _with(
        _paired,
        f"SELECT {_shown}, prediction, purchased_stock, count(*) AS pairs FROM paired GROUP BY ALL",
    )
    ORACLES[f"prediction_quality{_suffix}"] = _with(
        f"{_paired},{_cells('paired')},{_METRICS}", f"SELECT {_METRIC_COLUMNS} FROM metrics"
    )

_JUDGED = """
judged AS (
  SELECT doc_id, CAST(n_chars AS DOUBLE) AS probability,
         CASE WHEN n_chars >= 1000 THEN 1 ELSE 0 END AS prediction,
         CAST(quality AS DOUBLE) AS purchased_stock
  FROM documents JOIN labels USING (doc_id))"""
_JUDGED_METRICS = f"{_JUDGED},{_cells('judged')},{_METRICS}"

ORACLES["confusion_counts"] = _with(f"{_JUDGED},{_cells('judged')}", "SELECT * FROM cells")
ORACLES["classification_metrics"] = _with(_JUDGED_METRICS, f"SELECT {_METRIC_COLUMNS} FROM metrics")

_CURVE = (
    _JUDGED
    + """,
per_score AS (
  SELECT probability AS threshold, CAST(count(*) AS DOUBLE) AS n, sum(purchased_stock) AS p
  FROM judged GROUP BY 1),
ranked AS (
  SELECT threshold, n, p,
         sum(p) OVER (ORDER BY threshold DESC) AS tp,
         sum(n - p) OVER (ORDER BY threshold DESC) AS fp,
         sum(p) OVER () AS positives, sum(n - p) OVER () AS negatives
  FROM per_score),
curve AS (
  SELECT threshold, tp, fp, tp / (tp + fp) AS "precision", tp / positives AS recall FROM ranked)"""
)
ORACLES["roc_auc"] = _with(
    _CURVE,
    """SELECT round(sum(p * (negatives - fp) + 0.5 * p * (n - p)) / max(positives * negatives), 6) AS auc
FROM ranked""",
)
ORACLES["pr_curve"] = _with(
    _CURVE,
    'SELECT threshold, tp, fp, "precision", recall FROM curve',
)
ORACLES["best_f1_threshold"] = _with(
    _CURVE,
    """SELECT round(2 * recall * "precision" / (recall + "precision" + 1e-8), 6) AS best_f1,
       threshold AS best_threshold
FROM curve ORDER BY 2 * recall * "precision" / (recall + "precision" + 1e-8) DESC, threshold LIMIT 1""",
)

# --- drift and monitoring ---


def _stats(side: str, source: str, columns: tuple[str, ...]) -> str:
    parts = [
        f"""SELECT '{c}' AS feature, avg({c}) AS mean, stddev_samp({c}) AS stddev,
         CAST(min({c}) AS DOUBLE) AS min, CAST(max({c}) AS DOUBLE) AS max FROM {source}"""
        for c in columns
    ]
    return f"{side} AS (\n  " + "\n  UNION ALL ".join(parts) + ")"


def _report(threshold: float) -> str:
    return f"""report AS (
  SELECT feature, c.mean AS current_mean, r.mean AS reference_mean,
         CASE WHEN r.mean = 0 THEN 'Infinity'::DOUBLE ELSE abs(c.mean - r.mean) / abs(r.mean) END
           AS mean_diff_pct,
         c.stddev AS current_stddev, r.stddev AS reference_stddev,
         CASE WHEN r.stddev = 0 THEN 'Infinity'::DOUBLE ELSE abs(c.stddev - r.stddev) / abs(r.stddev) END
           AS stddev_diff_pct,
         mean_diff_pct > {threshold} OR stddev_diff_pct > {threshold} AS drift_detected
  FROM present c JOIN past r USING (feature))"""


_REPORT_COLUMNS = (
    "feature, "
    + ", ".join(
        _r(c)
        for c in (
            "current_mean",
            "reference_mean",
            "mean_diff_pct",
            "current_stddev",
            "reference_stddev",
            "stddev_diff_pct",
        )
    )
    + ", drift_detected"
)
_LINES = ",\n".join(
    [
        "late AS (SELECT * FROM lineitem WHERE l_shipdate >= TIMESTAMP '1999-01-01')",
        "early AS (SELECT * FROM lineitem WHERE l_shipdate < TIMESTAMP '1999-01-01')",
        _stats("present", "late", _DRIFT_COLUMNS),
        _stats("past", "early", _DRIFT_COLUMNS),
    ]
)
_STATS_COLUMNS = f"feature, {_r('mean')}, {_r('stddev')}, min, max"

ORACLES["drift_stats"] = _with(
    _LINES,
    f"""SELECT {_STATS_COLUMNS}, 'current' AS side FROM present
UNION ALL SELECT {_STATS_COLUMNS}, 'reference' AS side FROM past""",
)
ORACLES["drift_report"] = _with(f"{_LINES},\n{_report(0.1)}", f"SELECT {_REPORT_COLUMNS} FROM report")
ORACLES["drift_report_tight"] = _with(f"{_LINES},\n{_report(0.01)}", f"SELECT {_REPORT_COLUMNS} FROM report")
ORACLES["drift_any"] = _with(
    f"{_LINES},\n{_report(0.01)}", "SELECT coalesce(bool_or(drift_detected), false) AS any_drift_detected FROM report"
)
_RUN = f"{_LINES},\n{_report(0.01)},{_JUDGED_METRICS}"
ORACLES["alerts"] = _with(
    _RUN,
    """SELECT 'data_drift' AS alert, CAST(1 AS DOUBLE) AS value FROM (SELECT bool_or(drift_detected) AS d FROM report)
WHERE d
UNION ALL SELECT 'low_accuracy', accuracy FROM metrics WHERE accuracy < 0.7""",
)
ORACLES["metric_log"] = _with(
    _RUN,
    "\nUNION ALL ".join(
        [
            f"""SELECT 'run-1' AS run_id, 'performance_{m}' AS metric, "{m}" AS value FROM metrics"""
            for m in _METRIC_NAMES
        ]
        + [
            """SELECT 'run-1', 'drift_detected',
  CAST(CAST(coalesce(bool_or(drift_detected), false) AS INTEGER) AS DOUBLE) FROM report"""
        ]
    ),
)
_NUMERIC = tuple(c for c in _SETTINGS.numerical_columns if c != "portfolio_diversity_score")
_MONITORED = ",\n".join(
    [
        _FEATURES,
        "yesterday AS (SELECT * FROM features WHERE date = DATE '2024-01-29')",
        "period AS (SELECT * FROM features WHERE date BETWEEN DATE '2024-01-01' AND DATE '2024-01-14')",
        _stats("present", "yesterday", _NUMERIC),
        _stats("past", "period", _NUMERIC),
        _report(0.1),
        """predictions AS (
  SELECT user_id, CASE WHEN close_price >= open_price THEN 1 ELSE 0 END AS prediction
  FROM market WHERE date BETWEEN DATE '2024-01-23' AND DATE '2024-01-30'),
actuals AS (SELECT user_id, CAST(purchased_stock AS DOUBLE) AS purchased_stock
  FROM users WHERE date BETWEEN DATE '2024-01-23' AND DATE '2024-01-30'),
paired AS (SELECT * FROM predictions JOIN actuals USING (user_id))""",
        _cells("paired").strip(),
        _METRICS.strip(),
    ]
)
ORACLES["monitoring_report"] = _with(
    _MONITORED,
    f"""SELECT '2024-01-30T00:00:00' AS timestamp, '{_SETTINGS.model_version}' AS model_version,
  {_METRIC_COLUMNS}, any_drift_detected, feature,
  {_r("current_mean")}, {_r("reference_mean")}, {_r("current_stddev")}, {_r("reference_stddev")},
  round(CASE WHEN isinf(mean_diff_pct) THEN NULL ELSE mean_diff_pct END, 6) AS mean_diff_pct,
  round(CASE WHEN isinf(stddev_diff_pct) THEN NULL ELSE stddev_diff_pct END, 6) AS stddev_diff_pct,
  reference_mean = 0 OR reference_stddev = 0 AS reference_is_zero,
  drift_detected
FROM report, metrics, (SELECT coalesce(bool_or(drift_detected), false) AS any_drift_detected FROM report) AS flag""",
)

ORACLES["daily_monitoring"] = _with(
    _MONITORED, f"SELECT {_REPORT_COLUMNS}, total_predictions, accuracy, precision, recall FROM report, metrics"
)
ORACLES["drift_stats_by_month"] = ORACLES["drift_stats"]
ORACLES["roc_auc_by_day"] = _with(
    _FEATURES
    + """,
judged AS (
  SELECT 1.0 / (1.0 + exp(-(
      least(greatest(coalesce(price_momentum, 0.0), -1.0), 1.0) + 0.5 * coalesce(volume_ratio, 0.0)
      - 0.05 * coalesce(days_since_last_purchase, 0) + 2.0 * risk_tolerance + 0.3 * sector_Technology
      - 0.2 * market_cap_category_Small + 0.1 * day_of_week_Monday - 1.0))) AS score, purchased_stock AS y
  FROM features WHERE purchased_stock IS NOT NULL AND date BETWEEN DATE '2024-01-23' AND DATE '2024-01-30'),
counted AS (SELECT score, sum(y) AS p, count(*) - sum(y) AS q FROM judged GROUP BY score),
ranked AS (
  SELECT *, coalesce(sum(q) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
    sum(p) OVER (ORDER BY score DESC) AS tp, sum(q) OVER (ORDER BY score DESC) AS fp, sum(p) OVER () AS all_p, sum(q) OVER () AS all_q FROM counted)""",
    """SELECT round(sum(p * (below + 0.5 * q)) / (max(all_p) * max(all_q)), 6) AS auc,
  round(max(2 * (tp / all_p) * (tp / (tp + fp)) / (tp / all_p + tp / (tp + fp) + 1e-8)), 6) AS best_f1 FROM ranked""",
)

# --- round trips ---

_EVENT_PREDICTIONS = """
SELECT CAST(user_id AS VARCHAR) AS user_id, value / (value + 100) AS probability,
       CASE WHEN value / (value + 100) >= 0.5 THEN 1 ELSE 0 END AS prediction,
       CAST(CAST(ts AS DATE) AS VARCHAR) AS prediction_date
FROM events WHERE CAST(ts AS DATE) BETWEEN """
ORACLES["predictions_last_n_days"] = _EVENT_PREDICTIONS + "DATE '2024-01-23' AND DATE '2024-01-30'"
ORACLES["predictions_two_roots"] = _with(
    _REQUESTS,
    """SELECT user_id, stock_id, probability, prediction, prediction_date FROM decided
UNION ALL
SELECT CAST(user_id AS VARCHAR), NULL, round(value / (value + 100), 6),
       CASE WHEN value / (value + 100) >= 0.5 THEN 1 ELSE 0 END, CAST(CAST(ts AS DATE) AS VARCHAR)
FROM events WHERE CAST(ts AS DATE) BETWEEN DATE '2024-01-23' AND DATE '2024-01-30'""",
)
ORACLES["predictions_empty"] = """
SELECT CAST(as_of AS VARCHAR) AS as_of, count(ts) AS rows,
       sum(CASE WHEN ts IS NULL THEN NULL WHEN value / (value + 100) >= 0.5 THEN 1 ELSE 0 END) AS positive
FROM (VALUES (DATE '2024-01-10'), (DATE '2024-02-03'), (DATE '2030-01-01')) AS w(as_of)
LEFT JOIN events ON CAST(ts AS DATE) BETWEEN as_of - 7 AND as_of
GROUP BY as_of"""
ORACLES["latest_snapshot"] = "SELECT o_orderkey, o_custkey, o_totalprice FROM orders"

# --- requests and model ---

ORACLES["rejected_requests"] = _with(
    _FEATURES,
    """SELECT CAST(user_id AS VARCHAR) AS user_id,
  CASE WHEN user_id % 10 IN (3, 5) THEN 'malformed' WHEN user_id % 10 = 7 THEN 'missing sector' ELSE 'accepted' END AS reason,
  count(*) AS requests
FROM features GROUP BY 1, 2""",
)
_IN_TEST = "substr(md5('42:' || CAST(user_id AS VARCHAR) || ':' || CAST(date AS VARCHAR)), 1, 8) < '33333333'"
_LABELLED = (
    _DAILY
    + f""",
labelled AS (SELECT user_id, date, stock_id, {_IN_TEST} AS in_test FROM joined WHERE purchased_stock IS NOT NULL),
sizes AS (SELECT count(*) FILTER (WHERE NOT in_test) AS train_rows, count(*) FILTER (WHERE in_test) AS test_rows FROM labelled)"""
)
ORACLES["gbt_train_score"] = _with(
    _DAILY, f"SELECT user_id, {_d('date')}, true AS in_range, true AS decided, true AS same_after_load FROM joined"
)
ORACLES["model_quality"] = _with(
    _LABELLED,
    """SELECT train_rows, test_rows, true AS train_rows_logged, true AS test_rows_logged,
  true AS better_than_chance, true AS auc_logged FROM sizes""",
)
ORACLES["early_stopping"] = "SELECT 6 AS asked, true AS kept_up_to_minimum, true AS built_in_range"


def _stumps(candidates: str, rounds: int, rate: float, lam: float, alpha: float, gamma: float, least: float, weight: float, train: str) -> str:
    """Rounds of one split each, in closed form. ``candidates``: (feature, bound, whether a line goes right) of every line.

    ``lines_r`` holds the lines with their margin after round r.
    """
    parts = []
    for r in range(1, rounds + 1):
        pulled = "sign({0}) * greatest(abs({0}) - %r, 0)" % alpha
        part = f"power({pulled}, 2) / ({{1}} + {lam})"
        gain = " + ".join([part.format("(g - gr)", "(h - hr)"), part.format("gr", "hr")]) + " - " + part.format("g", "h")
        leaf = f"-{rate} * {pulled} / ({{1}} + {lam})"
        parts.append(f"""
slopes_{r} AS MATERIALIZED (
  SELECT *, w * (1 / (1 + exp(-margin)) - y) AS g, w / (1 + exp(-margin)) * (1 - 1 / (1 + exp(-margin))) AS h
  FROM (SELECT *, CASE WHEN y = 1 THEN {weight} ELSE 1 END AS w FROM lines_{r - 1} WHERE {train}) AS weighted),
whole_{r} AS (SELECT sum(g) AS g, sum(h) AS h, count(*) AS n FROM slopes_{r}),
right_{r} AS ({candidates.format(rows=f"slopes_{r}")}),
best_{r} AS MATERIALIZED (
  SELECT kind, bound, {leaf.format("(g - gr)", "(h - hr)")} AS w_left, {leaf.format("gr", "hr")} AS w_right
  FROM (SELECT *, {gain} AS gain FROM right_{r}, whole_{r}) AS judged
  WHERE nr BETWEEN 1 AND n - 1 AND hr >= {least} AND h - hr >= {least} AND gain > greatest({gamma}, 1e-6)
  ORDER BY gain DESC LIMIT 1),
lines_{r} AS MATERIALIZED (
  SELECT l.* REPLACE (margin + coalesce(CASE WHEN {{goes_right}} THEN w_right ELSE w_left END, {leaf.format("g", "h")}) AS margin)
  FROM lines_{r - 1} AS l CROSS JOIN whole_{r} LEFT JOIN best_{r} ON true)""")
    return ",".join(parts)


_LINE_IN_TEST = "substr(md5('42:' || CAST(l_orderkey AS VARCHAR) || ':' || CAST(l_linenumber AS VARCHAR)), 1, 8) < '33333333'"
_STUMP_LINES = f"""
lines_0 AS MATERIALIZED (
  SELECT coalesce(l_quantity, 0) AS l_quantity, coalesce(l_discount, 0) AS l_discount, coalesce(l_tax, 0) AS l_tax,
    CAST(l_partkey AS VARCHAR) AS l_partkey, CAST(CAST(l_quantity AS INTEGER) AS VARCHAR) AS units, l_returnflag,
    CASE WHEN l_quantity * l_discount > 1.25 THEN 1 ELSE 0 END AS y, {_LINE_IN_TEST} AS in_test, CAST(0 AS DOUBLE) AS margin
  FROM lineitem),"""
_NUMBERS = ("l_quantity", "l_discount", "l_tax")


def _ranges(columns: tuple[str, ...]) -> str:
    """Right of each value of each column."""
    return "\nUNION ALL ".join(
        f"""SELECT '{c}' AS kind, CAST({c} AS VARCHAR) AS bound, sum(sum(g)) OVER above AS gr, sum(sum(h)) OVER above AS hr, sum(count(*)) OVER above AS nr
  FROM {{rows}} GROUP BY {c} WINDOW above AS (ORDER BY {c} DESC ROWS BETWEEN UNBOUNDED PRECEDING AND CURRENT ROW)"""
        for c in columns
    )


def _goes_right(columns: tuple[str, ...], categories: tuple[str, ...] = ()) -> str:
    tests = [*(f"WHEN '{c}' THEN {c} >= CAST(bound AS DOUBLE)" for c in columns), *(f"WHEN '{c}' THEN {c} = bound" for c in categories)]
    return f"coalesce(CASE kind {' '.join(tests)} END, false)"


_BY_MARGIN = "SELECT round(margin, 6) AS margin, count(*) AS rows, CAST(sum(y) AS BIGINT) AS positives FROM lines_{} GROUP BY 1"
ORACLES["boosted_stump"] = _with(
    _STUMP_LINES + _stumps(_ranges(_NUMBERS), 1, 1.0, 2.0, 3.0, 1.0, 5.0, 1.5, "true").replace("{goes_right}", _goes_right(_NUMBERS)),
    _BY_MARGIN.format(1),
)
ORACLES["early_stopping_auc"] = _with(
    _STUMP_LINES
    + _stumps(_ranges(_NUMBERS), 5, 0.5, 1.0, 0.0, 0.0, 1.0, 1.0, "NOT in_test").replace("{goes_right}", _goes_right(_NUMBERS))
    + ", counted AS ("
    + " UNION ALL ".join(
        f"SELECT {r} AS round, margin, sum(y) AS p, count(*) - sum(y) AS q FROM lines_{r} WHERE in_test GROUP BY margin" for r in range(1, 6)
    )
    + """),
ranked AS (
  SELECT *, coalesce(sum(q) OVER (PARTITION BY round ORDER BY margin ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below FROM counted),
aucs AS (SELECT round, sum(p * (below + 0.5 * q)) / (sum(p) * sum(q)) AS auc FROM ranked GROUP BY round),
best AS (SELECT round, auc, arg_max(round, auc) OVER (ORDER BY round) AS best FROM aucs),
stop AS (SELECT min(round) AS round FROM best WHERE best < round)""",
    """SELECT round, round(auc, 6) AS auc,
  round <= (SELECT best FROM best WHERE round = coalesce((SELECT round FROM stop), 5)) AS kept FROM aucs""",
)
_WHOLE = ("days_since_last_purchase", *_ONE_HOT)
_TRAINED = (
    _FEATURES
    + f""",
lines_0 AS MATERIALIZED (
  SELECT {", ".join(f"coalesce({c}, 0) AS {c}" for c in _WHOLE)}, purchased_stock AS y, {_IN_TEST} AS in_test, CAST(0 AS DOUBLE) AS margin
  FROM features WHERE purchased_stock IS NOT NULL),"""
    + _stumps(_ranges(_WHOLE), 4, 0.5, 1.0, 0.0, 0.0, 1.0, 1.0, "NOT in_test").replace("{goes_right}", _goes_right(_WHOLE))
    + """,
counted AS (SELECT 1 / (1 + exp(-margin)) AS score, sum(y) AS p, count(*) - sum(y) AS q FROM lines_4 WHERE in_test GROUP BY margin),
ranked AS (
  SELECT *, coalesce(sum(q) OVER (ORDER BY score ROWS BETWEEN UNBOUNDED PRECEDING AND 1 PRECEDING), 0) AS below,
    sum(p) OVER (ORDER BY score DESC) AS tp, sum(q) OVER (ORDER BY score DESC) AS fp, sum(p) OVER () AS all_p, sum(q) OVER () AS all_q FROM counted),
curve AS (SELECT *, 2 * (tp / all_p) * (tp / (tp + fp)) / (tp / all_p + tp / (tp + fp) + 1e-8) AS f1 FROM ranked),
best AS (SELECT f1, score AS threshold FROM curve ORDER BY f1 DESC, score LIMIT 1)"""
)
ORACLES["trained_model_values"] = _with(
    _TRAINED,
    """SELECT 'second-order boosted trees' AS model_type, round((SELECT sum(p * (below + 0.5 * q)) / (max(all_p) * max(all_q)) FROM curve), 6) AS auc,
  round((SELECT f1 FROM best), 6) AS best_f1, round((SELECT threshold FROM best), 6) AS threshold,
  (SELECT count(*) FROM lines_0 WHERE NOT in_test) AS train_rows, (SELECT count(*) FROM lines_0 WHERE in_test) AS test_rows, 4 AS trees_built""",
)
ORACLES["trained_model_scores"] = _with(
    _TRAINED,
    """SELECT round(1 / (1 + exp(-margin)), 6) AS probability, CASE WHEN 1 / (1 + exp(-margin)) >= threshold - 1e-12 THEN 1 ELSE 0 END AS prediction,
  count(*) AS rows, CAST(sum(y) AS BIGINT) AS purchases FROM lines_4, best GROUP BY 1, 2""",
)
_CATEGORIES = ("l_partkey", "l_returnflag", "units")
ORACLES["learned_vocab_model"] = _with(
    _STUMP_LINES
    + _stumps(
        "\nUNION ALL ".join(
            [
                _ranges(("l_tax",)),
                *(
                    f"SELECT '{c}', {c}, sum(g), sum(h), count(*) FROM {{rows}} WHERE {c} IS NOT NULL GROUP BY {c}" for c in _CATEGORIES
                ),
            ]
        ),
        3, 0.5, 1.0, 0.0, 0.0, 1.0, 1.0, "NOT in_test",
    ).replace("{goes_right}", _goes_right(("l_tax",), _CATEGORIES)),
    _BY_MARGIN.format(3),
)
_PARAMS = {
    "max_depth": _SETTINGS.max_depth,
    "learning_rate": _SETTINGS.learning_rate,
    "subsample": _SETTINGS.subsample,
    "colsample_bytree": _SETTINGS.colsample_bytree,
    "seed": _SETTINGS.random_seed,
    "n_estimators": _SETTINGS.n_estimators,
    "boosting_rounds": _SETTINGS.boosting_rounds,
    "trees_built": _SETTINGS.boosting_rounds,
}
_TEXT_PARAMS = {
    "objective": _SETTINGS.objective,
    "eval_metric": _SETTINGS.eval_metric,
    "early_stopping_tol": None,
    "early_stopping_rounds": None,
}
ORACLES["training_log"] = _with(
    _LABELLED,
    "\nUNION ALL ".join(
        f"SELECT 'train-20240130_000000' AS run_id, '{metric}' AS metric, {value} AS value, {share} AS is_share FROM sizes"
        for metric, value, share in (
            *((f"param_{k}", f"CAST({v} AS DOUBLE)", "CAST(NULL AS BOOLEAN)") for k, v in _PARAMS.items()),
            ("param_train_rows", "CAST(train_rows AS DOUBLE)", "CAST(NULL AS BOOLEAN)"),
            ("param_test_rows", "CAST(test_rows AS DOUBLE)", "CAST(NULL AS BOOLEAN)"),
            *((m, "CAST(NULL AS DOUBLE)", "true") for m in ("auc", "best_f1", "best_threshold")),
        )
    ),
)
ORACLES["model_info"] = _with(
    _LABELLED,
    f"""SELECT 'GBTClassifier' AS model_type, '{",".join(_SETTINGS.feature_columns)}' AS features,
  '{_SETTINGS.model_version}' AS version, '2024-01-30' AS last_updated, param, value FROM (
"""
    + "\nUNION ALL ".join(
        f"SELECT '{param}' AS param, {value} AS value FROM sizes"
        for param, value in (
            *((k, f"'{v}'") for k, v in (_PARAMS | _TEXT_PARAMS).items()),
            ("train_rows", "CAST(train_rows AS VARCHAR)"),
            ("test_rows", "CAST(test_rows AS VARCHAR)"),
        )
    )
    + ") AS stored",
)
ORACLES["batch_pipeline"] = _with(
    _DAILY,
    f"""SELECT CAST(user_id AS VARCHAR) AS user_id, stock_id, '2024-01-30' AS prediction_date,
  true AS in_range, true AS decided FROM joined""",
)
ORACLES["stream_scoring_model"] = _with(
    _DAILY,
    """SELECT CAST(user_id AS VARCHAR) AS user_id, stock_id, count(*) AS requests, true AS same_as_batch
FROM joined GROUP BY 1, 2""",
)
