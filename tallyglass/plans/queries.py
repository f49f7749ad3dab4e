"""Registered queries: every operator on the given tables, whole tables in and whole results out."""

from __future__ import annotations

import datetime as dt
from collections.abc import Callable
from dataclasses import replace
from functools import reduce

from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyglass.config import VOCABULARY, Settings
from tallyglass.functions.expressions import decide, in_test_share, moment, name_sql
from tallyglass.operators import by_day, curves, drift, quality
from tallyglass.operators.boosting import Boosting, boost
from tallyglass.operators.encode import (
    align,
    category_index,
    distinct_categories,
    encode_learned,
    feature_matrix,
    fill_missing,
    one_hot,
    with_category_indices,
)
from tallyglass.operators.features import (
    add_market_features,
    add_user_features,
    engineer_features,
    join_market_user,
    request_features,
)
from tallyglass.operators.model import Model, auc_by_round, kept_rounds, load_model, model_info
from tallyglass.operators.scale import fit_scaler, scale
from tallyglass.operators.split import train_test_split
from tallyglass.plans.batch import model_frame, run_batch, train_or_load, yesterday_features
from tallyglass.plans.monitoring import alerts, prediction_quality, run_daily_monitoring, run_monitoring
from tallyglass.session import durable, scratch_path
from tallyglass.sinks.metrics import flatten_metrics, log_metrics
from tallyglass.sinks.tables import save_predictions, save_snapshot
from tallyglass.sources import stored_days
from tallyglass.sources.daily import daily_bars, daily_market, daily_user
from tallyglass.sources.predictions import read_committed, read_predictions
from tallyglass.sources.snapshots import read_latest_snapshot
from tallyglass.sources.tables import actual_purchases, last_days, scan_range
from tallyglass.streaming.scoring import (
    REQUEST_SCHEMA,
    VERDICT_SCHEMA,
    Dedup,
    batch_response,
    judged_requests,
    read_rejects,
    read_requests,
    score_requests,
    start_two_sinks,
)

Query = Callable[[SparkSession, str], DataFrame]

SETTINGS = Settings()
AS_OF = SETTINGS.as_of
YESTERDAY = AS_OF - dt.timedelta(days=1)
RUN_TIME = dt.datetime.combine(AS_OF, dt.time())
DRIFT_COLUMNS = ("l_quantity", "l_extendedprice", "l_discount", "l_tax")
DRIFT_VALUES = (
    "current_mean",
    "reference_mean",
    "mean_diff_pct",
    "current_stddev",
    "reference_stddev",
    "stddev_diff_pct",
)
DRIFT_FROM = dt.date(1999, 1, 1)
REFERENCE_DAYS = (dt.date(2024, 1, 1), dt.date(2024, 1, 14))

QUERIES: dict[str, Query] = {}


def query(name: str) -> Callable[[Query], Query]:
    def register(build: Query) -> Query:
        QUERIES[name] = build
        return build

    return register


def shown(df: DataFrame, *rounded: str) -> DataFrame:
    """Dates as text, and 6 digits where the order of summation may show in the last ones.

    Columns computed from a row's own values, or from sums of whole numbers, are equal in any
    engine and stay as they are.
    """

    def present(field: T.StructField) -> str:
        name = name_sql(field.name)
        if field.name in rounded:
            return f"round({name}, 6) AS {name}"
        if isinstance(field.dataType, T.DateType):
            return f"CAST({name} AS STRING) AS {name}"
        return name

    return df.selectExpr(*[present(f) for f in df.schema])


# --- tables -------------------------------------------------------------------------------------


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def market(spark: SparkSession, sf_dir: str, start=None, end=None) -> DataFrame:
    return daily_market(table(spark, sf_dir, "events"), table(spark, sf_dir, "customer"), start, end)


def bars(spark: SparkSession, sf_dir: str, start=None, end=None) -> DataFrame:
    return daily_bars(table(spark, sf_dir, "events"), start, end)


def user(spark: SparkSession, sf_dir: str, start=None, end=None) -> DataFrame:
    return daily_user(table(spark, sf_dir, "events"), start, end)


def all_features(spark: SparkSession, sf_dir: str, start=None, end=None) -> DataFrame:
    events, customers = table(spark, sf_dir, "events"), table(spark, sf_dir, "customer")
    return engineer_features(
        daily_market(events, customers, start, end), daily_user(events, start, end), SETTINGS, VOCABULARY
    )


def judged_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Labelled documents, their length as score and a length of 1000 as decision."""
    documents = table(spark, sf_dir, "documents").select("doc_id", "n_chars")
    labels = table(spark, sf_dir, "labels").select("doc_id", "quality")
    return documents.join(labels, "doc_id").select(
        "doc_id",
        F.col("n_chars").cast("double").alias("probability"),
        (F.col("n_chars") >= 1000).cast("int").alias("prediction"),
        F.col("quality").cast("double").alias("purchased_stock"),
    )


def drift_sides(spark: SparkSession, sf_dir: str) -> tuple[DataFrame, DataFrame]:
    lines = table(spark, sf_dir, "lineitem")
    cut = F.lit(DRIFT_FROM).cast("timestamp_ntz")
    return lines.where(F.col("l_shipdate") >= cut), lines.where(F.col("l_shipdate") < cut)


def daily_decisions(spark: SparkSession, sf_dir: str, start=None, end=None) -> DataFrame:
    """A prediction per user and day: 1 where the day closed no lower than it opened."""
    return bars(spark, sf_dir, start, end).select(
        "user_id", "date", (F.col("close_price") >= F.col("open_price")).cast("int").alias("prediction")
    )


def daily_actuals(spark: SparkSession, sf_dir: str) -> DataFrame:
    return user(spark, sf_dir).select(
        "user_id", "date", F.col("purchased_stock").cast("double").alias("purchased_stock")
    )


# --- scans --------------------------------------------------------------------------------------


@query("scan_date_range")
def scan_date_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan_range(
        table(spark, sf_dir, "events"), AS_OF, dt.date(2024, 1, 8), dt.date(2024, 1, 20), column="ts"
    )
    return shown(rows.select("event_id", "user_id", F.col("ts").alias("date"), "value"))


@query("scan_user_range")
def scan_user_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan_range(
        table(spark, sf_dir, "orders"), AS_OF, dt.date(1996, 1, 1), dt.date(1996, 12, 31), "o_orderdate"
    )
    return shown(rows.select("o_orderkey", "o_custkey", F.col("o_orderdate").alias("date"), "o_totalprice"))


@query("scan_default_range")
def scan_default_range(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = scan_range(table(spark, sf_dir, "events"), AS_OF, column="ts")
    return shown(rows.select("event_id", "user_id", F.col("ts").alias("date"), "value"))


@query("row_counts")
def row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows of both sides and of their join, from one evaluation.

    A full join tells where each joined row comes from; keys are unique per side, and rows are counted while it runs.
    """
    sides = market(spark, sf_dir).select("user_id", "date", F.lit(1).alias("m")).join(
        user(spark, sf_dir).select("user_id", "date", F.lit(1).alias("u")), ["user_id", "date"], "full"
    )
    counts = sides.agg(
        F.count("m").alias("market"), F.count("u").alias("user"), F.count_if(F.col("m").isNotNull() & F.col("u").isNotNull()).alias("joined")
    )
    return counts.unpivot([], ["market", "user", "joined"], "step", "rows")


@query("actual_purchases")
def actual_purchases_week(spark: SparkSession, sf_dir: str) -> DataFrame:
    start, end = last_days(AS_OF, 7)
    return shown(actual_purchases(user(spark, sf_dir, start, end), AS_OF, 7))


# --- join and features --------------------------------------------------------------------------


@query("join_market_user")
def join_market_user_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(join_market_user(market(spark, sf_dir), user(spark, sf_dir)))


@query("join_market_user_salted")
def join_market_user_salted(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same join, with frequent keys spread over sub-keys."""
    return shown(join_market_user(market(spark, sf_dir), user(spark, sf_dir), hot_share=0.01))


def _market_feature(name: str) -> Query:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return shown(add_market_features(bars(spark, sf_dir)).select("user_id", "date", name))

    return build


for _name in ("price_momentum", "volume_ratio", "volatility"):
    QUERIES[_name] = _market_feature(_name)


@query("days_since_last_purchase")
def days_since_last_purchase(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = add_user_features(user(spark, sf_dir))
    return shown(rows.select("user_id", "date", "days_since_last_purchase"))


@query("features")
def features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(all_features(spark, sf_dir))


@query("features_learned_vocab")
def features_learned_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The indicators set by one-hot encoding with the categories found in the joined rows, as rows."""
    rows = engineer_features(market(spark, sf_dir), user(spark, sf_dir), SETTINGS)
    return shown(encode_learned(rows, ["user_id", "date"], list(VOCABULARY)))


@query("features_yesterday")
def features_yesterday(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(all_features(spark, sf_dir, YESTERDAY, YESTERDAY))


@query("features_from_state")
def features_from_state(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Yesterday's features from tables kept by day: history once, then two daily runs."""
    events, customers = table(spark, sf_dir, "events"), table(spark, sf_dir, "customer")
    root = scratch_path(spark, "days")
    stored_days.bootstrap(events, customers, root, YESTERDAY - dt.timedelta(days=2))
    for back in (1, 0):
        stored_days.advance(events, customers, root, YESTERDAY - dt.timedelta(days=back))
    kept = replace(SETTINGS, market_data_path=f"{root}/market", user_data_path=f"{root}/user")
    return shown(yesterday_features(spark, kept))


@query("training_window")
def training_window(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(all_features(spark, sf_dir, *last_days(AS_OF, 30)))


# --- encoding, filling, scaling, splitting ------------------------------------------------------


@query("distinct_categories")
def distinct_category_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    segments = distinct_categories(table(spark, sf_dir, "customer"), ["c_mktsegment"])
    kinds = distinct_categories(table(spark, sf_dir, "events"), ["event_type"])
    return segments.unionByName(kinds)


@query("one_hot_learned_vocab")
def one_hot_learned_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every customer, encoded with the segments that customers of one half have."""
    customers = table(spark, sf_dir, "customer").select("c_custkey", "c_mktsegment", "c_nationkey")
    learned = distinct_categories(customers.where("c_nationkey < 12"), ["c_mktsegment", "c_nationkey"])
    return encode_learned(customers, ["c_custkey"], ["c_mktsegment", "c_nationkey"], learned)


@query("one_hot_fixed_vocab")
def one_hot_fixed_vocab(spark: SparkSession, sf_dir: str) -> DataFrame:
    rows = market(spark, sf_dir).select("user_id", "date", *VOCABULARY)
    return shown(one_hot(rows, VOCABULARY).drop(*VOCABULARY))


@query("align_features")
def align_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(request_features(all_features(spark, sf_dir), SETTINGS))


@query("fill_missing")
def fill_missing_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    filled = ["price_momentum", "volume_ratio", "volatility", "days_since_last_purchase"]
    rows = all_features(spark, sf_dir).select("user_id", "date", *filled, "purchased_stock")
    return shown(fill_missing(rows, filled, SETTINGS.fill_value))


@query("feature_matrix")
def feature_matrix_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(
        feature_matrix(
            all_features(spark, sf_dir),
            SETTINGS.feature_columns,
            SETTINGS.label_column,
            SETTINGS.key_columns,
            SETTINGS.fill_value,
        )
    )


@query("standard_scale")
def standard_scale(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select("l_orderkey", "l_linenumber", *DRIFT_COLUMNS)
    return shown(scale(lines, fit_scaler(lines, DRIFT_COLUMNS)), *DRIFT_COLUMNS)


@query("scaled_features")
def scaled_features(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every row scaled by the statistics of the training rows alone."""
    columns = [c for c in SETTINGS.scaled_columns if c != "portfolio_diversity_score"]
    rows = all_features(spark, sf_dir).select(*SETTINGS.key_columns, *columns)
    filled = fill_missing(rows, columns, SETTINGS.fill_value).withColumn(
        "days_since_last_purchase", F.col("days_since_last_purchase").cast("double")
    )
    train, _ = train_test_split(filled, SETTINGS.key_columns, SETTINGS.test_size, SETTINGS.random_seed)
    return shown(scale(filled, fit_scaler(train, columns)), *columns)


@query("train_test_split")
def train_test_split_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    test = in_test_share(["event_id"], SETTINGS.test_size, SETTINGS.random_seed)
    return table(spark, sf_dir, "events").select(
        "event_id", F.when(test, "test").otherwise("train").alias("part")
    )


# --- decisions ----------------------------------------------------------------------------------


def _scored_documents(spark: SparkSession, sf_dir: str) -> DataFrame:
    length = F.col("n_chars").cast("double")
    return table(spark, sf_dir, "documents").select("doc_id", (length / (length + 1000)).alias("probability"))


@query("threshold_predictions")
def threshold_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    made = decide(F.col("probability"), SETTINGS.prediction_threshold)
    return shown(_scored_documents(spark, sf_dir).withColumn("prediction", made))


def formula_scorer(df: DataFrame) -> DataFrame:
    """A fixed logistic formula in place of a fitted model, so that SQL can check the scores."""
    z = (
        F.least(F.greatest(F.col("price_momentum"), F.lit(-1.0)), F.lit(1.0))
        + 0.5 * F.col("volume_ratio")
        - 0.05 * F.col("days_since_last_purchase")
        + 2.0 * F.col("risk_tolerance")
        + 0.3 * F.col("sector_Technology")
        - 0.2 * F.col("market_cap_category_Small")
        + 0.1 * F.col("day_of_week_Monday")
        - 1.0
    )
    return df.withColumn("probability", 1.0 / (1.0 + F.exp(-z)))


def scoring_requests(spark: SparkSession, sf_dir: str, features: DataFrame | None = None) -> DataFrame:
    """A scoring request per user and day, complete, as a client would send it; ``features`` if they are stored already.

    On a user's first day the day's own volume stands for the average, and no purchase yet is 0 days.
    """
    rows = (all_features(spark, sf_dir) if features is None else features).withColumns(
        {
            "avg_volume_30d": F.coalesce(F.floor("avg_volume_30d"), "volume"),
            "days_since_last_purchase": F.coalesce("days_since_last_purchase", F.lit(0)),
        }
    )
    return align(rows, REQUEST_SCHEMA.fieldNames()).select(
        [F.col(f.name).cast(f.dataType).alias(f.name) for f in REQUEST_SCHEMA]
    )


def _scored_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    return score_requests(
        scoring_requests(spark, sf_dir), formula_scorer, SETTINGS.prediction_threshold, SETTINGS, RUN_TIME
    )


@query("score_output")
def score_output(spark: SparkSession, sf_dir: str) -> DataFrame:
    scored = _scored_requests(spark, sf_dir)
    text = F.date_format("prediction_time", "yyyy-MM-dd HH:mm:ss")
    return shown(scored.withColumn("prediction_time", text), "probability")


@query("score_summary")
def score_summary(spark: SparkSession, sf_dir: str) -> DataFrame:
    return batch_response(_scored_requests(spark, sf_dir), SETTINGS.model_version)


def _stream(spark: SparkSession, requests: DataFrame, root: str, scorer, threshold: float) -> str:
    """Score written request files as a stream, with the rejects beside; returns the prediction root."""
    requests.write.text(f"{root}/requests")
    judged = judged_requests(read_requests(spark, f"{root}/requests"), scorer, threshold, SETTINGS, RUN_TIME)
    start_two_sinks(judged, f"{root}/predictions", f"{root}/checkpoint").awaitTermination()
    return f"{root}/predictions"


def _as_json(requests: DataFrame) -> DataFrame:
    return requests.select(F.to_json(F.struct(*requests.columns)).alias("value"))


@query("stream_scoring")
def stream_scoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = scratch_path(spark, "stream")
    written = _stream(spark, _as_json(scoring_requests(spark, sf_dir)), root, formula_scorer, SETTINGS.prediction_threshold)
    found = read_predictions(spark, [written], AS_OF)
    return shown(found.drop("prediction_time", "model_version"), "probability")


def _spoiled(requests: DataFrame) -> DataFrame:
    """Requests as text, some broken by user: no JSON, a wrong type, a missing field."""
    user = F.col("user_id").cast("long")
    whole = F.to_json(F.struct(*requests.columns))
    return requests.select(
        F.when(user % 10 == 3, F.concat(F.lit("user "), "user_id"))
        .when(user % 10 == 5, F.regexp_replace(whole, r'"close_price":[^,]*', '"close_price":"none"'))
        .when(user % 10 == 7, F.regexp_replace(whole, r'"sector":"[^"]*",', ""))
        .otherwise(whole)
        .alias("value")
    )


@query("rejected_requests")
def rejected_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What a stream accepts and rejects of partly broken requests, by user."""
    root = scratch_path(spark, "stream")
    written = _stream(spark, _spoiled(scoring_requests(spark, sf_dir)), root, formula_scorer, SETTINGS.prediction_threshold)
    good = read_predictions(spark, [written], AS_OF).select("user_id", F.lit("accepted").alias("reason"))
    bad = read_rejects(spark, written).select(
        F.regexp_extract("record", r'(?:user |"user_id":")(\d+)', 1).alias("user_id"), "reason"
    )
    return good.unionByName(bad).groupBy("user_id", "reason").agg(F.count(F.lit(1)).alias("requests"))


@query("batch_requests")
def batch_requests(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All of a user's requests as one document, some elements spoiled: the verdict on each position."""
    requests = scoring_requests(spark, sf_dir)
    day = Window.partitionBy("user_id").orderBy("volume", "close_price", "open_price", "high_price", "low_price", "day_of_week", "avg_volume_30d", "days_since_last_purchase", "risk_tolerance")
    spoiled = F.regexp_replace("value", r'"close_price":[^,]*', '"close_price":"none"')
    elements = requests.select("user_id", F.to_json(F.struct(*requests.columns)).alias("value"), (F.row_number().over(day) - 1).alias("at"))
    elements = elements.withColumn("value", F.when(F.col("at") % 4 == 1, spoiled).when(F.col("at") % 4 == 3, F.lit("17")).otherwise(F.col("value")))
    listed = F.array_join(F.transform(F.array_sort(F.collect_list(F.struct("at", "value"))), lambda x: x["value"]), ",")
    documents = elements.groupBy("user_id").agg(F.concat(F.lit('{"features":['), listed, F.lit("]}")).alias("value"))
    root = scratch_path(spark, "stream")
    written = _stream(spark, documents.select("value"), root, formula_scorer, SETTINGS.prediction_threshold)
    rows = [read_committed(spark, written, None, VERDICT_SCHEMA, accepted) for accepted in (True, False)]
    judged = reduce(DataFrame.unionByName, [r for r in rows if r is not None])
    return judged.groupBy("position", F.coalesce("reason", F.lit("accepted")).alias("verdict")).agg(
        F.count(F.lit(1)).alias("requests"), F.round(F.sum("probability"), 6).alias("probability")
    )


@query("stream_dedup")
def stream_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests sent twice, in files that arrive one after the other; some too late, some ahead of time: what becomes of each user's."""
    requests = scoring_requests(spark, sf_dir)
    user = F.col("user_id").cast("long")
    sent = moment(RUN_TIME) - F.make_dt_interval(hours=F.when(user % 10 == 4, 30).when(user % 10 == 6, -5).otherwise(user % 20))
    requests = requests.withColumns({"request_id": F.md5(F.to_json(F.struct(*requests.columns))), "requested_at": sent})
    root = scratch_path(spark, "stream")
    path, dedup = f"{root}/requests", Dedup(delay=dt.timedelta(hours=24), skew=dt.timedelta(hours=1))
    for _ in range(2):
        _as_json(requests).coalesce(4).write.mode("append").text(path)
        judged = judged_requests(
            read_requests(spark, path, files_per_batch=2, dedup=dedup), formula_scorer, SETTINGS.prediction_threshold, SETTINGS, RUN_TIME, dedup
        )
        start_two_sinks(judged, f"{root}/predictions", f"{root}/checkpoint").awaitTermination()
    good = read_predictions(spark, [f"{root}/predictions"], AS_OF).select("user_id", F.lit("accepted").alias("reason"))
    bad = read_rejects(spark, f"{root}/predictions").select(F.get_json_object("record", "$.user_id").alias("user_id"), "reason")
    return good.unionByName(bad).groupBy("user_id", "reason").agg(F.count(F.lit(1)).alias("requests"))


# --- quality ------------------------------------------------------------------------------------


def _pairs(on: tuple[str, ...]) -> Query:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        pairs = quality.match_counts(daily_decisions(spark, sf_dir), daily_actuals(spark, sf_dir), on)
        return shown(pairs.withColumn("pairs", F.col("pairs").cast("long")))

    return build


def _quality(on: tuple[str, ...]) -> Query:
    def build(spark: SparkSession, sf_dir: str) -> DataFrame:
        return shown(
            prediction_quality(daily_decisions(spark, sf_dir), daily_actuals(spark, sf_dir), on)
        )

    return build


QUERIES["join_pred_actual"] = _pairs(("user_id",))
QUERIES["join_pred_actual_by_date"] = _pairs(("user_id", "date"))
QUERIES["prediction_quality"] = _quality(("user_id",))
QUERIES["prediction_quality_by_date"] = _quality(("user_id", "date"))


@query("confusion_counts")
def confusion_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return quality.confusion_counts(judged_documents(spark, sf_dir))


@query("classification_metrics")
def classification_metrics(spark: SparkSession, sf_dir: str) -> DataFrame:
    counts = quality.confusion_counts(judged_documents(spark, sf_dir))
    return shown(quality.classification_metrics(counts))


def _ranked(spark: SparkSession, sf_dir: str) -> curves.RankedScores:
    return curves.rank_scores(judged_documents(spark, sf_dir), "probability", "purchased_stock")


@query("roc_auc")
def roc_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(curves.roc_auc(_ranked(spark, sf_dir)), "auc")


@query("pr_curve")
def pr_curve(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(curves.pr_curve(_ranked(spark, sf_dir)))


@query("best_f1_threshold")
def best_f1_threshold(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(curves.best_f1(curves.pr_curve(_ranked(spark, sf_dir))), "best_f1")


# --- drift and monitoring -----------------------------------------------------------------------


def line_drift(spark: SparkSession, sf_dir: str, threshold: float) -> DataFrame:
    current, reference = drift_sides(spark, sf_dir)
    return drift.drift_report(
        drift.drift_stats(current, DRIFT_COLUMNS), drift.drift_stats(reference, DRIFT_COLUMNS), threshold
    )


@query("drift_stats")
def drift_stats(spark: SparkSession, sf_dir: str) -> DataFrame:
    current, reference = drift_sides(spark, sf_dir)
    sides = [
        drift.drift_stats(df, DRIFT_COLUMNS).withColumn("side", F.lit(side))
        for side, df in (("current", current), ("reference", reference))
    ]
    return shown(reduce(DataFrame.unionByName, sides), "mean", "stddev")


@query("drift_stats_by_month")
def drift_stats_by_month(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same statistics, merged from states that are kept by month; the window is chosen among the states."""
    root = scratch_path(spark, "moments")
    lines = table(spark, sf_dir, "lineitem").withColumn("month", F.trunc("l_shipdate", "month"))
    by_day.save_days(by_day.daily_moments(lines, "month", DRIFT_COLUMNS), root)
    states = spark.read.parquet(root)
    sides = [
        by_day.merged_moments(states.where(condition), DRIFT_COLUMNS).withColumn("side", F.lit(side))
        for side, condition in (("current", F.col("day") >= DRIFT_FROM), ("reference", F.col("day") < DRIFT_FROM))
    ]
    return shown(reduce(DataFrame.unionByName, sides), "mean", "stddev")


@query("roc_auc_by_day")
def roc_auc_by_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AUC and best F1 of a week, from counts of scores that are kept by day."""
    root = scratch_path(spark, "scores")
    rows = all_features(spark, sf_dir)
    rows = fill_missing(rows, [c for c in SETTINGS.feature_columns if c in rows.columns], SETTINGS.fill_value)
    by_day.save_days(by_day.daily_scores(formula_scorer(rows), "date", label=SETTINGS.label_column), root)
    week = by_day.ranked_days(by_day.between(spark.read.parquet(root), AS_OF - dt.timedelta(days=7), AS_OF))
    best = curves.best_f1(curves.pr_curve(week)).first()
    return shown(curves.roc_auc(week).withColumn("best_f1", F.lit(best.best_f1 if best else None).cast("double")), "auc", "best_f1")


@query("drift_report")
def drift_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(line_drift(spark, sf_dir, SETTINGS.drift_threshold), *DRIFT_VALUES)


@query("drift_report_tight")
def drift_report_tight(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shown(line_drift(spark, sf_dir, 0.01), *DRIFT_VALUES)


@query("drift_any")
def drift_any(spark: SparkSession, sf_dir: str) -> DataFrame:
    return drift.any_drift(line_drift(spark, sf_dir, 0.01))


@query("alerts")
def raised_alerts(spark: SparkSession, sf_dir: str) -> DataFrame:
    performance = quality.classification_metrics(
        quality.confusion_counts(judged_documents(spark, sf_dir))
    )
    flag = drift.any_drift(line_drift(spark, sf_dir, 0.01))
    return shown(alerts(performance, flag, SETTINGS.alert_accuracy_threshold))


@query("metric_log")
def metric_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    performance = quality.classification_metrics(
        quality.confusion_counts(judged_documents(spark, sf_dir))
    )
    flag = drift.any_drift(line_drift(spark, sf_dir, 0.01))
    path = scratch_path(spark, "metrics")
    log_metrics(flatten_metrics(performance, flag), path, "run-1", RUN_TIME)
    return shown(spark.read.parquet(path).drop("logged_at"))


@query("monitoring_report")
def monitoring_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The whole monitoring job; the report it wrote, parsed back into one row per feature."""
    store = scratch_path(spark, "monitoring")
    start, end = last_days(AS_OF, 7)
    actuals = actual_purchases(user(spark, sf_dir, start, end), AS_OF, 7)
    result = run_monitoring(
        daily_decisions(spark, sf_dir, start, end).drop("date"),
        actuals,
        all_features(spark, sf_dir, YESTERDAY, YESTERDAY),
        all_features(spark, sf_dir, *REFERENCE_DAYS),
        SETTINGS,
        store,
        RUN_TIME,
    )
    values = ("current_mean", "reference_mean", "mean_diff_pct", "current_stddev", "reference_stddev", "stddev_diff_pct")
    entry = "struct<" + ", ".join(f"{v}: double" for v in values) + ", reference_is_zero: boolean, drift_detected: boolean>"
    metrics = ", ".join(
        f"{m}: double"
        for m in (
            "total_predictions", "accuracy", "precision", "recall", "f1_score", "true_positive_rate", "false_positive_rate",
        )
    )
    parsed = F.from_json(
        "value",
        f"timestamp string, model_version string, performance_metrics struct<{metrics}>, data_drift_metrics map<string, string>",
    )
    document = spark.read.text(result.report_path).select(parsed.alias("r"))
    features = document.select(
        F.col("r.timestamp").alias("timestamp"),
        F.col("r.model_version").alias("model_version"),
        "r.performance_metrics.*",
        F.col("r.data_drift_metrics")["any_drift_detected"].cast("boolean").alias("any_drift_detected"),
        F.explode(F.map_filter("r.data_drift_metrics", lambda k, _: k != "any_drift_detected")).alias(
            "feature", "entry"
        ),
    )
    return shown(features.withColumn("entry", F.from_json("entry", entry)).select("*", "entry.*").drop("entry"), *values)


@query("daily_monitoring")
def daily_monitoring(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The monitoring job on stored tables: predictions by day, purchases, and a drift reference read from the configured path."""
    store = scratch_path(spark, "daily-monitoring")
    market(spark, sf_dir).write.parquet(f"{store}/market")
    user(spark, sf_dir).withColumnRenamed("as_of_date", "current_date").write.parquet(f"{store}/user")
    all_features(spark, sf_dir, *REFERENCE_DAYS).write.parquet(f"{store}/reference")
    decisions = daily_decisions(spark, sf_dir, *last_days(AS_OF, 7))
    save_predictions(decisions.withColumnRenamed("date", "prediction_date"), f"{store}/predictions")
    settings = replace(
        SETTINGS, market_data_path=f"{store}/market", user_data_path=f"{store}/user", reference_data_path=f"{store}/reference", store_path=store
    )
    result = run_daily_monitoring(spark, settings, RUN_TIME)
    found = result.performance.select("total_predictions", "accuracy", "precision", "recall").first().asDict()
    return shown(result.drift.withColumns({name: F.lit(value) for name, value in found.items()}), *DRIFT_VALUES)


# --- round trips --------------------------------------------------------------------------------


def event_predictions(spark: SparkSession, sf_dir: str) -> DataFrame:
    value = F.col("value")
    probability = value / (value + 100)
    return table(spark, sf_dir, "events").select(
        F.col("user_id").cast("string").alias("user_id"),
        probability.alias("probability"),
        decide(probability, SETTINGS.prediction_threshold).alias("prediction"),
        F.to_date("ts").alias("prediction_date"),
    )


@query("predictions_last_n_days")
def predictions_last_n_days(spark: SparkSession, sf_dir: str) -> DataFrame:
    root = save_predictions(event_predictions(spark, sf_dir), scratch_path(spark, "predictions"))
    recent = read_predictions(spark, [root, f"{root}-online"], AS_OF, 7)
    return shown(recent.select("user_id", "probability", "prediction", "prediction_date"))


@query("predictions_two_roots")
def predictions_two_roots(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Predictions of a batch writer and of a scoring stream, read as one table."""
    root = scratch_path(spark, "predictions")
    batch = save_predictions(event_predictions(spark, sf_dir), f"{root}/batch")
    online = _stream(spark, _as_json(scoring_requests(spark, sf_dir)), root, formula_scorer, SETTINGS.prediction_threshold)
    both = read_predictions(spark, [batch, online], AS_OF, 7)
    return shown(both.drop("prediction_time", "model_version"), "probability")


@query("predictions_empty")
def predictions_empty(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per window for windows that lie on, across and after the written days; the last is empty."""
    root = save_predictions(event_predictions(spark, sf_dir), scratch_path(spark, "predictions"))
    windows = [dt.date(2024, 1, 10), dt.date(2024, 2, 3), dt.date(2030, 1, 1)]
    counted = [
        read_predictions(spark, [root], day, 7).agg(
            F.lit(day.isoformat()).alias("as_of"), F.count(F.lit(1)).alias("rows"), F.sum("prediction").alias("positive")
        )
        for day in windows
    ]
    return reduce(DataFrame.unionByName, counted)


@query("latest_snapshot")
def latest_snapshot(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The newest stamp, rewritten, after a rewrite of an older one."""
    root = scratch_path(spark, "snapshots")
    orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", "o_totalprice")
    older = orders.withColumn("o_totalprice", F.lit(0.0))
    save_snapshot(older, root, "20240130_000000")
    save_snapshot(orders, root, "20240130_000000")
    save_snapshot(older, root, "20240129_000000")
    return shown(read_latest_snapshot(spark, root))


# --- model --------------------------------------------------------------------------------------


def _trained(
    spark: SparkSession, sf_dir: str, settings: Settings = SETTINGS, features: DataFrame | None = None
) -> tuple[str, Model, DataFrame]:
    store = scratch_path(spark, "model")
    features = all_features(spark, sf_dir) if features is None else features
    model, rows = train_or_load(model_frame(features, settings), settings, store)
    return store, model, rows


def _decided(threshold: float) -> Column:
    """Whether a row's decision follows from its score."""
    return F.col("prediction") == (F.col("probability") >= threshold).cast("int")


@query("gbt_train_score")
def gbt_train_score(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Train, save, load and score every user and day.

    Trees differ between libraries, so rows say what must hold for any: a score is a probability, the decision
    follows from the stored threshold, and the loaded model scores as the trained one did.
    """
    store, model, rows = _trained(spark, sf_dir)
    again = load_model(spark, f"{store}/{SETTINGS.model_prefix}")
    scored = again.predict(model.score(rows).withColumnRenamed("probability", "trained"))
    return shown(
        scored.select(
            "user_id",
            "date",
            F.col("probability").between(0, 1).alias("in_range"),
            _decided(again.threshold).alias("decided"),
            (F.col("probability") == F.col("trained")).alias("same_after_load"),
        )
    )


@query("model_quality")
def model_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The rows trained and tested on, and whether the scores of the test rows rank labels better than labels dealt out by a hash."""
    _, model, rows = _trained(spark, sf_dir)
    _, test = train_test_split(rows, SETTINGS.key_columns, SETTINGS.test_size, SETTINGS.random_seed)
    label = SETTINGS.label_column
    scored = model.score(test)
    dealt = scored.withColumn(label, F.pmod(F.xxhash64(*SETTINGS.key_columns), F.lit(5)) < 2)
    auc, chance = (
        curves.roc_auc(curves.rank_scores(df.withColumn(label, F.col(label).cast("double")), "probability", label)).first().auc
        for df in (scored, dealt)
    )
    parts = rows.agg(
        F.count_if(~in_test_share(SETTINGS.key_columns, SETTINGS.test_size, SETTINGS.random_seed)).alias("train_rows"),
        F.count_if(in_test_share(SETTINGS.key_columns, SETTINGS.test_size, SETTINGS.random_seed)).alias("test_rows"),
    )
    return parts.select(
        "*",
        (F.col("train_rows") == F.lit(int(model.info["params"]["train_rows"]))).alias("train_rows_logged"),
        (F.col("test_rows") == F.lit(int(model.info["params"]["test_rows"]))).alias("test_rows_logged"),
        (F.lit(auc) > F.lit(chance)).alias("better_than_chance"),
        (F.abs(F.lit(auc) - F.lit(model.info["auc"])) < 1e-9).alias("auc_logged"),
    )


@query("early_stopping")
def early_stopping(spark: SparkSession, sf_dir: str) -> DataFrame:
    """A run that watches the loss of each round: the rounds kept are those up to the first lasting minimum."""
    patience = 2
    watched = replace(SETTINGS, eval_metric="logloss", early_stopping_rounds=patience, max_depth=3, boosting_rounds=6, learning_rate=0.5)
    store, _, _ = _trained(spark, sf_dir, watched)
    described = model_info(spark, f"{store}/{watched.model_prefix}")
    losses = described.select(F.explode("params").alias("name", "value")).where("name LIKE 'loss_%'")
    rounds = losses.select(F.substring("name", 6, 9).cast("int").alias("round"), F.col("value").cast("double").alias("loss"))
    before = Window.orderBy("round").rowsBetween(Window.unboundedPreceding, 0)
    # At most ``boosting_rounds`` rows.
    best = rounds.withColumn("least", F.min("loss").over(before)).withColumn(
        "best", F.max(F.when(F.col("loss") == F.col("least"), F.col("round"))).over(before)
    )
    stop = best.where(F.col("round") - F.col("best") >= patience).agg(F.min("round").alias("stop"))
    kept = best.join(F.broadcast(stop)).where("stop IS NULL OR round <= stop").agg(F.max("best").alias("rounds"))
    built = described.select(F.col("params")["trees_built"].cast("int").alias("built"), F.col("params")["boosting_rounds"].cast("int").alias("asked"))
    return kept.join(F.broadcast(built)).select(
        F.col("asked"), (F.col("built") == F.col("rounds")).alias("kept_up_to_minimum"), F.col("built").between(1, F.col("asked")).alias("built_in_range")
    )


#: Lines, and whether much is taken off their price: what stumps are grown on, whose sums SQL can give in closed form.
LINE_INPUTS = ("l_quantity", "l_discount", "l_tax")
LINE_KEY = ("l_orderkey", "l_linenumber")
LINE_CATEGORIES = ("l_partkey", "l_returnflag", "units")
REDUCED_FROM = 1.25
STUMP = Boosting(rounds=1, max_depth=1, learning_rate=1.0, reg_lambda=2.0, reg_alpha=3.0, gamma=1.0, min_child_weight=5.0, scale_pos_weight=1.5)
STUMPS = Boosting(rounds=5, max_depth=1, learning_rate=0.5)


def reduced_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").fillna(0.0, list(LINE_INPUTS))
    return lines.select(
        *LINE_KEY,
        *LINE_INPUTS,
        "l_partkey",
        "l_returnflag",
        F.col("l_quantity").cast("int").alias("units"),
        (F.col("l_quantity") * F.col("l_discount") > REDUCED_FROM).cast("double").alias("reduced"),
    )


def _by_margin(rows: DataFrame, margin: str) -> DataFrame:
    """The rows that share a score, and how many of them are positive."""
    scored = rows.select(F.expr(margin).alias("margin"), "reduced").groupBy("margin").agg(F.count(F.lit(1)).alias("rows"), F.sum("reduced").alias("positives"))
    # Stumps have few margins: those are rounded, not the rows.
    rounded = scored.groupBy(F.round("margin", 6).alias("margin"))
    return rounded.agg(F.sum("rows").alias("rows"), F.sum("positives").cast("long").alias("positives"))


@query("boosted_stump")
def boosted_stump(spark: SparkSession, sf_dir: str) -> DataFrame:
    """One second-order round of one split, every regularisation at work: the margins of both leaves and their rows."""
    lines = reduced_lines(spark, sf_dir)
    return _by_margin(lines, boost(lines, LINE_INPUTS, "reduced", LINE_KEY, STUMP).margin_sql())


@query("early_stopping_auc")
def early_stopping_auc(spark: SparkSession, sf_dir: str) -> DataFrame:
    """AUC on the test lines after each of five rounds, and whether the round is kept."""
    train, test = train_test_split(reduced_lines(spark, sf_dir), LINE_KEY, SETTINGS.test_size, SETTINGS.random_seed)
    watched = auc_by_round(boost(train, LINE_INPUTS, "reduced", LINE_KEY, STUMPS).with_staged(test), "reduced")
    kept = kept_rounds(watched, replace(SETTINGS, early_stopping_rounds=1))
    # A row per round.
    return spark.createDataFrame([(i, round(auc, 6), i <= kept) for i, auc in enumerate(watched, 1)], "round int, auc double, kept boolean")


@query("learned_vocab_model")
def learned_vocab_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Stumps on categories learned from the training lines, as sparse inputs beside a number; all lines scored, with unknown categories too."""
    lines = reduced_lines(spark, sf_dir)
    train, _ = train_test_split(lines, LINE_KEY, SETTINGS.test_size, SETTINGS.random_seed)
    index = durable(category_index(distinct_categories(train, LINE_CATEGORIES)))
    rows = with_category_indices(train, LINE_CATEGORIES, index, "categories")
    params = replace(STUMPS, rounds=3)
    trees = boost(rows, ["l_tax"], "reduced", LINE_KEY, params, "categories", index)
    return _by_margin(lines, trees.margin_sql())


#: A training run that SQL can repeat: stumps on whole-numbered features, without sampling.
REPEATABLE = replace(
    SETTINGS, booster="gbtree", max_depth=1, boosting_rounds=4, learning_rate=0.5, subsample=1.0, colsample_bytree=1.0,
    feature_columns=("days_since_last_purchase", *(f for f in SETTINGS.feature_columns if f.startswith(("sector_", "market_cap_category_", "day_of_week_")))),
)


@query("trained_model_values")
def trained_model_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The training job with regularised trees, saved: the AUC, best F1 and threshold that are stored with the model."""
    store, _, _ = _trained(spark, sf_dir, REPEATABLE)
    described = model_info(spark, f"{store}/{REPEATABLE.model_prefix}")
    counts = [F.col("params")[c].cast("long").alias(c) for c in ("train_rows", "test_rows", "trees_built")]
    return shown(described.select("model_type", "auc", "best_f1", "threshold", *counts), "auc", "best_f1", "threshold")


@query("trained_model_scores")
def trained_model_scores(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The same model, loaded: how many rows, purchases and positive decisions each score has."""
    store, _, rows = _trained(spark, sf_dir, REPEATABLE)
    scored = load_model(spark, f"{store}/{REPEATABLE.model_prefix}").predict(rows)
    by_score = scored.groupBy(F.round("probability", 6).alias("probability"), "prediction")
    return by_score.agg(F.count(F.lit(1)).alias("rows"), F.sum("purchased_stock").cast("long").alias("purchases"))


@query("training_log")
def training_log(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The logged parameters of a training run, and that its quality is logged as a share."""
    store, _, _ = _trained(spark, sf_dir)
    logged = spark.read.parquet(f"{store}/metrics")
    quality_names = F.col("metric").isin("auc", "best_f1", "best_threshold")
    return logged.select(
        "run_id",
        "metric",
        F.when(~quality_names, F.col("value")).alias("value"),
        F.when(quality_names, F.col("value").between(0, 1)).alias("is_share"),
    )


@query("model_info")
def trained_model_info(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is stored about the model, one row per parameter."""
    store, _, _ = _trained(spark, sf_dir)
    described = model_info(spark, f"{store}/{SETTINGS.model_prefix}")
    return shown(
        described.select(
            "model_type", F.concat_ws(",", "features").alias("features"), "version", "last_updated",
            F.explode("params").alias("param", "value"),
        )
    )


@query("batch_pipeline")
def batch_pipeline(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The batch job end to end; the predictions it wrote, read back."""
    store = scratch_path(spark, "batch")
    root = run_batch(all_features(spark, sf_dir), SETTINGS, store)
    threshold = load_model(spark, f"{store}/{SETTINGS.model_prefix}").threshold
    written = read_predictions(spark, [root], AS_OF, 7)
    return shown(
        written.select(
            "user_id", "stock_id", "prediction_date",
            F.col("probability").between(0, 1).alias("in_range"), _decided(threshold).alias("decided"),
        )
    )


@query("stream_scoring_model")
def stream_scoring_model(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Requests scored by the saved model as a stream; each decision and score against those of one batch."""
    # Trained on, sent and scored as a batch: joined once.
    path = scratch_path(spark, "features")
    all_features(spark, sf_dir).write.parquet(path)
    features = spark.read.parquet(path)
    store, _, _ = _trained(spark, sf_dir, features=features)
    model = load_model(spark, f"{store}/{SETTINGS.model_prefix}")
    requests = scoring_requests(spark, sf_dir, features)
    root = _stream(spark, _as_json(requests), f"{store}/stream", model.score, model.threshold)
    streamed = read_predictions(spark, [root], AS_OF)
    batch = score_requests(requests, model.score, model.threshold, SETTINGS, RUN_TIME)

    def summed(df: DataFrame, name: str) -> DataFrame:
        key = F.xxhash64("user_id", "stock_id", "prediction", F.round("probability", 9))
        return df.groupBy("user_id", "stock_id").agg(F.count(F.lit(1)).alias(name), F.bit_xor(key).alias(f"{name}_hash"))

    both = summed(streamed, "requests").join(summed(batch, "batch"), ["user_id", "stock_id"], "full")
    return both.select(
        "user_id", "stock_id", "requests", (F.col("requests_hash").eqNullSafe(F.col("batch_hash"))).alias("same_as_batch")
    )
