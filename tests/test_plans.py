"""What the plans must look like: pushed filters, no Python, no cross joins, few jobs."""

import datetime as dt
import re

import pytest
from pyspark.sql import functions as F

from tallyglass.config import Settings
from tallyglass.operators.drift import drift_report, drift_stats
from tallyglass.operators.features import engineer_features
from tallyglass.plans import queries
from tallyglass.plans.queries import QUERIES, SETTINGS, all_features
from tallyglass.session import scratch_path
from tallyglass.sinks.tables import save_predictions
from tallyglass.sources.predictions import read_predictions
from tallyglass.sources.stored_days import advance, bootstrap, day_tables
from tallyglass.sources.tables import actual_purchases, scan_range
from tallyglass.streaming.scoring import judged_requests, parse_documents

WRITING = {
    "gbt_train_score",
    "model_quality",
    "early_stopping",
    "training_log",
    "model_info",
    "batch_pipeline",
    "stream_scoring",
    "stream_scoring_model",
    "rejected_requests",
    "monitoring_report",
}


def plan_of(df) -> str:
    return df._jdf.queryExecution().executedPlan().toString()


def jobs_of(spark, group, action) -> int:
    spark.sparkContext.setJobGroup(group, group)
    try:
        action()
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    return len(spark.sparkContext.statusTracker().getJobIdsForGroup(group))


@pytest.mark.parametrize("kind", ["date", "string", "timestamp", "timestamp_ntz"])
def test_date_range_reaches_the_scan(spark, kind):
    path = scratch_path(spark, "dates")
    spark.range(10).select("id", F.lit("2024-01-08").cast(kind).alias("date")).write.parquet(path)
    ranged = scan_range(spark.read.parquet(path), dt.date(2024, 1, 9))
    pushed = re.search(r"PushedFilters: \[(.*?)\]", plan_of(ranged)).group(1)
    assert "GreaterThanOrEqual(date" in pushed and "LessThan" in pushed


def test_actuals_read_three_columns_and_push_their_range(spark):
    path = scratch_path(spark, "users")
    spark.range(10).select(
        F.col("id").alias("user_id"),
        F.lit("2024-01-08").cast("date").alias("date"),
        F.lit(1).alias("purchased_stock"),
        F.lit("x").alias("other"),
    ).write.parquet(path)
    plan = plan_of(actual_purchases(spark.read.parquet(path), dt.date(2024, 1, 9)))
    assert "other" not in plan and "GreaterThanOrEqual(date" in plan


def test_predictions_list_only_their_days(spark):
    root = scratch_path(spark, "p")
    days = spark.sql("SELECT explode(sequence(date'2023-01-01', date'2023-03-31')) AS prediction_date")
    save_predictions(days.select("prediction_date", F.lit("u").alias("user_id")), root)
    read = read_predictions(spark, [root], dt.date(2023, 3, 10))
    assert len(read.inputFiles()) == 8
    assert "MetadataLogFileIndex" not in plan_of(read)


def test_market_range_bounds_the_log_scan(spark, sf_dir):
    day = dt.date(2024, 1, 29)
    plan = plan_of(all_features(spark, sf_dir, day, day))
    scans = re.findall(r"PushedFilters: \[(.*?)\]", plan)
    assert any("GreaterThanOrEqual(ts,2023-12-30" in s for s in scans)
    assert sum("LessThan(ts,2024-01-30" in s for s in scans) == 2


@pytest.mark.parametrize("name", sorted(set(QUERIES) - WRITING))
def test_no_python_and_no_cross_join(spark, sf_dir, name):
    plan = plan_of(QUERIES[name](spark, sf_dir))
    for bad in ("BatchEvalPython", "ArrowEvalPython", "CartesianProduct", "BroadcastNestedLoopJoin", "MapInPandas"):
        assert bad not in plan


def test_log_is_read_without_unused_columns(spark, sf_dir):
    plan = plan_of(QUERIES["volatility"](spark, sf_dir))
    read = re.search(r"ReadSchema: struct<(.*?)>", plan).group(1)
    assert {c.split(":")[0] for c in read.split(",")} <= {"event_id", "ts", "user_id", "value"}
    assert plan.count("Exchange") == 1


def test_join_follows_size_checks(spark, sf_dir):
    """Small sides broadcast by their size; without that, both sides shuffle once on both keys."""
    market = spark.range(1000).select(
        F.col("id").alias("user_id"), F.lit(dt.date(2024, 1, 1)).alias("date"), "id",
        *[F.lit(1.0).alias(c) for c in ("open_price", "close_price", "high_price", "low_price")],
        F.lit(1).alias("volume"), F.lit(1).alias("avg_volume_30d"),
    )
    user = market.select(
        "user_id", "date", F.col("date").alias("as_of_date"), F.col("date").alias("last_purchase_date")
    )
    assert "BroadcastHashJoin" in plan_of(engineer_features(market, user, Settings(), {}))
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        plan = plan_of(engineer_features(market, user, Settings(), {}))
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
    assert "SortMergeJoin" in plan and plan.count("Exchange hashpartitioning") == 2


def test_drift_of_twelve_columns_scans_each_side_once(spark):
    columns = list(SETTINGS.numerical_columns)
    path = scratch_path(spark, "wide")
    spark.range(100).select([F.rand(i).alias(c) for i, c in enumerate(columns)]).write.parquet(path)
    now, then = spark.read.parquet(path), spark.read.parquet(path)
    report = drift_report(drift_stats(now, columns), drift_stats(then, columns))
    assert plan_of(report).count("FileScan") == 2
    assert jobs_of(spark, "drift", report.collect) <= 6


def test_operators_are_lazy(spark, sf_dir):
    """Building features with a known vocabulary runs nothing but the reading of file schemas."""
    assert jobs_of(spark, "lazy", lambda: all_features(spark, sf_dir)) <= 2


def test_daily_run_reads_a_day_of_the_log(spark, sf_dir):
    """Every scan of the log is bounded on both sides, and of the kept tables only the needed days are read."""
    events = spark.read.parquet(f"{sf_dir}/events.parquet")
    customers = spark.read.parquet(f"{sf_dir}/customer.parquet")
    root, day = scratch_path(spark, "days"), dt.date(2024, 1, 20)
    bootstrap(events, customers, root, day - dt.timedelta(days=1))
    rows = day_tables(events, customers, root, day)
    for name, table in rows.items():
        plan = plan_of(table)
        log = [s for s in re.findall(r"PushedFilters: \[(.*?)\]", plan) if "ts" in s]
        assert log and all("GreaterThanOrEqual(ts,2024-01-20" in s and "LessThan(ts,2024-01-21" in s for s in log), name
    first = {n: sorted(map(tuple, t.collect()), key=repr) for n, t in rows.items()}
    for _ in range(2):
        advance(events, customers, root, day)
    for name in rows:
        again = spark.read.parquet(f"{root}/{name}").where(F.col("date") == F.lit(day)).select(rows[name].columns)
        assert sorted(map(tuple, again.collect()), key=repr) == first[name]


def test_a_skipped_day_is_an_error(spark):
    days = spark.createDataFrame(
        [(n, dt.datetime(2024, 1, n, 5), 1, "purchase", 1.0) for n in (1, 2, 3, 4)],
        "event_id long, ts timestamp, user_id long, event_type string, value double",
    )
    customers = spark.createDataFrame([], "c_custkey long, c_mktsegment string, c_acctbal double, c_nationkey int")
    root = scratch_path(spark, "days")
    with pytest.raises(ValueError, match="run bootstrap first"):
        advance(days, customers, root, dt.date(2024, 1, 2))
    advance(days, customers, root, dt.date(2024, 1, 1))
    with pytest.raises(ValueError, match="advance the missing days first"):
        advance(days.where("event_id > 1"), customers, root, dt.date(2024, 1, 3))
    for n in (2, 3, 1):
        advance(days, customers, root, dt.date(2024, 1, n))
    state = spark.read.parquet(f"{root}/state").where("date = date'2024-01-03'").collect()
    assert [(r.days, r.purchase_days) for r in state] == [(3, 3)]


def test_state_keeps_users_without_events(spark):
    days = spark.createDataFrame(
        [(1, dt.datetime(2024, 1, 1, 5), 1, "purchase", 1.0), (2, dt.datetime(2024, 1, 3, 5), 2, "view", 2.0), (3, dt.datetime(2024, 1, 4, 5), 1, "view", 3.0)],
        "event_id long, ts timestamp, user_id long, event_type string, value double",
    )
    customers = spark.createDataFrame([], "c_custkey long, c_mktsegment string, c_acctbal double, c_nationkey int")
    root = scratch_path(spark, "days")
    for d in range(1, 5):
        advance(days, customers, root, dt.date(2024, 1, d))
    last = spark.read.parquet(f"{root}/state").where("date = date'2024-01-04'").orderBy("user_id").drop("date").collect()
    assert [tuple(r) for r in last] == [(1, dt.date(2024, 1, 1), 2, 1), (2, None, 1, 0)]
    user = {(r.user_id, r.date.day): r for r in spark.read.parquet(f"{root}/user").collect()}
    assert set(user) == {(1, 1), (2, 3), (1, 4)}
    assert user[1, 4].last_purchase_date == dt.date(2024, 1, 1) and user[1, 4].risk_tolerance == 1.0
    assert user[1, 1].last_purchase_date is None and user[1, 1].risk_tolerance == 0.0


def test_scored_requests_are_joined_once(spark, tmp_path, monkeypatch):
    """The model's rows, the requests sent and the batch they are compared with come from one table of features."""
    events = spark.range(1200).select(
        F.col("id").alias("event_id"),
        F.timestamp_add("HOUR", (F.col("id") % 17 * 24 + F.col("id") % 5).cast("int"), F.lit(dt.datetime(2024, 1, 2))).alias("ts"),
        (F.col("id") % 41).alias("user_id"),
        F.when(F.col("id") % 7 < 3, "purchase").otherwise("view").alias("event_type"),
        (F.col("id") % 23 + 1.0).alias("value"),
    )
    events.write.parquet(f"{tmp_path}/events.parquet")
    spark.range(40).select(
        F.col("id").alias("c_custkey"), (F.col("id") % 5).cast("int").alias("c_nationkey"), (F.col("id") * 200.0).alias("c_acctbal"), F.lit("BUILDING").alias("c_mktsegment")
    ).write.parquet(f"{tmp_path}/customer.parquet")
    asked, build = [], queries.all_features

    def counting(*args):
        asked.append(args)
        return build(*args)

    monkeypatch.setattr(queries, "all_features", counting)
    rows = QUERIES["stream_scoring_model"](spark, str(tmp_path)).collect()
    assert len(asked) == 1
    # User 40 is no customer, so its requests lack the stock.
    assert {r.user_id for r in rows} == {str(i) for i in range(40)} and all(r.same_as_batch for r in rows)
    assert sum(r.requests for r in rows) == events.where("user_id < 40").select("user_id", F.to_date("ts")).distinct().count()


def test_only_documents_that_may_wrap_requests_are_searched_for_the_key(spark):
    lines = ['{"user_id": "a"}', '{"features": [{"user_id": "b"}, 3]}', r'{"\u0066eatures": [{"user_id": "c"}]}', '[{"user_id": "d"}]', '{"user_id": "features"}']
    documents = spark.createDataFrame([(x,) for x in lines], "value string")
    parsed = parse_documents(documents)
    found = [(r.user_id, r.position) for r in parsed.collect()]
    assert sorted(found, key=str) == sorted([("a", None), ("b", 0), (None, 1), ("c", 0), ("d", 0), ("features", None)], key=str)
    plan = plan_of(parsed)
    assert plan.count("get_json_object") == plan.count("Contains(value") / 2 > 0
    # What arrived is written as text again for rejects only.
    judged = plan_of(judged_requests(parsed, queries.formula_scorer, 0.5, SETTINGS, queries.RUN_TIME))
    assert re.search(r"CASE WHEN isnotnull\(reason#\d+\) THEN coalesce\(_corrupt_record", judged)
