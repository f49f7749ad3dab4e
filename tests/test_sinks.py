"""Written tables: round trips, reruns, missing roots, reports."""

import datetime as dt
import json

import pytest
from pyspark.sql import functions as F

from tallyglass.operators.drift import any_drift, drift_report, drift_stats
from tallyglass.operators.quality import classification_metrics, confusion_counts
from tallyglass.plans.monitoring import alerts
from tallyglass.session import scratch_path
from tallyglass.sinks.metrics import flatten_metrics, log_metrics, metric_rows, report_json, save_report
from tallyglass.sinks.tables import save_predictions, save_snapshot
from tallyglass.sources.predictions import PREDICTION_SCHEMA, read_predictions
from tallyglass.sources.snapshots import read_latest_snapshot, read_snapshot

NOW = dt.datetime(2024, 1, 30, 6, 0)


def predictions(spark, day, probability=0.5, n=10):
    return spark.range(n).select(
        F.col("id").cast("string").alias("user_id"),
        F.lit(probability).alias("probability"),
        F.lit(1).alias("prediction"),
        F.lit(day).cast("date").alias("prediction_date"),
    )


def test_last_days_cover_both_ends(spark):
    root = scratch_path(spark, "p")
    days = spark.sql("SELECT explode(sequence(date'2024-01-01', date'2024-01-31')) AS prediction_date")
    rows = days.select(
        "prediction_date",
        F.lit("u").alias("user_id"),
        F.lit(0.5).alias("probability"),
        F.lit(1).alias("prediction"),
    )
    save_predictions(rows, root)
    found = read_predictions(spark, [root], dt.date(2024, 1, 30), 7)
    assert found.schema.fieldNames() == PREDICTION_SCHEMA.fieldNames()
    assert sorted({r.prediction_date.day for r in found.collect()}) == list(range(23, 31))
    assert len(found.inputFiles()) == 8


def test_rerun_replaces_its_day_only(spark):
    root = scratch_path(spark, "p")
    save_predictions(predictions(spark, "2024-01-28"), root)
    save_predictions(predictions(spark, "2024-01-29", 0.1), root)
    save_predictions(predictions(spark, "2024-01-29", 0.9, n=4).drop("prediction_date"), root, dt.date(2024, 1, 29))
    found = read_predictions(spark, [root], dt.date(2024, 1, 30), 7)
    counts = found.groupBy("prediction_date").agg(F.count("*").alias("n"), F.max("probability").alias("m"))
    assert {(r.prediction_date.day, r.n, r.m) for r in counts.collect()} == {(28, 10, 0.5), (29, 4, 0.9)}


def test_missing_roots_give_a_typed_empty_frame(spark):
    none = read_predictions(spark, [scratch_path(spark, "none")], dt.date(2024, 1, 30))
    assert none.schema == PREDICTION_SCHEMA and none.count() == 0
    root = save_predictions(predictions(spark, "2023-01-01"), scratch_path(spark, "p"))
    assert read_predictions(spark, [root], dt.date(2024, 1, 30)).count() == 0
    assert read_predictions(spark, [root, f"{root}-online"], dt.date(2023, 1, 3)).count() == 10


def test_hot_day_is_written_whole(spark):
    root = scratch_path(spark, "p")
    hot = predictions(spark, "2024-01-29", n=5000).unionByName(predictions(spark, "2024-01-30", n=10))
    save_predictions(hot, root)
    assert read_predictions(spark, [root], dt.date(2024, 1, 30)).count() == 5010


def test_latest_snapshot_ignores_older_and_uncommitted(spark):
    root = scratch_path(spark, "s")
    with pytest.raises(ValueError, match="no snapshot"):
        read_latest_snapshot(spark, root)
    assert save_snapshot(spark.range(5), root, "20240101_000000") == 5
    assert save_snapshot(spark.range(7), root, "20240102_000000") == 7
    spark.range(9).write.parquet(f"{root}/rows/snapshot_ts=20240103_000000")
    assert read_latest_snapshot(spark, root).count() == 7


def test_rewritten_snapshot_is_read_by_its_last_commit(spark):
    root = scratch_path(spark, "s")
    save_snapshot(spark.range(5), root, "20240101_000000")
    save_snapshot(spark.range(3), root, "20240201_000000")
    save_snapshot(spark.range(8), root, "20240101_000000")
    assert read_snapshot(spark, root, "20240101_000000").count() == 8
    assert read_latest_snapshot(spark, root).count() == 3
    with pytest.raises(ValueError, match="no snapshot"):
        read_snapshot(spark, root, "20230101_000000")


def test_failed_rewrite_leaves_the_committed_snapshot(spark):
    root = scratch_path(spark, "s")
    save_snapshot(spark.range(5), root, "20240101_000000")
    broken = spark.range(9).select(F.when(F.col("id") == 8, F.raise_error(F.lit("lost"))).otherwise(F.col("id")).alias("id"))
    with pytest.raises(Exception, match="lost"):
        save_snapshot(broken, root, "20240101_000000")
    assert sorted(r.id for r in read_snapshot(spark, root, "20240101_000000").collect()) == list(range(5))


def test_repeated_run_replaces_its_metrics(spark):
    performance, drift = parts(spark)
    path = scratch_path(spark, "m")
    for run in ("r1", "r2", "r1"):
        log_metrics(flatten_metrics(performance, any_drift(drift)), path, run, NOW)
    assert {tuple(r) for r in spark.read.parquet(path).groupBy("run_id").count().collect()} == {("r1", 8), ("r2", 8)}


def parts(spark, accuracy_ok=True):
    pairs = [(1, 1.0), (0, 0.0), (1, 0.0 if not accuracy_ok else 1.0)]
    performance = classification_metrics(
        confusion_counts(spark.createDataFrame(pairs, "prediction int, purchased_stock double"))
    )
    then = spark.createDataFrame([(1.0, 0.0), (3.0, 0.0)], "a double, z double")
    now = spark.createDataFrame([(1.0, 1.0), (3.0, 2.0)], "a double, z double")
    return performance, drift_report(drift_stats(now, ["a", "z"]), drift_stats(then, ["a", "z"]))


def test_metric_log_keeps_numbers_and_flags_and_appends(spark):
    performance, drift = parts(spark)
    path = scratch_path(spark, "m")
    for run in ("r1", "r2"):
        log_metrics(flatten_metrics(performance, any_drift(drift)), path, run, NOW)
    rows = spark.read.parquet(path)
    assert rows.groupBy("run_id").count().where("count = 8").count() == 2
    values = {r.metric: r.value for r in rows.where("run_id = 'r1'").collect()}
    assert values["performance_accuracy"] == 1.0 and values["drift_detected"] == 1.0
    mixed = spark.createDataFrame([(1, True, "x")], "n int, flag boolean, name string")
    assert {r.metric: r.value for r in metric_rows(mixed).collect()} == {"n": 1.0, "flag": 1.0}


def test_report_is_valid_json(spark):
    performance, drift = parts(spark)
    report = report_json(performance, drift, ["a", "z"], "1.0.0", NOW)
    path = save_report(report, scratch_path(spark, "r"), NOW)
    assert path.endswith("/monitoring_report_20240130_060000.json")

    def refuse(text):
        raise AssertionError(text)

    document = json.loads(spark.read.text(path).first().value, parse_constant=refuse)
    assert document["timestamp"] == "2024-01-30T06:00:00" and document["model_version"] == "1.0.0"
    assert document["performance_metrics"]["accuracy"] == 1.0
    drifted = document["data_drift_metrics"]
    assert drifted["any_drift_detected"] is True
    assert drifted["a"]["drift_detected"] is False and drifted["a"]["mean_diff_pct"] == 0.0
    assert drifted["z"]["reference_is_zero"] is True and "mean_diff_pct" not in drifted["z"]


def test_alerts(spark):
    performance, drift = parts(spark, accuracy_ok=False)
    raised = {r.alert for r in alerts(performance, any_drift(drift), 0.7).collect()}
    assert raised == {"data_drift", "low_accuracy"}
    quiet, _ = parts(spark)
    none = any_drift(drift.where("feature = 'a'"))
    assert alerts(quiet, none, 0.7).count() == 0
    assert alerts(quiet, none, 1.0).count() == 0
