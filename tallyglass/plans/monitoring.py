"""The monitoring job: quality of recent predictions, drift of features, report, log, alerts."""

from __future__ import annotations

import datetime as dt
from dataclasses import dataclass

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyglass.config import Settings
from tallyglass.operators.drift import any_drift, drift_report, drift_stats
from tallyglass.operators.quality import classification_metrics, confusion_counts, match_counts
from tallyglass.plans.batch import yesterday_features
from tallyglass.session import kept
from tallyglass.sinks.metrics import flatten_metrics, log_metrics, report_json, save_report
from tallyglass.sources.predictions import read_predictions
from tallyglass.sources.tables import actual_purchases


@dataclass(frozen=True)
class Monitoring:
    """Results of a run: one row of quality, one row per feature, one row per raised alert."""

    performance: DataFrame
    drift: DataFrame
    any_drift: DataFrame
    alerts: DataFrame
    report_path: str | None = None


def prediction_quality(
    predictions: DataFrame, actuals: DataFrame, on: tuple[str, ...] = ("user_id",), actual: str = "purchased_stock"
) -> DataFrame:
    pairs = match_counts(predictions, actuals, on, actual=actual)
    return classification_metrics(confusion_counts(pairs, actual=actual, weight="pairs"))


def feature_drift(current: DataFrame, reference: DataFrame, settings: Settings) -> DataFrame:
    """One aggregate per side, for the configured columns both sides have."""
    columns = [c for c in settings.numerical_columns if c in current.columns and c in reference.columns]
    return drift_report(
        drift_stats(current, columns), drift_stats(reference, columns), settings.drift_threshold
    )


def alerts(performance: DataFrame, any_drift: DataFrame, accuracy_threshold: float) -> DataFrame:
    """One row per raised alert, none on a healthy day."""
    drifted = any_drift.where("any_drift_detected").select(
        F.lit("data_drift").alias("alert"), F.lit(1.0).alias("value")
    )
    weak = performance.where(F.col("accuracy") < F.lit(accuracy_threshold)).select(
        F.lit("low_accuracy").alias("alert"), F.col("accuracy").alias("value")
    )
    return drifted.unionByName(weak)


def run_monitoring(
    predictions: DataFrame,
    actuals: DataFrame,
    current: DataFrame,
    reference: DataFrame,
    settings: Settings,
    store: str,
    written_at: dt.datetime,
    save: bool = True,
    log: bool = True,
) -> Monitoring:
    """The two results feed the report, the log and the alerts, so each is computed once and kept:
    one row and one row per feature."""
    performance = kept(prediction_quality(predictions, actuals, actual=settings.label_column))
    drift = kept(feature_drift(current, reference, settings))
    flag = any_drift(drift)
    path = None
    if save:
        features = [c for c in settings.numerical_columns if c in current.columns and c in reference.columns]
        report = report_json(performance, drift, features, settings.model_version, written_at)
        path = save_report(report, f"{store}/{settings.reports_prefix}", written_at)
    if log:
        run_id = settings.run_id or f"monitor-{written_at:%Y%m%d_%H%M%S}"
        log_metrics(flatten_metrics(performance, flag), f"{store}/metrics", run_id, written_at)
    raised = alerts(performance, flag, settings.alert_accuracy_threshold)
    return Monitoring(performance, drift, flag, raised, path)


def run_daily_monitoring(
    spark: SparkSession, settings: Settings, written_at: dt.datetime, days: int = 7
) -> Monitoring:
    """Monitoring of the stored tables: recent predictions against recent purchases, and
    yesterday's features against the reference table."""
    if settings.reference_data_path is None:
        raise ValueError("reference_data_path is not configured")
    store = settings.store_path
    roots = [f"{store}/predictions", f"{store}/online_predictions"]
    user = spark.read.parquet(settings.user_data_path)
    actuals = actual_purchases(user, settings.as_of, days, settings.label_column)
    return run_monitoring(
        read_predictions(spark, roots, settings.as_of, days),
        actuals.withColumn("user_id", F.col("user_id").cast("string")),
        yesterday_features(spark, settings),
        spark.read.parquet(settings.reference_data_path),
        settings,
        store,
        written_at,
    )
