"""The metric history, one partition a run, and the monitoring report."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyglass.functions.expressions import moment
from tallyglass.sinks.tables import write_by_partition


def numeric_columns(df: DataFrame) -> list[str]:
    """Columns a metric log accepts: numbers and flags."""
    return [f.name for f in df.schema if isinstance(f.dataType, (T.NumericType, T.BooleanType))]


def flatten_metrics(performance: DataFrame, any_drift: DataFrame) -> DataFrame:
    """Long form ``(metric, value)`` of one run: prefixed quality metrics and the drift flag."""
    renamed = performance.withColumnsRenamed({c: f"performance_{c}" for c in performance.columns})
    flag = any_drift.select(F.col("any_drift_detected").cast("int").alias("drift_detected"))
    return metric_rows(renamed).unionByName(metric_rows(flag))


def metric_rows(df: DataFrame) -> DataFrame:
    """One row per numeric column of a one-row frame; other columns are left out."""
    columns = numeric_columns(df)
    return df.select([F.col(c).cast("double").alias(c) for c in columns]).unpivot(
        [], columns, "metric", "value"
    )


def log_metrics(metrics: DataFrame, path: str, run_id: str, logged_at: dt.datetime) -> None:
    """Add a run to the history, or put a repeated run in its own place."""
    rows = metrics.select("metric", "value", moment(logged_at).alias("logged_at"), F.lit(run_id).alias("run_id"))
    write_by_partition(rows.coalesce(1), path, "run_id")


def report_json(
    performance: DataFrame, drift: DataFrame, features: list[str], model_version: str, written_at: dt.datetime
) -> DataFrame:
    """One row, one column: the report document. Its keys are fixed values.

    The inputs hold one row and one row per feature. An infinite difference (a reference value of
    zero) is no valid JSON number and becomes null beside ``reference_is_zero``.
    """

    def finite(name: str):
        return F.when(F.abs(F.col(name)) != F.lit(float("inf")), F.col(name)).alias(name)

    entry = F.struct(
        "current_mean",
        "reference_mean",
        finite("mean_diff_pct"),
        "current_stddev",
        "reference_stddev",
        finite("stddev_diff_pct"),
        ((F.col("reference_mean") == 0) | (F.col("reference_stddev") == 0)).alias("reference_is_zero"),
        "drift_detected",
    )
    by_feature = drift.agg(
        F.struct(
            *[F.max(F.when(F.col("feature") == f, entry)).alias(f) for f in features],
            F.coalesce(F.bool_or("drift_detected"), F.lit(False)).alias("any_drift_detected"),
        ).alias("data_drift_metrics"),
        F.lit(1).alias("run"),
    )
    quality = performance.select(
        F.struct(*performance.columns).alias("performance_metrics"), F.lit(1).alias("run")
    )
    document = F.to_json(
        F.struct(
            F.lit(written_at.isoformat()).alias("timestamp"),
            "performance_metrics",
            "data_drift_metrics",
            F.lit(model_version).alias("model_version"),
        )
    )
    # Both sides are a single row, as global aggregates.
    return quality.join(F.broadcast(by_feature), "run").select(document.alias("value"))


def save_report(report: DataFrame, root: str, written_at: dt.datetime) -> str:
    path = f"{root}/monitoring_report_{written_at:%Y%m%d_%H%M%S}.json"
    report.coalesce(1).write.mode("overwrite").text(path)
    return path
