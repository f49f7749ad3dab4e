"""Partitioned parquet tables, safe to rerun."""

from __future__ import annotations

import datetime as dt
import uuid

from pyspark.sql import DataFrame, Observation
from pyspark.sql import functions as F

from tallyglass.sinks.commits import append
from tallyglass.sources.predictions import PREDICTION_SCHEMA


def write_by_partition(df: DataFrame, root: str, column: str) -> None:
    """Replace the partitions present in ``df`` and leave the others."""
    (
        df.write.mode("overwrite")
        .option("partitionOverwriteMode", "dynamic")
        .partitionBy(column)
        .parquet(root)
    )


def save_predictions(scored: DataFrame, root: str, as_of: dt.date | None = None) -> str:
    """Write scored rows below ``prediction_date``; the date is ``as_of`` unless already a column.

    Rows of one date are written by the tasks that scored them, without a shuffle. Rows of many
    dates are first rebalanced by date, so that each date gets few files; adaptive execution splits
    a date that holds a large part of the rows over several tasks.
    """
    if as_of is not None:
        scored = scored.withColumn("prediction_date", F.lit(as_of))
    else:
        scored = scored.hint("rebalance", "prediction_date")
    columns = [
        F.col(f.name).cast(f.dataType).alias(f.name)
        if f.name in scored.columns
        else F.lit(None).cast(f.dataType).alias(f.name)
        for f in PREDICTION_SCHEMA
    ]
    write_by_partition(scored.select(columns), root, "prediction_date")
    return root


def save_snapshot(df: DataFrame, root: str, stamp: str) -> int:
    """Write a snapshot into a folder of its own, then commit it; returns its row count, observed during the write.

    A write that did not finish has no commit and is never read. Writing a stamp again leaves the
    committed folder as it is, for readers and in case the new write fails.
    """
    spark = df.sparkSession
    seen, folder = Observation(), f"snapshot_ts={stamp}-{uuid.uuid4().hex}"
    df.observe(seen, F.count(F.lit(1)).alias("rows")).write.parquet(f"{root}/rows/{folder}")
    rows = seen.get["rows"]
    append(spark, f"{root}/commits", {"snapshot_ts": stamp, "rows": rows, "folder": folder})
    return rows
