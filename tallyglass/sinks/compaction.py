"""Fewer, larger files for a day of a root that a scoring stream commits its micro-batches to."""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyglass.session import drop_scratch
from tallyglass.sinks import commits
from tallyglass.sources.predictions import BATCH_SCHEMA, committed_folders, read_or_none


def compact(spark: SparkSession, root: str, day: str, schema: T.StructType) -> int | None:
    """Rewrite a day's live folders as one and put it in their place by a commit; returns how many were replaced, None if nothing was done.

    Files are sized by adaptive execution. Readers see the old folders until the commit and the new one from then on, never both. A day's compactions are
    numbered: of two that run at a time one commits, and the other's output is dropped. Replaced folders stay for readers that have
    listed them, until ``vacuum``.
    """
    generation = _generations(spark, root, day)
    live = committed_folders(spark, root, [day]) or []
    if len(live) < 2:
        return None
    folder = f"batch=compact-{day}-{uuid.uuid4().hex}"
    paths = [f"{root}/rows/{r.folder}" for r in live]
    rows = spark.read.schema(schema).option("basePath", f"{root}/rows").parquet(*paths).select(schema.fieldNames())
    seen = Observation()
    rows.hint("rebalance", "accepted").observe(
        seen, F.count_if("accepted").alias("accepted"), F.count_if(~F.col("accepted")).alias("rejected")
    ).write.partitionBy("accepted", "prediction_date").parquet(f"{root}/rows/{folder}")
    values = seen.get | {"folder": folder, "replaces": [r.folder for r in live]}
    if commits.create(spark, f"{root}/commits/prediction_date={day}", f"compact-{generation + 1:06d}", values):
        return len(live)
    drop_scratch(spark, f"{root}/rows/{folder}")
    return None


def _generations(spark: SparkSession, root: str, day: str) -> int:
    """How often a day was compacted."""
    known = _known(spark, root, f"prediction_date={day}")
    return 0 if known is None else known.where(F.size("replaces") > 0).count()


def _known(spark: SparkSession, root: str, days: str = "*") -> DataFrame | None:
    return read_or_none(spark, f"{root}/commits/{days}", BATCH_SCHEMA, f"{root}/commits", "json")


def vacuum(spark: SparkSession, root: str) -> int:
    """Delete the folders that compactions replaced, once no reader can have listed them any more; returns how many are gone."""
    known = _known(spark, root)
    if known is None:
        return 0
    gone = [r.folder for r in known.select(F.explode("replaces").alias("folder")).distinct().collect()]
    gone = [f for f in gone if commits.exists(spark, f"{root}/rows/{f}")]
    for folder in gone:
        drop_scratch(spark, f"{root}/rows/{folder}")
    return len(gone)
