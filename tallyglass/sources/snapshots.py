"""Reading back processed snapshots.

A snapshot is a folder that is written once and a numbered commit that names it. Writing a stamp again adds a folder
and a commit with a higher number; what is committed never changes.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyglass.sources.predictions import read_or_none

COMMIT_SCHEMA = T.StructType(
    [
        T.StructField("snapshot_ts", T.StringType()),
        T.StructField("rows", T.LongType()),
        T.StructField("folder", T.StringType()),
        T.StructField("number", T.LongType()),
    ]
)


def commits(spark: SparkSession, root: str) -> DataFrame | None:
    return read_or_none(spark, f"{root}/commits", COMMIT_SCHEMA, f"{root}/commits", "json")


def read_snapshot(spark: SparkSession, root: str, stamp: str | None = None) -> DataFrame:
    """All rows of the last commit of a stamp, by default the newest one; an error if there is none.

    Other snapshots' folders are not even listed.
    """
    known = commits(spark, root)
    if known is not None and stamp is not None:
        known = known.where(F.col("snapshot_ts") == stamp)
    last = known.orderBy(F.desc("snapshot_ts"), F.desc("number")).first() if known is not None else None
    if last is None:
        raise ValueError(f"no snapshot {stamp or ''} below {root}")
    return spark.read.parquet(f"{root}/rows/{last.folder}")


def read_latest_snapshot(spark: SparkSession, root: str) -> DataFrame:
    return read_snapshot(spark, root)
