"""Local sessions for tests and benchmarks, and the shared folder for written intermediates."""

from __future__ import annotations

import os
import tempfile
import uuid

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import types as T

# What every session of this library needs, local or not.
SESSION_CONF = {
    "spark.sql.session.timeZone": "UTC",
    # Sides already partitioned by the user alone may join on user and date without a shuffle.
    "spark.sql.requireAllClusterKeysForCoPartition": "false",
    # Checkpoints go when nothing refers to them any more.
    "spark.cleaner.referenceTracking.cleanCheckpoints": "true",
}


def job_session(name: str) -> SparkSession:
    builder = SparkSession.builder.appName(name)
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    return builder.getOrCreate()


def local_session(name: str = "tallyglass", cores: int | str | None = None) -> SparkSession:
    cores = cores or os.environ.get("BENCH_CPUS", "8")
    builder = SparkSession.builder.master(f"local[{cores}]").appName(name)
    for key, value in SESSION_CONF.items():
        builder = builder.config(key, value)
    return (
        builder
        .config("spark.sql.shuffle.partitions", str(cores).replace("*", "8"))
        .config("spark.ui.enabled", "false")
        .config("spark.driver.memory", os.environ.get("BENCH_DRIVER_MEMORY", "8g"))
        .config("spark.sql.adaptive.enabled", "true")
        .config("spark.sql.adaptive.skewJoin.enabled", "true")
        .getOrCreate()
    )


def shared_dir(spark: SparkSession) -> str:
    """The folder every executor can reach, as the session names it.

    Only a session that names none (a local test) gets a temporary one.
    """
    context = spark.sparkContext
    named = spark.conf.get("spark.checkpoint.dir", None) or context.getCheckpointDir()
    if not named:
        if not context.master.startswith("local"):
            raise ValueError("set spark.checkpoint.dir to a folder all executors share")
        named = tempfile.mkdtemp(prefix="tallyglass-")
    if not context.getCheckpointDir():
        context.setCheckpointDir(named)
    return named.rstrip("/")


def scratch_path(spark: SparkSession, name: str) -> str:
    """A fresh path for a written table below the shared folder.

    All of an application's lie in one folder, which Hadoop removes when the driver's JVM ends.
    """
    own = f"{shared_dir(spark)}/tallyglass/{spark.sparkContext.applicationId}"
    path = spark._jvm.org.apache.hadoop.fs.Path(own)
    files = path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())
    if not files.exists(path):
        files.mkdirs(path)
        files.deleteOnExit(path)
    return f"{own}/{name}-{uuid.uuid4().hex}"


def drop_scratch(spark: SparkSession, path: str) -> None:
    """Remove a table written to a ``scratch_path`` once nothing reads it any more."""
    target = spark._jvm.org.apache.hadoop.fs.Path(path)
    target.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).delete(target, True)


def kept(df: DataFrame) -> DataFrame:
    """Evaluate a result of fixed size (a few rows, whatever the input) once for several uses."""
    return df.sparkSession.createDataFrame(df.toArrow(), df.schema)


def one_row(spark: SparkSession, columns: dict[str, Column], schema: T.StructType) -> DataFrame:
    """A single row of constants, made by Spark itself without a Python worker."""
    return spark.range(0, 1, 1, 1).select(
        [columns[f.name].cast(f.dataType).alias(f.name) for f in schema]
    )


def durable(df: DataFrame) -> DataFrame:
    """Cut the lineage with a reliable checkpoint, so that losing an executor repeats nothing."""
    shared_dir(df.sparkSession)
    return df.checkpoint(eager=True)
