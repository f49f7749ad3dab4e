"""The prediction table, as written by batch runs and by the scoring stream."""

from __future__ import annotations

import datetime as dt
from functools import reduce

from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyglass.sinks.commits import exists
from tallyglass.sources.tables import last_days

# Column names of the prediction table. One schema for both writers: a batch run leaves stock_id and prediction_time null.
PREDICTION_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.StringType()),
        T.StructField("stock_id", T.StringType()),
        T.StructField("probability", T.DoubleType()),
        T.StructField("prediction", T.IntegerType()),
        T.StructField("prediction_time", T.TimestampType()),
        T.StructField("model_version", T.StringType()),
        T.StructField("prediction_date", T.DateType()),
    ]
)


def read_or_none(
    spark: SparkSession, path: str, schema: T.StructType | str, base: str, fmt: str = "parquet"
) -> DataFrame | None:
    """Read a path (or glob) that may not exist yet."""
    try:
        return spark.read.schema(schema).option("basePath", base).format(fmt).load(path)
    except AnalysisException as missing:
        if missing.getCondition() != "PATH_NOT_FOUND":
            raise
        return None


def has_file_log(spark: SparkSession, root: str) -> bool:
    """Whether a streaming sink wrote this root, which then has a log of its committed files."""
    path = spark._jvm.org.apache.hadoop.fs.Path(f"{root}/_spark_metadata")
    return path.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf()).exists(path)


BATCH_SCHEMA = "folder string, accepted long, rejected long, replaces array<string>"


def committed_folders(spark: SparkSession, root: str, dates: list[str] | None = None) -> list | None:
    """Commits of the wanted dates (by default all) that are not replaced; None if there are none.

    Commits lie in a folder per date, so those of other dates are not listed. A row per micro-batch, or per compaction that replaced some.
    """
    wanted = "*" if dates is None else f"prediction_date={{{','.join(dates)}}}"
    known = read_or_none(spark, f"{root}/commits/{wanted}", BATCH_SCHEMA, f"{root}/commits", "json")
    if known is None:
        return None
    rows = known.collect()
    replaced = {folder for r in rows for folder in r.replaces or []}
    return [r for r in rows if r.folder not in replaced]


def read_committed(
    spark: SparkSession, root: str, dates: list[str] | None, schema: T.StructType, accepted: bool
) -> DataFrame | None:
    """Rows of the committed micro-batches below ``root``, of one verdict; None if there are none. Files no commit names are not read."""
    folders = committed_folders(spark, root, dates)
    kind = f"accepted={str(accepted).lower()}"
    paths = [f"{root}/rows/{r.folder}/{kind}" for r in folders or [] if (r.accepted if accepted else r.rejected)]
    if not paths:
        return None
    rows = spark.read.schema(schema).option("basePath", f"{root}/rows").parquet(*paths)
    return rows if dates is None else rows.where(F.col("prediction_date").isin([dt.date.fromisoformat(d) for d in dates]))


def read_predictions(spark: SparkSession, roots: list[str], as_of: dt.date, days: int = 7) -> DataFrame:
    """Predictions of the last days from every root, typed and empty if there are none.

    In a root that batch runs write, the days are named in the path, so only their directories are listed,
    however long the table's history is. A root of a stream is read through its file log with a filter
    on the date: files that a failed or repeated micro-batch left behind are not in the log and are not read. The same
    holds for a root with commits, of which only batches of these days are listed. A
    streaming root must not be shared with batch writers; hence several roots and a union.
    """
    first, last = last_days(as_of, days)
    dates = [(first + dt.timedelta(days=i)).isoformat() for i in range((last - first).days + 1)]
    found = []
    for root in roots:
        if has_file_log(spark, root):
            frame = spark.read.schema(PREDICTION_SCHEMA).parquet(root)
            frame = frame.where(F.col("prediction_date").between(F.lit(first), F.lit(last)))
        elif exists(spark, f"{root}/commits"):
            frame = read_committed(spark, root, dates, PREDICTION_SCHEMA, accepted=True)
        else:
            wanted = f"{root}/prediction_date={{{','.join(dates)}}}"
            frame = read_or_none(spark, wanted, PREDICTION_SCHEMA, root)
        if frame is not None:
            found.append(frame.select(PREDICTION_SCHEMA.fieldNames()))
    if not found:
        return spark.createDataFrame([], PREDICTION_SCHEMA)
    return reduce(DataFrame.unionByName, found)
