"""Market and user tables: date ranges and normalisation at the source."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def default_range(
    as_of: dt.date, start: dt.date | None = None, end: dt.date | None = None
) -> tuple[dt.date, dt.date]:
    """Both ends inclusive; yesterday to today where not given."""
    return start or as_of - dt.timedelta(days=1), end or as_of


def last_days(as_of: dt.date, days: int) -> tuple[dt.date, dt.date]:
    """``days`` back from ``as_of``, both ends inclusive: ``days + 1`` dates."""
    return as_of - dt.timedelta(days=days), as_of


def in_date_range(df: DataFrame, column: str, start: dt.date | None, end: dt.date) -> Column:
    """Inclusive date range on the column as stored, so that it reaches the scan.

    Comparing the stored type with constants keeps the predicate in ``PushedFilters`` (or in
    ``PartitionFilters``) for dates, timestamps and ISO strings alike, and keeps all of the end
    day when the column holds a time of day. Without a start the range is open to the past.
    """
    kind = df.schema[column].dataType

    def bound(day: dt.date) -> Column:
        return F.lit(day.isoformat()) if isinstance(kind, T.StringType) else F.lit(day).cast(kind)

    inside = F.col(column) < bound(end + dt.timedelta(days=1))
    return inside if start is None else (F.col(column) >= bound(start)) & inside


def scan_range(
    df: DataFrame,
    as_of: dt.date,
    start: dt.date | None = None,
    end: dt.date | None = None,
    column: str = "date",
) -> DataFrame:
    """Rows of the range, with the date column as a proper date."""
    wanted = in_date_range(df, column, *default_range(as_of, start, end))
    return df.where(wanted).withColumn(column, F.to_date(column))


def read_market(
    spark: SparkSession,
    path: str,
    as_of: dt.date,
    start: dt.date | None = None,
    end: dt.date | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return scan_range(reader.parquet(path), as_of, start, end)


def read_user(
    spark: SparkSession,
    path: str,
    as_of: dt.date,
    start: dt.date | None = None,
    end: dt.date | None = None,
    schema: T.StructType | None = None,
) -> DataFrame:
    reader = spark.read.schema(schema) if schema else spark.read
    return normalise_user(scan_range(reader.parquet(path), as_of, start, end))


def normalise_user(user: DataFrame) -> DataFrame:
    """Rename ``current_date`` and require it.

    Left under that name, a missing column would silently resolve to today's date.
    """
    if "current_date" in user.columns:
        user = user.withColumnRenamed("current_date", "as_of_date")
    if "as_of_date" not in user.columns:
        raise ValueError("user table has neither as_of_date nor current_date")
    return user.withColumns(
        {c: F.to_date(c) for c in ("date", "last_purchase_date", "as_of_date")}
    )


def actual_purchases(
    user: DataFrame, as_of: dt.date, days: int = 7, label: str = "purchased_stock"
) -> DataFrame:
    """Key, date and label (as double) of the last days."""
    recent = scan_range(user, as_of, *last_days(as_of, days))
    return recent.select("user_id", "date", F.col(label).cast("double").alias(label))
