"""Market and user tables kept by day, so that a daily job reads a day of the log and not its history.

Below the root lie ``market`` and ``user``, partitioned by date, and ``state``: per day one row for every user
seen so far, with the last purchase and the numbers of days. A day is computed from its own events, the state of the day before and, for
the trailing average, the bars of thirty days; both tables come from one aggregate of the log.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyglass.sinks.tables import write_by_partition
from tallyglass.sources.daily import AVERAGE_DAYS, bar_values, purchase_value, with_owner
from tallyglass.sources.predictions import read_or_none
from tallyglass.sources.tables import in_date_range

STATE_SCHEMA = T.StructType(
    [
        T.StructField("user_id", T.LongType()),
        T.StructField("last_purchase_date", T.DateType()),
        T.StructField("days", T.LongType()),
        T.StructField("purchase_days", T.LongType()),
        T.StructField("date", T.DateType()),
    ]
)
BAR_SCHEMA = T.StructType(
    [T.StructField("user_id", T.LongType()), T.StructField("volume", T.LongType()), T.StructField("date", T.DateType())]
)


def bootstrap(events: DataFrame, customers: DataFrame, root: str, through: dt.date) -> None:
    """State and bars of all days up to ``through``, once, before the first daily run."""
    history = events.where(in_date_range(events, "ts", None, through))
    days = history.groupBy("user_id", F.to_date("ts").alias("date")).agg(*bar_values(), purchase_value())
    bars = with_owner(days.withColumn("avg_volume_30d", F.lit(None).cast("double")), customers)
    write_by_partition(bars.hint("rebalance", "date"), f"{root}/market", "date")
    state = days.groupBy("user_id").agg(
        F.max(F.when(F.col("purchased_stock") == 1, F.col("date"))).alias("last_purchase_date"),
        F.count(F.lit(1)).alias("days"),
        F.sum("purchased_stock").alias("purchase_days"),
    )
    write_by_partition(state.withColumn("date", F.lit(through)), f"{root}/state", "date")


def advance(events: DataFrame, customers: DataFrame, root: str, day: dt.date) -> None:
    """Add a day to the tables. Running a day again replaces it."""
    for name, rows in day_tables(events, customers, root, day).items():
        write_by_partition(rows, f"{root}/{name}", "date")


def day_tables(events: DataFrame, customers: DataFrame, root: str, day: dt.date) -> dict[str, DataFrame]:
    """The rows a day adds to ``market``, ``user`` and ``state``.

    The state of the day before must be there, unless nothing at all happened before the day: a skipped day, or a history without
    ``bootstrap``, is an error. Days of the trailing average may be absent.
    """
    spark = events.sparkSession
    _require_state(events, root, day)
    today = (
        events.where(in_date_range(events, "ts", day, day)).groupBy("user_id").agg(*bar_values(), purchase_value())
    )
    before = _partition(spark, f"{root}/state", STATE_SCHEMA, [day - dt.timedelta(days=1)]).drop("date")
    window = [day - dt.timedelta(days=i) for i in range(1, AVERAGE_DAYS + 1)]
    trailing = (
        _partition(spark, f"{root}/market", BAR_SCHEMA, window)
        .groupBy("user_id")
        .agg(F.avg("volume").alias("avg_volume_30d"))
    )
    date = F.lit(day).alias("date")
    market = with_owner(
        today.join(trailing, "user_id", "left").select("user_id", date, "open_price", "close_price", "high_price", "low_price", "volume", "avg_volume_30d"),
        customers,
    )
    user = today.join(before, "user_id", "left").select(
        "user_id",
        "last_purchase_date",
        F.lit(day).alias("as_of_date"),
        F.coalesce(F.try_divide("purchase_days", "days"), F.lit(0.0)).alias("risk_tolerance"),
        "purchased_stock",
        date,
    )
    state = before.join(today.select("user_id", "purchased_stock"), "user_id", "full").select(
        "user_id",
        F.when(F.col("purchased_stock") == 1, F.lit(day)).otherwise(F.col("last_purchase_date")).alias("last_purchase_date"),
        (F.coalesce("days", F.lit(0)) + F.col("purchased_stock").isNotNull().cast("long")).alias("days"),
        (F.coalesce("purchase_days", F.lit(0)) + F.coalesce("purchased_stock", F.lit(0))).alias("purchase_days"),
        date,
    )
    return {"market": market, "user": user, "state": state}


def _require_state(events: DataFrame, root: str, day: dt.date) -> None:
    spark, path, before = events.sparkSession, f"{root}/state", day - dt.timedelta(days=1)
    if read_or_none(spark, f"{path}/date={before.isoformat()}", STATE_SCHEMA, path) is not None:
        return
    kept = read_or_none(spark, path, STATE_SCHEMA, path)
    if kept is not None and not kept.where(F.col("date") < F.lit(day)).isEmpty():
        raise ValueError(f"{path} has no state of {before}, but of earlier days: advance the missing days first")
    if not events.where(in_date_range(events, "ts", None, before)).isEmpty():
        raise ValueError(f"{path} has no state of {before}, but the log has earlier events: run bootstrap first")


def _partition(spark: SparkSession, path: str, schema: T.StructType, days: list[dt.date]) -> DataFrame:
    """The days' rows of a table by date; other days' folders are not listed."""
    wanted = f"{path}/date={{{','.join(d.isoformat() for d in days)}}}"
    found = read_or_none(spark, wanted, schema, path)
    return spark.createDataFrame([], schema) if found is None else found
