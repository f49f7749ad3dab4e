"""Market and user tables derived from a raw event log and a customer table.

Grain of both: one row per user and day. The log is aggregated to that grain first, with map-side
partial aggregation, so however many events a hot user has, only one row per user and day (and
map task) is shuffled, and the per-user windows below see at most one row per day.
"""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyglass.config import WEEKDAYS
from tallyglass.sources.tables import in_date_range

AVERAGE_DAYS = 30

# Market segment of the customer table -> sector of a scoring request.
SEGMENT_SECTOR = {
    "AUTOMOBILE": "Consumer",
    "BUILDING": "RealEstate",
    "FURNITURE": "Materials",
    "HOUSEHOLD": "Utilities",
    "MACHINERY": "Technology",
}
DAY_NAMES = (*WEEKDAYS, "Saturday", "Sunday")
# Account balance from which a customer counts as large or mid.
LARGE_FROM, MID_FROM = 6000.0, 2000.0


def bar_values() -> list[Column]:
    return [
        F.min_by("value", "event_id").alias("open_price"),
        F.max_by("value", "event_id").alias("close_price"),
        F.max("value").alias("high_price"),
        F.min("value").alias("low_price"),
        F.count("*").alias("volume"),
    ]


def purchase_value() -> Column:
    return F.max((F.col("event_type") == "purchase").cast("int")).alias("purchased_stock")


def daily_bars(events: DataFrame, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Open, close, high, low and volume per user and day, with the trailing average volume.

    A date range is turned into a range on the log's own timestamp, widened by the averaging
    window, so that only the needed part of the log is scanned.
    """
    if start and end:
        events = events.where(in_date_range(events, "ts", start - dt.timedelta(AVERAGE_DAYS), end))
    days = (
        events.select("user_id", F.to_date("ts").alias("date"), "event_id", "value")
        .groupBy("user_id", "date")
        .agg(*bar_values())
    )
    trailing = (
        Window.partitionBy("user_id")
        .orderBy(F.unix_date("date"))
        .rangeBetween(-AVERAGE_DAYS, -1)
    )
    days = days.withColumn("avg_volume_30d", F.avg("volume").over(trailing))
    if start and end:
        days = days.where(F.col("date").between(F.lit(start), F.lit(end)))
    return days


def daily_market(
    events: DataFrame,
    customers: DataFrame,
    start: dt.date | None = None,
    end: dt.date | None = None,
) -> DataFrame:
    """Daily bars with the attributes of the traded stock, in the market schema."""
    return with_owner(daily_bars(events, start, end), customers)


def with_owner(bars: DataFrame, customers: DataFrame) -> DataFrame:
    # Joined after the bars' window, whose partitioning by user the join can reuse.
    owner = customers.select(
        F.col("c_custkey").alias("user_id"), "c_mktsegment", "c_acctbal", "c_nationkey"
    )
    sector = F.coalesce(
        *[F.when(F.col("c_mktsegment") == k, F.lit(v)) for k, v in SEGMENT_SECTOR.items()],
        F.lit("Other"),
    )
    cap = (
        F.when(F.col("c_acctbal") >= LARGE_FROM, "Large")
        .when(F.col("c_acctbal") >= MID_FROM, "Mid")
        .otherwise("Small")
    )
    return bars.join(owner, "user_id", "left").select(
        "user_id",
        "date",
        F.concat(F.lit("S"), F.col("c_nationkey").cast("string")).alias("stock_id"),
        "open_price",
        "close_price",
        "high_price",
        "low_price",
        "volume",
        "avg_volume_30d",
        sector.alias("sector"),
        cap.alias("market_cap_category"),
        # Picked from a constant list; formatting every date costs several times as much.
        F.element_at(F.array(*map(F.lit, DAY_NAMES)), F.weekday("date") + 1).alias("day_of_week"),
    )


def daily_user(events: DataFrame, start: dt.date | None = None, end: dt.date | None = None) -> DataFrame:
    """Purchase label, last earlier purchase and earlier purchase rate per user and day.

    The history is unbounded, so of a date range only the end can be pushed to the scan; a daily job
    takes ``stored_days.advance`` instead, which keeps the history as a state per user.
    """
    if end:
        events = events.where(in_date_range(events, "ts", None, end))
    days = (
        events.select("user_id", F.to_date("ts").alias("date"), "event_type")
        .groupBy("user_id", "date")
        .agg(purchase_value())
    )
    before = (
        Window.partitionBy("user_id").orderBy("date").rowsBetween(Window.unboundedPreceding, -1)
    )
    days = days.select(
        "user_id",
        "date",
        F.max(F.when(F.col("purchased_stock") == 1, F.col("date"))).over(before).alias("last_purchase_date"),
        F.col("date").alias("as_of_date"),
        F.coalesce(F.avg("purchased_stock").over(before), F.lit(0.0)).alias("risk_tolerance"),
        "purchased_stock",
    )
    if start:
        days = days.where(F.col("date") >= F.lit(start))
    return days
