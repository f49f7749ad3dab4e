"""Scalar expressions shared by the batch, streaming and monitoring plans."""

from __future__ import annotations

import datetime as dt
from collections.abc import Sequence

from pyspark.sql import Column
from pyspark.sql import functions as F


def price_momentum() -> Column:
    """Relative move from open to close; null where the open is zero (ANSI mode would raise)."""
    return F.try_divide(F.col("close_price") - F.col("open_price"), F.col("open_price"))


def volume_ratio() -> Column:
    return F.try_divide(F.col("volume").cast("double"), F.col("avg_volume_30d").cast("double"))


def volatility() -> Column:
    """The day's absolute price range."""
    return F.col("high_price") - F.col("low_price")


def days_since_last_purchase() -> Column:
    """Whole days; null for a user who never bought."""
    return F.datediff(F.to_date("as_of_date"), F.to_date("last_purchase_date"))


def above(value: Column, bound: float) -> Column:
    """``value > bound``, false for NaN, which Spark would order above every number."""
    return (value > F.lit(bound)) & ~F.isnan(value)


def decide(probability: Column, threshold: float | Column) -> Column:
    """0/1 decision; NaN decides 0 and null stays null."""
    bound = threshold if isinstance(threshold, Column) else F.lit(threshold)
    return ((probability >= bound) & ~F.isnan(probability)).cast("int")


def share(part: Column, whole: Column) -> Column:
    """``part / whole``, and 0.0 over an empty whole."""
    return F.coalesce(F.try_divide(part.cast("double"), whole.cast("double")), F.lit(0.0))


def name_sql(column: str) -> str:
    return "`" + column.replace("`", "``") + "`"


def text_sql(value: str) -> str:
    return "'" + value.replace("\\", "\\\\").replace("'", "\\'") + "'"


def indicator_sql(column: str, value: str) -> str:
    """1 where the column equals the value, else 0, null included.

    As text: a wide projection is then handed to Spark in one call instead of hundreds.
    """
    return f"coalesce(CAST({name_sql(column)} = {text_sql(value)} AS INT), 0)"


def moment(at: dt.datetime) -> Column:
    """A constant timestamp, read as wall-clock time of the session's zone."""
    return F.lit(at.isoformat(" ")).cast("timestamp")


def in_test_share(keys: Sequence[str], test_size: float, seed: int) -> Column:
    """True for rows whose hashed key falls in the test share.

    Depends on the key's value alone, so neither the partitioning nor a task retry can move a row
    to the other side.
    """
    parts = [F.coalesce(F.col(k).cast("string"), F.lit("")) for k in keys]
    digest = F.md5(F.concat_ws(":", F.lit(str(seed)), *parts))
    bound = format(int(test_size * 16**8), "08x")
    return F.substring(digest, 1, 8) < F.lit(bound)
