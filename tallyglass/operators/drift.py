"""Comparing numeric columns with a reference period."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyglass.functions.expressions import above, name_sql, text_sql


def drift_stats(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Mean, sample standard deviation, minimum and maximum: one row per column, one pass."""

    def stats(c: str) -> str:
        x = f"CAST({name_sql(c)} AS DOUBLE)"
        return (
            f"named_struct('feature', {text_sql(c)}, 'mean', avg({x}), 'stddev', stddev({x}), "
            f"'min', min({x}), 'max', max({x}))"
        )

    wide = df.selectExpr(*[f"{stats(c)} AS s{i}" for i, c in enumerate(columns)])
    return wide.select(F.inline(F.array(*wide.columns)))


def _relative(current: str, reference: str) -> Column:
    """Relative difference; infinite against a reference of zero, null where a side is missing."""
    cur, ref = F.col(current), F.col(reference)
    apart = F.abs(cur - ref)
    return F.when(apart.isNotNull() & (ref == 0), F.lit(float("inf"))).otherwise(
        F.try_divide(apart, F.abs(ref))
    )


def drift_report(current: DataFrame, reference: DataFrame, threshold: float = 0.1) -> DataFrame:
    """One row per feature from the statistics of both sides.

    Drift is a relative difference of mean or deviation strictly above the threshold. A feature
    that cannot be compared has a null flag.
    """
    now = current.select(
        "feature", F.col("mean").alias("current_mean"), F.col("stddev").alias("current_stddev")
    )
    then = reference.select(
        "feature", F.col("mean").alias("reference_mean"), F.col("stddev").alias("reference_stddev")
    )
    # One row per feature on either side, whatever the size of the data behind them.
    both = now.join(F.broadcast(then), "feature").withColumns(
        {
            "mean_diff_pct": _relative("current_mean", "reference_mean"),
            "stddev_diff_pct": _relative("current_stddev", "reference_stddev"),
        }
    )
    flag = above(F.col("mean_diff_pct"), threshold) | above(F.col("stddev_diff_pct"), threshold)
    return both.select(
        "feature",
        "current_mean",
        "reference_mean",
        "mean_diff_pct",
        "current_stddev",
        "reference_stddev",
        "stddev_diff_pct",
        flag.alias("drift_detected"),
    )


def any_drift(report: DataFrame) -> DataFrame:
    """One row; features without a flag do not count."""
    return report.agg(
        F.coalesce(F.bool_or("drift_detected"), F.lit(False)).alias("any_drift_detected")
    )
