"""Statistics kept by day, from which those of any window of days are merged without reading its rows again.

``daily_moments`` and ``daily_scores`` reduce the rows of the days they are given; written with ``save_days``, a day that is
computed again replaces its own state and no other. A day may stand for a longer period that begins with it.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from tallyglass.functions.expressions import name_sql, text_sql
from tallyglass.operators.curves import RankedScores, rank_counts
from tallyglass.sinks.tables import write_by_partition


def daily_moments(df: DataFrame, day: str, columns: Sequence[str]) -> DataFrame:
    """``day, feature, n, mean, m2, min, max``: a row per day and feature; ``m2`` is the sum of squared deviations. Rows without a day are left out."""

    def state(c: str) -> str:
        x = f"CAST({name_sql(c)} AS DOUBLE)"
        return (
            f"named_struct('feature', {text_sql(c)}, 'n', count({x}), 'mean', avg({x}), 'm2', var_pop({x}) * count({x}), "
            f"'min', min({x}), 'max', max({x}))"
        )

    dated = df.where(F.col(day).isNotNull())
    wide = dated.groupBy(F.col(day).cast("date").alias("day")).agg(*[F.expr(state(c)).alias(f"s{i}") for i, c in enumerate(columns)])
    return wide.select("day", F.inline(F.array(*[f"s{i}" for i in range(len(columns))])))


def merged_moments(states: DataFrame, columns: Sequence[str]) -> DataFrame:
    """What ``drift_stats`` gives for all rows behind the states: mean, sample standard deviation, minimum and maximum per feature.

    Days are merged by their distance from the common mean, so large values do not cancel out.
    """
    feature = Window.partitionBy("feature")
    whole = F.sum("n").over(feature)
    mean = F.try_divide(F.sum(F.col("n") * F.col("mean")).over(feature), whole)
    apart = F.col("m2") + F.col("n") * (F.col("mean") - F.col("whole_mean")) ** 2
    merged = (
        states.where(F.col("feature").isin(*columns))
        .withColumns({"whole": whole, "whole_mean": mean})
        .groupBy("feature")
        .agg(
            F.max("whole_mean").alias("mean"),
            F.when(F.max("whole") > 1, F.sqrt(F.sum(apart) / (F.max("whole") - 1))).alias("stddev"),
            F.min("min").alias("min"),
            F.max("max").alias("max"),
        )
    )
    # A feature of which no day has a value is a row as well.
    names = states.sparkSession.createDataFrame([(c,) for c in columns], "feature string")
    return names.join(merged, "feature", "left")


def daily_scores(df: DataFrame, day: str, score: str = "probability", label: str = "label") -> DataFrame:
    """``day, score, n, p``: rows and positives of each score of each day. Rows without a day, a score or a label are left out."""
    value = F.col(score).cast("double")
    ranked = df.where(F.col(day).isNotNull() & value.isNotNull() & ~F.isnan(value) & F.col(label).isNotNull())
    return ranked.groupBy(F.col(day).cast("date").alias("day"), value.alias("score")).agg(
        F.count(F.lit(1)).cast("double").alias("n"), F.sum(F.col(label).cast("double")).alias("p")
    )


def ranked_days(states: DataFrame, scores_per_range: int = 100_000) -> RankedScores:
    """The ranking of all rows behind the states, for ``roc_auc``, ``pr_curve`` and ``best_f1``."""
    return rank_counts(states.groupBy("score").agg(F.sum("n").alias("n"), F.sum("p").alias("p")), scores_per_range)


def save_days(states: DataFrame, root: str) -> None:
    """Put the states of the given days in place of those stored for them; few files a day."""
    write_by_partition(states.hint("rebalance", "day"), root, "day")


def between(states: DataFrame, first, last) -> DataFrame:
    """The states of a window of days; only their partitions are read."""
    day: Column = F.col("day")
    return states.where(day.between(F.lit(first), F.lit(last)))
