"""Exact ROC AUC, precision-recall curve and best F1 threshold over any number of scores.

All three need, for every distinct score, how many rows lie below it. Rows are first counted per
score (partial aggregation, so a score shared by a third of the rows is one row per map task),
the counts are materialised once, and the running totals are taken in score ranges: each range
sums up on its own and starts from the totals of the ranges below. A range holds about
``scores_per_range`` distinct scores, or ``1 / MAX_RANGES`` of them where there are more; the bounds
of the ranges are all that the driver sees.
"""

from __future__ import annotations

import math
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame, Observation, Window
from pyspark.sql import functions as F

from tallyglass.session import durable

# Fixed value: keeps the quotient defined where precision and recall are both zero.
F1_EPSILON = 1e-8
# Ranges whose totals are summed up together.
RANGES_PER_GROUP = 1000


@dataclass(frozen=True)
class RankedScores:
    """Per distinct score: rows, positives and the totals strictly below."""

    rows: DataFrame
    positives: float
    negatives: float


def rank_scores(
    df: DataFrame, score: str = "probability", label: str = "label", scores_per_range: int = 100_000
) -> RankedScores:
    """Rows without a score or a label cannot be ranked and are left out."""
    value = F.col(score).cast("double")
    ranked = df.where(value.isNotNull() & ~F.isnan(value) & F.col(label).isNotNull())
    counts = ranked.groupBy(value.alias("score")).agg(
        F.count(F.lit(1)).cast("double").alias("n"),
        F.sum(F.col(label).cast("double")).alias("p"),
    )
    return rank_counts(counts, scores_per_range)


def rank_counts(counts: DataFrame, scores_per_range: int = 100_000) -> RankedScores:
    """The ranking of ``score, n, p``: each distinct score, its rows and its positives."""
    seen = Observation()
    counts = durable(
        counts.observe(
            seen,
            F.count(F.lit(1)).alias("scores"),
            F.sum("p").alias("positives"),
            F.sum(F.col("n") - F.col("p")).alias("negatives"),
        )
    )
    size = seen.get
    # Two ranges at least, so that every size takes the same way.
    ranges = max(2, math.ceil(size["scores"] / scores_per_range))
    dealt = durable(counts.repartitionByRange(ranges, "score").withColumn("range", F.spark_partition_id()))
    return RankedScores(_running_totals(dealt), size["positives"] or 0.0, size["negatives"] or 0.0)


def _before(column: str, by: str, *order: str) -> Column:
    """The sum over the rows before this one, within ``by``."""
    window = Window.partitionBy(by).orderBy(*order).rowsBetween(Window.unboundedPreceding, -1)
    return F.coalesce(F.sum(column).over(window), F.lit(0.0))


def _running_totals(dealt: DataFrame) -> DataFrame:
    """``dealt``: score, n, p and the range of the score; ranges ascend with the score."""
    rows = dealt.withColumn("q", F.col("n") - F.col("p"))
    totals = (
        rows.groupBy("range")
        .agg(F.sum("p").alias("p"), F.sum("q").alias("q"))
        .withColumn("group", F.floor(F.col("range") / RANGES_PER_GROUP))
    )
    groups = (
        totals.groupBy("group")
        .agg(F.sum("p").alias("p"), F.sum("q").alias("q"))
        .withColumn("all", F.lit(0))
        .select("group", _before("p", "all", "group").alias("p_groups"), _before("q", "all", "group").alias("q_groups"))
    )
    offsets = totals.join(groups, "group").select(
        "range",
        (F.col("p_groups") + _before("p", "group", "range")).alias("p_before"),
        (F.col("q_groups") + _before("q", "group", "range")).alias("q_before"),
    )
    within = rows.select(
        "range", "score", "n", "p", _before("p", "range", "score").alias("p_in"), _before("q", "range", "score").alias("q_in")
    )
    return within.join(offsets, "range").select(
        "score",
        "n",
        "p",
        (F.col("p_in") + F.col("p_before")).alias("p_below"),
        (F.col("q_in") + F.col("q_before")).alias("n_below"),
    )


def roc_auc(ranked: RankedScores) -> DataFrame:
    """One row. Ties count half; null if one class is absent."""
    won = F.sum(F.col("p") * F.col("n_below") + 0.5 * F.col("p") * (F.col("n") - F.col("p")))
    return ranked.rows.agg(
        F.try_divide(won, F.lit(ranked.positives) * F.lit(ranked.negatives)).alias("auc")
    )


def roc_auc_by(df: DataFrame, group: str, score: str = "probability", label: str = "label", scores_per_range: int = 100_000) -> DataFrame:
    """``auc`` of every value of ``group``, all of them from one ranking: scores are counted, dealt and summed up by group and score.

    Null for a group in which one class is absent. Rows without a group, a score or a label are left out.
    """
    value = F.col(score).cast("double")
    ranked = df.where(F.col(group).isNotNull() & value.isNotNull() & ~F.isnan(value) & F.col(label).isNotNull())
    p = F.col(label).cast("double")
    seen = Observation()
    counts = durable(
        ranked.groupBy(F.col(group), value.alias("score"))
        .agg(F.sum(p).alias("p"), F.sum(1 - p).alias("q"))
        .observe(seen, F.count(F.lit(1)).alias("scores"))
    )
    ranges = max(2, math.ceil(seen.get["scores"] / scores_per_range))
    dealt = durable(counts.repartitionByRange(ranges, group, "score").withColumn("range", F.spark_partition_id()))
    whole = Window.partitionBy(group)
    # One row per range, and one more per group.
    ranges_below = (
        dealt.groupBy(group, "range")
        .agg(F.sum("p").alias("p"), F.sum("q").alias("q"))
        .select(
            group, "range", _before("q", group, "range").alias("q_before"),
            F.sum("p").over(whole).alias("positives"), F.sum("q").over(whole).alias("negatives"),
        )
    )
    within = Window.partitionBy(group, "range").orderBy("score").rowsBetween(Window.unboundedPreceding, -1)
    below = F.coalesce(F.sum("q").over(within), F.lit(0.0))
    won = F.sum(F.col("p") * (F.col("q_in") + F.col("q_before") + 0.5 * F.col("q")))
    return (
        dealt.withColumn("q_in", below)
        .join(ranges_below, [group, "range"])
        .groupBy(group)
        .agg(F.try_divide(won, F.max("positives") * F.max("negatives")).alias("auc"))
    )


def pr_curve(ranked: RankedScores) -> DataFrame:
    """One row per distinct score used as threshold (``score >= threshold`` is positive)."""
    tp = F.lit(ranked.positives) - F.col("p_below")
    fp = F.lit(ranked.negatives) - F.col("n_below")
    # Without any positive row recall is 1 at every threshold.
    recall = tp / F.lit(ranked.positives) if ranked.positives > 0 else F.lit(1.0)
    return ranked.rows.select(
        F.col("score").alias("threshold"),
        tp.alias("tp"),
        fp.alias("fp"),
        F.try_divide(tp, tp + fp).alias("precision"),
        recall.alias("recall"),
    )


def best_f1(curve: DataFrame) -> DataFrame:
    """One row: the highest F1 and its threshold, the lowest of equals."""
    p, r = F.col("precision"), F.col("recall")
    f1 = 2 * r * p / (r + p + F.lit(F1_EPSILON))
    return (
        curve.select("threshold", f1.alias("best_f1"))
        .orderBy(F.desc("best_f1"), F.asc("threshold"))
        .limit(1)
        .select("best_f1", F.col("threshold").alias("best_threshold"))
    )
