"""Comparing predictions with actual outcomes."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyglass.functions.expressions import share


def match_counts(
    predictions: DataFrame,
    actuals: DataFrame,
    on: Sequence[str] = ("user_id",),
    prediction: str = "prediction",
    actual: str = "purchased_stock",
) -> DataFrame:
    """The inner join of predictions and actuals, as counts of equal pairs.

    Joining on the user alone pairs every prediction of a user with every actual of that user.
    Those pairs are only ever counted, so each side is first reduced to one row per key and value,
    and a pair's multiplicity is the product of the two counts. A user with a third of all rows
    then joins a handful of rows instead of the square of that third.
    """
    made = predictions.groupBy(*on, prediction).agg(F.count(F.lit(1)).alias("made"))
    seen = actuals.groupBy(*on, actual).agg(F.count(F.lit(1)).alias("seen"))
    # Products of counts may pass 2^63; decimals stay exact.
    pairs = F.col("made").cast("decimal(19,0)") * F.col("seen").cast("decimal(19,0)")
    return made.join(seen, list(on), "inner").select(*on, prediction, actual, pairs.alias("pairs"))


def confusion_counts(
    df: DataFrame,
    prediction: str = "prediction",
    actual: str = "purchased_stock",
    weight: str | None = None,
) -> DataFrame:
    """One row: compared rows, correct ones and the four cells, each 0 over no rows.

    Predictions or actuals other than 0 and 1 count in no cell; a null on either side is not
    compared at all.
    """
    made, seen = F.col(prediction), F.col(actual)
    unit = F.lit(1) if weight is None else F.col(weight)

    def total(condition: Column) -> Column:
        return F.coalesce(F.sum(F.when(condition, unit)), F.lit(0)).cast("double")

    return df.agg(
        total(made.isNotNull() & seen.isNotNull()).alias("total"),
        total(made == seen).alias("correct"),
        total((made == 1) & (seen == 1)).alias("tp"),
        total((made == 1) & (seen == 0)).alias("fp"),
        total((made == 0) & (seen == 1)).alias("fn"),
        total((made == 0) & (seen == 0)).alias("tn"),
    )


def classification_metrics(counts: DataFrame) -> DataFrame:
    """Accuracy, precision, recall, F1 and rates of a confusion row; 0.0 over a zero denominator."""
    tp, fp, fn, tn = (F.col(c) for c in ("tp", "fp", "fn", "tn"))
    recall = share(tp, tp + fn)
    return counts.select(
        F.col("total").alias("total_predictions"),
        share(F.col("correct"), F.col("total")).alias("accuracy"),
        share(tp, tp + fp).alias("precision"),
        recall.alias("recall"),
        share(2 * tp, 2 * tp + fp + fn).alias("f1_score"),
        recall.alias("true_positive_rate"),
        share(fp, fp + tn).alias("false_positive_rate"),
    )
