"""Confusion counts, metrics, curves and drift against brute force."""

import math

import numpy as np
import pytest
from hypothesis import HealthCheck, given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F

from tallyglass.operators.curves import best_f1, pr_curve, rank_scores, roc_auc
from tallyglass.operators.drift import any_drift, drift_report, drift_stats
from tallyglass.operators.quality import classification_metrics, confusion_counts, match_counts

FEW = settings(max_examples=8, deadline=None, suppress_health_check=[HealthCheck.function_scoped_fixture])
PAIRS = "prediction int, purchased_stock double"


def test_cells_add_up_on_clean_rows(spark):
    df = spark.createDataFrame([(1, 1.0), (1, 0.0), (0, 1.0), (0, 0.0), (0, 0.0)], PAIRS)
    row = confusion_counts(df).first()
    assert (row.tp, row.fp, row.fn, row.tn, row.total, row.correct) == (1, 1, 1, 2, 5, 3)


def test_odd_values_fall_in_no_cell(spark):
    df = spark.createDataFrame([(1, None), (None, 1.0), (2, 2.0), (0, 0.0)], PAIRS)
    row = confusion_counts(df).first()
    assert (row.tp, row.fp, row.fn, row.tn) == (0, 0, 0, 1)
    assert (row.total, row.correct) == (2, 2)


def test_empty_and_one_sided_input_give_zeros(spark):
    empty = classification_metrics(confusion_counts(spark.createDataFrame([], PAIRS))).first()
    assert set(empty.asDict().values()) == {0.0}
    negative = spark.createDataFrame([(0, 1.0), (0, 0.0)], PAIRS)
    row = classification_metrics(confusion_counts(negative)).first()
    assert (row.precision, row.recall, row.accuracy) == (0.0, 0.0, 0.5)


@pytest.mark.parametrize("on", [("user_id",), ("user_id", "date")])
def test_match_counts_equal_the_plain_join_with_a_hot_user(spark, on):
    rows = spark.range(600).select(
        F.when(F.col("id") % 3 == 0, 0).otherwise(F.col("id") % 40).alias("user_id"),
        (F.col("id") % 5).alias("date"),
        (F.col("id") % 7 % 2).cast("int").alias("prediction"),
        F.when(F.col("id") % 11 != 0, (F.col("id") % 2).cast("double")).alias("purchased_stock"),
    )
    predictions = rows.select("user_id", "date", "prediction")
    actuals = rows.select("user_id", "date", "purchased_stock")
    keep = [c for c in ("user_id", "date") if c in on]
    joined = predictions.select(*keep, "prediction").join(actuals.select(*keep, "purchased_stock"), list(on))
    counted = confusion_counts(match_counts(predictions, actuals, on), weight="pairs").first()
    assert counted == confusion_counts(joined).first()


def test_pair_counts_beyond_bigint(spark):
    side = spark.createDataFrame([("u", 1, 4 * 10**9 * 10**9)], "user_id string, value int, n long")
    pairs = side.select(
        F.col("value").alias("prediction"),
        F.lit(1.0).alias("purchased_stock"),
        (F.col("n").cast("decimal(19,0)") * F.col("n").cast("decimal(19,0)")).alias("pairs"),
    )
    assert confusion_counts(pairs, weight="pairs").first().tp == 1.6e37


def brute_auc(scores, labels):
    positive = [s for s, y in zip(scores, labels) if y]
    negative = [s for s, y in zip(scores, labels) if not y]
    won = sum((p > n) + 0.5 * (p == n) for p in positive for n in negative)
    return won / (len(positive) * len(negative))


def scored(spark, scores, labels):
    rows = [(float(s), float(y)) for s, y in zip(scores, labels)]
    return spark.createDataFrame(rows, "probability double, label double")


@FEW
@given(st.lists(st.tuples(st.integers(0, 12), st.booleans()), min_size=4, max_size=60))
def test_curves_equal_brute_force(spark, rows):
    rows = [*rows, (3, True), (4, False)]
    scores, labels = zip(*rows)
    df = scored(spark, scores, labels)
    for per_range in (1_000_000, 3):
        ranked = rank_scores(df, scores_per_range=per_range)
        assert roc_auc(ranked).first().auc == pytest.approx(brute_auc(scores, labels), abs=1e-12)
        curve = pr_curve(ranked)
        points = {r.threshold: (r.precision, r.recall) for r in curve.collect()}
        assert sorted(points) == sorted({float(s) for s in scores})
        f1 = {}
        for t, (precision, recall) in points.items():
            chosen = [y for s, y in rows if s >= t]
            assert precision == pytest.approx(sum(chosen) / len(chosen))
            assert recall == pytest.approx(sum(chosen) / sum(labels))
            f1[t] = 2 * recall * precision / (recall + precision + 1e-8)
        best = best_f1(curve).first()
        assert best.best_f1 == pytest.approx(max(f1.values()))
        assert best.best_threshold == min(t for t in f1 if f1[t] == pytest.approx(max(f1.values()), abs=1e-13))


def test_auc_over_many_ranges_and_a_hot_score(spark):
    rng = np.random.default_rng(0)
    scores = np.where(rng.random(4000) < 0.34, 0.5, rng.random(4000))
    labels = rng.random(4000) < scores
    df = scored(spark, scores, labels)
    one = roc_auc(rank_scores(df)).first().auc
    many = roc_auc(rank_scores(df, scores_per_range=100)).first().auc
    assert many == pytest.approx(one, abs=1e-12)
    monotone = df.withColumn("probability", F.exp("probability") * 3)
    assert roc_auc(rank_scores(monotone)).first().auc == pytest.approx(one, abs=1e-12)


def test_single_class_and_unusable_rows(spark):
    df = spark.createDataFrame(
        [(0.1, 0.0), (0.7, 0.0), (float("nan"), 1.0), (None, 1.0), (0.3, None)], "probability double, label double"
    )
    ranked = rank_scores(df)
    assert roc_auc(ranked).first().auc is None
    assert [r.recall for r in pr_curve(ranked).collect()] == [1.0, 1.0]
    assert best_f1(pr_curve(ranked)).first().best_threshold == 0.1
    assert best_f1(pr_curve(rank_scores(df.where("false")))).count() == 0


def test_drift_flags(spark):
    then = spark.createDataFrame([(1.0, 0.0, 5.0), (3.0, 0.0, 5.0)], "a double, z double, k double")
    now = spark.createDataFrame([(1.0, 0.0, 6.0), (3.0, 0.0, 6.0)], "a double, z double, k double")
    report = drift_report(drift_stats(now, ["a", "z", "k"]), drift_stats(then, ["a", "z", "k"]))
    rows = {r.feature: r for r in report.collect()}
    assert rows["a"].drift_detected is False and rows["a"].mean_diff_pct == 0.0
    assert rows["z"].mean_diff_pct == math.inf and rows["z"].drift_detected is True
    assert rows["k"].mean_diff_pct == pytest.approx(0.2) and rows["k"].stddev_diff_pct == math.inf
    assert any_drift(report).first()[0] is True


def test_threshold_is_strict(spark):
    then = spark.createDataFrame([(8.0,), (8.0,), (4.0,), (12.0,)], "a double")
    now = then.select((F.col("a") + 2).alias("a"))
    stats = [drift_stats(df, ["a"]) for df in (now, then)]
    assert drift_report(*stats, 0.25).first().drift_detected is False
    assert drift_report(*stats, 0.24).first().drift_detected is True


def test_empty_side_gives_null_and_nan_no_flag(spark):
    then = spark.createDataFrame([(1.0,), (2.0,)], "a double")
    empty = drift_report(drift_stats(then.where("false"), ["a"]), drift_stats(then, ["a"]))
    row = empty.first()
    assert row.mean_diff_pct is None and row.drift_detected is None
    assert any_drift(empty).first()[0] is False
    broken = then.union(spark.createDataFrame([(float("nan"),)], "a double"))
    nan = drift_report(drift_stats(broken, ["a"]), drift_stats(then, ["a"])).first()
    assert nan.drift_detected is False
