"""States kept by day, against the statistics of the rows themselves."""

import datetime as dt

import pytest
from pyspark.sql import functions as F

from tallyglass.operators.by_day import between, daily_moments, daily_scores, merged_moments, ranked_days, save_days
from tallyglass.operators.curves import best_f1, pr_curve, rank_scores, roc_auc
from tallyglass.operators.drift import drift_stats
from tallyglass.session import scratch_path

COLUMNS = ["x", "large", "sparse", "none"]


@pytest.fixture(scope="module")
def rows(spark):
    """Twenty days; one has a single row, one feature has values on two days only, one never."""
    path = scratch_path(spark, "rows")
    day = F.when(F.col("id") == 0, F.lit(0)).otherwise(1 + F.col("id") % 19).cast("int")
    spark.range(4000).select(
        "id",
        F.date_add(F.lit(dt.date(2024, 1, 1)), day).alias("at"),
        (F.pmod(F.xxhash64("id"), F.lit(1000)) / 10).alias("x"),
        (1e9 + F.pmod(F.xxhash64("id", F.lit(1)), F.lit(100))).alias("large"),
        F.when(day.between(3, 4), F.col("id") % 5).alias("sparse"),
        F.lit(None).cast("double").alias("none"),
        (F.pmod(F.xxhash64("id", F.lit(2)), F.lit(50)) / 50).alias("probability"),
        F.when(F.col("id") % 17 != 0, (F.pmod(F.xxhash64("id", F.lit(2)), F.lit(50)) + F.col("id") % 40 > 45).cast("int")).alias("label"),
    ).write.parquet(path)
    return spark.read.parquet(path)


def window(rows, first, last):
    return rows.where(F.col("at").between(F.lit(first), F.lit(last)))


@pytest.mark.parametrize(("first", "last"), [(1, 31), (1, 1), (4, 5), (6, 12), (25, 31)])
def test_merged_moments_are_those_of_the_rows(spark, rows, first, last):
    first, last = dt.date(2024, 1, first), dt.date(2024, 1, last)
    states = daily_moments(rows, "at", COLUMNS)
    found = {r.feature: r for r in merged_moments(between(states, first, last), COLUMNS).collect()}
    for r in drift_stats(window(rows, first, last), COLUMNS).collect():
        for name in ("mean", "stddev", "min", "max"):
            want = r[name]
            assert found[r.feature][name] == (None if want is None else pytest.approx(want, rel=1e-9, abs=1e-9)), (r.feature, name)


def test_a_window_reads_its_states_only(spark, rows):
    root = scratch_path(spark, "moments")
    save_days(daily_moments(rows, "at", COLUMNS), root)
    wrong = daily_moments(rows.where("at = '2024-01-05'").withColumn("x", F.lit(0.0)), "at", COLUMNS)
    save_days(wrong, root)
    save_days(daily_moments(rows.where("at = '2024-01-05'"), "at", COLUMNS), root)
    states = between(spark.read.parquet(root), dt.date(2024, 1, 5), dt.date(2024, 1, 7))
    merged = merged_moments(states, COLUMNS)
    plan = merged._jdf.queryExecution().toString()
    assert root in plan and "PartitionFilters: [isnotnull(day" in plan and rows.inputFiles()[0].rsplit("/", 1)[0] not in plan
    want = drift_stats(window(rows, dt.date(2024, 1, 5), dt.date(2024, 1, 7)), ["x"]).first()
    assert merged.where("feature = 'x'").first()["stddev"] == pytest.approx(want["stddev"])


@pytest.mark.parametrize(("first", "last"), [(1, 31), (7, 9), (25, 31)])
def test_curves_of_a_window_are_those_of_the_rows(spark, rows, first, last):
    first, last = dt.date(2024, 1, first), dt.date(2024, 1, last)
    root = scratch_path(spark, "scores")
    save_days(daily_scores(rows, "at"), root)
    merged = ranked_days(between(spark.read.parquet(root), first, last), scores_per_range=7)
    whole = rank_scores(window(rows, first, last))
    assert (merged.positives, merged.negatives) == (whole.positives, whole.negatives)
    found, want = roc_auc(merged).first().auc, roc_auc(whole).first().auc
    assert found == (None if want is None else pytest.approx(want))
    assert pr_curve(merged).exceptAll(pr_curve(whole)).count() == 0
    assert best_f1(pr_curve(merged)).collect() == best_f1(pr_curve(whole)).collect()
