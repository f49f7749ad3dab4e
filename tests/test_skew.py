"""Hot keys: same rows, spread over tasks."""

from pyspark.sql import functions as F

from tallyglass.operators.features import join_market_user
from tallyglass.operators.skew import hot_keys, salted_join


def sides(spark):
    left = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, "hot").otherwise(F.concat(F.lit("u"), F.col("id") % 700)).alias("user_id"),
        F.lit("2024-01-01").alias("date"),
        F.lit(1.5).alias("price"),
    )
    right = left.select("user_id", "date").distinct().withColumn("label", F.length("user_id"))
    return left, right


def test_hot_key_is_found_and_list_is_bounded(spark):
    left, _ = sides(spark)
    found = [r.user_id for r in hot_keys(left, ["user_id", "date"], 0.05).collect()]
    assert "hot" in found and len(found) <= 20


def test_salted_join_equals_plain_join(spark):
    left, right = sides(spark)
    plain = left.join(right, ["user_id", "date"])
    salted = join_market_user(left, right, hot_share=0.05).select(plain.columns)
    assert salted.count() == 3000
    assert salted.exceptAll(plain).count() == 0 and plain.exceptAll(salted).count() == 0


def test_exact_copies_of_a_hot_key_spread(spark):
    left, right = sides(spark)
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    spark.conf.set("spark.sql.adaptive.coalescePartitions.enabled", "false")
    try:
        joined = salted_join(left.repartition(8, "price", F.rand(1)), right, ["user_id", "date"], 0.05)
        tasks = joined.where("user_id = 'hot'").select(F.spark_partition_id().alias("t")).distinct().count()
    finally:
        spark.conf.unset("spark.sql.autoBroadcastJoinThreshold")
        spark.conf.unset("spark.sql.adaptive.coalescePartitions.enabled")
    assert tasks > 1


def test_no_hot_key_means_the_plain_join(spark):
    left, right = sides(spark)
    even = left.where("user_id <> 'hot'")
    joined = salted_join(even, right, ["user_id", "date"], 0.05)
    assert joined.count() == 2000
    assert "salt" not in joined._jdf.queryExecution().executedPlan().toString()
