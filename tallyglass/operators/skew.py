"""Equi-join that spreads hot keys over several tasks."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tallyglass.session import durable, kept


def hot_keys(df: DataFrame, keys: Sequence[str], share: float) -> DataFrame:
    """Candidates for keys holding more than ``share`` of the rows: at most ``1 / share`` of them.

    A frequent-item sketch over the key columns: one pass with bounded memory and no shuffle of
    rows. It may name keys that are not hot, which costs a few extra copies and changes no result.
    """
    key = df.select(F.struct(*keys).alias("key"))
    return key.freqItems(["key"], share).select(F.inline("key_freqItems"))


def salted_join(
    left: DataFrame, right: DataFrame, keys: Sequence[str], share: float = 0.01, salts: int | None = None
) -> DataFrame:
    """Inner equi-join with the same rows as ``left.join(right, keys)``.

    Left rows of a hot key are spread over ``salts`` sub-keys, and only that key's right rows are
    repeated, once per sub-key; by default over as many as there are shuffle partitions, so that the split grows
    with the cluster. The sub-key depends on the row's values and on its input partition,
    so exact copies spread too and a retried task repeats the same placement. The left side is kept in the checkpoint
    folder, since the sketch of its keys and the join both read it; without a hot key the join is the plain one.
    """
    spark = left.sparkSession
    left = durable(left)
    # At most 1 / share rows; the sketch may name others, so they are counted.
    named = kept(hot_keys(left, keys, share))
    counted = left.join(F.broadcast(named), list(keys)).groupBy(*keys).agg(F.count(F.lit(1)).alias("rows"))
    hot = kept(counted.where(F.col("rows") > share * left.count()).drop("rows"))
    if hot.isEmpty():
        return left.join(right, list(keys), "inner")
    hot = F.broadcast(hot.withColumn("is_hot", F.lit(True)))
    salts = salts or int(spark.conf.get("spark.sql.shuffle.partitions"))
    others = [F.col(c) for c in left.columns if c not in keys]
    spread = F.pmod(F.xxhash64(*others, F.spark_partition_id()), F.lit(salts)).cast("int")
    placed = left.withColumn("spread", spread).join(hot, list(keys), "left")
    salted_left = placed.withColumn(
        "salt", F.when(F.col("is_hot"), F.col("spread")).otherwise(F.lit(0))
    ).drop("spread", "is_hot")
    copies = F.when(F.col("is_hot"), F.sequence(F.lit(0), F.lit(salts - 1))).otherwise(F.array(F.lit(0)))
    salted_right = (
        right.join(hot, list(keys), "left").withColumn("salt", F.explode(copies)).drop("is_hot")
    )
    return salted_left.join(salted_right, [*keys, "salt"], "inner").drop("salt")
