"""One-hot encoding, schema alignment and null filling."""

from __future__ import annotations

import math
from collections import Counter
from collections.abc import Sequence
from itertools import accumulate

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from tallyglass.functions.expressions import indicator_sql, name_sql
from tallyglass.session import durable


def distinct_categories(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """Distinct non-null values of every column, in long form, from one pass over the data.

    A grouping set per column: in its rows the other columns are null. Whole numbers are grouped as they are and become text
    once they are distinct.
    """
    named = {f"__value_{i}": c for i, c in enumerate(dict.fromkeys(columns))}
    values = df.select(*[F.col(c).alias(v) if _is_whole(df, F.col(c)) else F.col(c).cast("string").alias(v) for v, c in named.items()])
    found = values.groupingSets([[v] for v in named], *named).agg(F.grouping_id().alias("set"))
    column = F.coalesce(*[F.when(F.col(v).isNotNull(), F.lit(c)) for v, c in named.items()])
    category = F.coalesce(*[F.col(v).cast("string") for v in named])
    return found.select(column.alias("column"), category.alias("category")).where(F.col("category").isNotNull())


def _is_whole(df: DataFrame, column: Column) -> bool:
    """Whether the values are whole numbers: each has one text, and no other value has it."""
    return isinstance(df.select(column).schema[0].dataType, T.IntegralType)


def category_index(categories: DataFrame, per_range: int = 100_000) -> DataFrame:
    """``index, column, category``: learned categories numbered from 0 in their order, the same on every run.

    Categories are dealt into ranges of about ``per_range``; a range is numbered on its own, from the sizes of those below,
    which are all that the driver sees.
    """
    known = durable(categories.select("column", "category"))
    ranges = max(2, math.ceil(known.count() / per_range))
    dealt = durable(known.repartitionByRange(ranges, "column", "category").withColumn("range", F.spark_partition_id()))
    sizes = sorted(tuple(r) for r in dealt.groupBy("range").count().collect())
    firsts = list(zip([part for part, _ in sizes], accumulate([n for _, n in sizes], initial=0)))
    offsets = categories.sparkSession.createDataFrame(firsts, "range int, first long")
    place = F.row_number().over(Window.partitionBy("range").orderBy("column", "category")) - 1
    return dealt.withColumn("place", place).join(F.broadcast(offsets), "range").select(
        (F.col("first") + F.col("place")).alias("index"), "column", "category"
    )


def with_category_indices(df: DataFrame, columns: Sequence[str], index: DataFrame, into: str) -> DataFrame:
    """Rows with a sparse one-hot vector: the indices of their categories, as an array.

    ``index`` should be a stored table. It is joined once per column, by value: broadcast where Spark's size check allows, else both sides are
    shuffled and adaptive execution splits a frequent value. Whole numbers are joined as such, which sorts faster than text; a
    category that is not the text of one (``07``) is unknown to them. Nulls and unknown values set nothing.
    """
    found = []
    for i, column in enumerate(columns):
        found.append(f"__index_{i}")
        value, category = F.col(name_sql(column)), F.col("category")
        own = index.where(F.col("column") == column)
        if _is_whole(df, value):
            number = category.try_cast(df.select(value).schema[0].dataType)
            own, category = own.where(number.cast("string") == category), number
        else:
            value = value.cast("string")
        own = own.select(category.alias(f"__category_{i}"), F.col("index").alias(found[-1]))
        df = df.join(own, value == F.col(f"__category_{i}"), "left").drop(f"__category_{i}")
    # Not array_compact, whose lambda Spark does not compile.
    none = F.array().cast(T.ArrayType(index.schema["index"].dataType))
    return df.withColumn(into, F.concat(*[F.when(F.col(f).isNotNull(), F.array(f)).otherwise(none) for f in found])).drop(*found)


def encode_learned(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], categories: DataFrame | None = None
) -> DataFrame:
    """One-hot encoding with learned categories: the keys and ``feature``, one row per set indicator.

    ``categories(column, category)``, as ``distinct_categories`` learns them from training rows, says which are known; values
    outside it and nulls set nothing. Without it the rows' own values are the categories. However many there are, nothing is collected and no column is
    added; Spark broadcasts the table if its size allows.
    """
    value = "__value"
    long = df.select(
        *keys, F.explode(F.array(*[F.struct(F.lit(c).alias("column"), F.col(c).cast("string").alias("category")) for c in columns])).alias(value)
    ).select(*keys, f"{value}.column", f"{value}.category")
    long = long.where(F.col("category").isNotNull())
    if categories is not None:
        long = long.join(categories, ["column", "category"], "left_semi")
    return long.select(*keys, F.concat_ws("_", "column", "category").alias("feature"))


def one_hot(df: DataFrame, vocabulary: dict[str, Sequence[str]]) -> DataFrame:
    """One 0/1 column ``{column}_{value}`` per entry of a given vocabulary, added in a single projection.

    A null or a value outside the vocabulary gives zeros. Entries whose column names Spark cannot tell
    apart, as it ignores case in names, are an error; ``encode_learned`` has no such limit.
    """
    encoded = {f"{c}_{v}": indicator_sql(c, v) for c, values in vocabulary.items() for v in values}
    same = [n for n, k in Counter(name.lower() for name in encoded).items() if k > 1]
    if same:
        raise ValueError(f"categories that differ in case only: {', '.join(sorted(same))}")
    kept = [name_sql(c) for c in df.columns if c not in encoded]
    return df.selectExpr(*kept, *[f"{x} AS {name_sql(n)}" for n, x in encoded.items()])


def align(df: DataFrame, features: Sequence[str], keep: Sequence[str] = ()) -> DataFrame:
    """``keep`` and then the features in the given order; a missing feature is zero."""
    present = set(df.columns)
    return df.selectExpr(
        *map(name_sql, keep),
        *[name_sql(c) if c in present else f"0 AS {name_sql(c)}" for c in features],
    )


def fill_missing(df: DataFrame, columns: Sequence[str], value: float = 0.0) -> DataFrame:
    """Replace nulls (and NaN) in the feature columns; labels are never filled."""
    return df.na.fill(value, subset=list(columns))


def with_label(df: DataFrame, label: str) -> DataFrame:
    """Rows that can be trained on: those with a label."""
    return df.where(F.col(label).isNotNull())


def feature_matrix(
    df: DataFrame, features: Sequence[str], label: str, keep: Sequence[str] = (), fill: float = 0.0
) -> DataFrame:
    """Keys, features in order with nulls filled, and the label of labelled rows."""
    rows = with_label(df, label)
    return align(rows, [*features, label], keep).transform(fill_missing, features, fill)
