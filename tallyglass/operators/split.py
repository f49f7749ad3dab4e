"""Repeatable split into training and test rows."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame

from tallyglass.functions.expressions import in_test_share


def train_test_split(
    df: DataFrame, keys: Sequence[str], test_size: float = 0.2, seed: int = 42
) -> tuple[DataFrame, DataFrame]:
    """Two filters on a hash of the row key: disjoint, complete and without a shuffle."""
    test = in_test_share(keys, test_size, seed)
    return df.where(~test), df.where(test)
