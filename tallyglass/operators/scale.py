"""Standard scaling with statistics from the training rows."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tallyglass.functions.expressions import name_sql


@dataclass(frozen=True)
class Scaler:
    """Population mean and standard deviation per column."""

    mean: dict[str, float]
    std: dict[str, float]

    def expression(self, column: str) -> Column:
        return (F.col(column) - F.lit(self.mean[column])) / F.lit(self.std[column])

    def sql(self, column: str, fill: float) -> str:
        """The same as SQL text, after filling, for a saved pipeline."""
        value = filled_sql(column, fill)
        if column not in self.mean:
            return value
        return f"({value} - ({self.mean[column]!r}D)) / {self.std[column]!r}D"


def filled_sql(column: str, fill: float) -> str:
    return f"coalesce(nanvl(CAST({name_sql(column)} AS DOUBLE), {fill!r}D), {fill!r}D)"


def fit_scaler(df: DataFrame, columns: Sequence[str], fill: float | None = None) -> Scaler:
    """One aggregate over all columns; two numbers per column come back.

    A constant or empty column keeps scale 1.
    """

    def value(c: str) -> str:
        return f"CAST({name_sql(c)} AS DOUBLE)" if fill is None else filled_sql(c, float(fill))

    if not columns:
        return Scaler({}, {})
    row = df.selectExpr(
        *[f"avg({value(c)}) AS mean_{i}" for i, c in enumerate(columns)],
        *[f"stddev_pop({value(c)}) AS std_{i}" for i, c in enumerate(columns)],
    ).first()
    return Scaler(
        mean={c: row[f"mean_{i}"] or 0.0 for i, c in enumerate(columns)},
        std={c: row[f"std_{i}"] or 1.0 for i, c in enumerate(columns)},
    )


def scale(df: DataFrame, scaler: Scaler) -> DataFrame:
    return df.withColumns({c: scaler.expression(c) for c in scaler.mean})
