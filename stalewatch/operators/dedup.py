"""Deterministic de-duplication."""

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def first_per_key(df: DataFrame, keys: Sequence[str | Column], order: Sequence[Column]) -> DataFrame:
    """The first row of every key in the given order.

    Spark keeps only the best row per key and task before the shuffle (WindowGroupLimit), so one
    key that holds most of the rows does not load a single task.
    """
    rank = F.row_number().over(Window.partitionBy(*keys).orderBy(*order))
    return df.withColumn("__rank", rank).filter(F.col("__rank") == 1).drop("__rank")


def ascending(*columns: str) -> list[Column]:
    return [F.col(c).asc_nulls_last() for c in columns]


def one_row_per_key(df: DataFrame, keys: Sequence[str]) -> DataFrame:
    """Keyed de-duplication; the survivor is the smallest row over all other columns."""
    return first_per_key(df, keys, ascending(*[c for c in df.columns if c not in keys] or keys))


def distinct_rows(df: DataFrame) -> DataFrame:
    """Full-row distinct."""
    return df.dropDuplicates()
