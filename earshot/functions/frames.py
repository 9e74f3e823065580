"""Small DataFrame building blocks shared by the operators."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from earshot.functions.columns import asc


def file_order(df: DataFrame) -> list[str]:
    """Columns that give the order in which rows stood in the export."""
    return [name for name in ("time", "event_id") if name in df.columns]


def first_per_key(
    df: DataFrame, keys: Sequence[str], order_by: Sequence[str] | None = None
) -> DataFrame:
    """The first row of every key, with all its columns.

    Rows that `order_by` leaves equal are ordered by their remaining columns, so the
    result does not depend on the partitioning. A rank of 1 lets every task drop all
    but its own first row per key before the shuffle, so a key with a third of the
    rows sends one row per task.
    """
    order = list(file_order(df) if order_by is None else order_by)
    rest = [name for name in df.columns if name not in order and name not in keys]
    window = Window.partitionBy(*keys).orderBy(*[asc(name) for name in order + rest])
    position = F.row_number().over(window)
    return df.withColumn("_position", position).filter("_position = 1").drop("_position")


def top_n(df: DataFrame, n: int, *order: Column) -> DataFrame:
    """The first `n` rows: every task keeps `n`, one task merges them."""
    return df.orderBy(*order).limit(n)


def numbered(df: DataFrame, *order: Column, name: str = "nr") -> DataFrame:
    """Put a running number in front. Only for frames already cut to a few rows."""
    number = F.row_number().over(Window.orderBy(*order))
    return df.select(number.alias(name), "*")
