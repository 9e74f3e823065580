"""Daily calendars."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def _each_day(bounds: DataFrame) -> DataFrame:
    return bounds.select(F.explode(F.sequence("first", "last")).alias("date"))


def calendar(spark: SparkSession, first: date, last: date) -> DataFrame:
    """One row per day from `first` to `last`, both included."""
    bounds = spark.range(1).select(F.lit(first).alias("first"), F.lit(last).alias("last"))
    return _each_day(bounds)


def days_spanned(plays: DataFrame) -> DataFrame:
    """One row per day from the first play's day to the last one's."""
    bounds = plays.agg(
        F.to_date(F.min("time")).alias("first"), F.to_date(F.max("time")).alias("last")
    )
    return _each_day(bounds)
