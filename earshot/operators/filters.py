"""Row selections every panel starts from."""

from __future__ import annotations

from datetime import date

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from earshot.functions import days_between, months_between


def user_plays(plays: DataFrame, user: str, start: date | str, end: date | str) -> DataFrame:
    """One user's plays on days strictly between `start` and `end`."""
    return plays.filter((F.col("username") == user) & days_between(start, end))


def all_plays_in_range(plays: DataFrame, start: date | str, end: date | str) -> DataFrame:
    """Everybody's plays on days strictly between `start` and `end`."""
    return plays.filter(days_between(start, end))


def plays_by_months(
    plays: DataFrame, user: str, year: int, first: int = 1, last: int = 12
) -> DataFrame:
    """One user's plays in months `first` to `last` of a year, both included."""
    return plays.filter((F.col("username") == user) & months_between(year, first, last))
