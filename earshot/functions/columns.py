"""Column expressions shared by the operators."""

from __future__ import annotations

from datetime import date, timedelta

from pyspark.sql import Column
from pyspark.sql import functions as F

MS_PER_MINUTE = 60000.0
WEEKDAYS = ("Monday", "Tuesday", "Wednesday", "Thursday", "Friday", "Saturday", "Sunday")


def asc(name: str) -> Column:
    """Ascending sort key with missing values last."""
    return F.col(name).asc_nulls_last()


def desc(name: str) -> Column:
    """Descending sort key with missing values last."""
    return F.col(name).desc_nulls_last()


def minutes(ms: str = "ms_played") -> Column:
    """Summed milliseconds as minutes; the sum stays integral, so it is exact."""
    return F.sum(ms) / F.lit(MS_PER_MINUTE)


def whole(value: Column) -> Column:
    """Round to a whole number, halves to the even neighbour."""
    return F.bround(value, 0)


def n_distinct(name: str) -> Column:
    """Distinct values, counting a missing value as one of them."""
    seen_missing = F.max(F.when(F.col(name).isNull(), 1).otherwise(0))
    return F.count_distinct(name) + seen_missing


def strict_mean(name: str) -> Column:
    """Mean that is missing as soon as one value is missing."""
    return F.when(F.count(name) == F.count(F.lit(1)), F.avg(name))


def iso_weekday(day: Column) -> Column:
    """Monday = 1 up to Sunday = 7."""
    return F.weekday(day) + 1


def weekday_name(weekday: str) -> Column:
    """The English name of a weekday number."""
    return F.element_at(F.array(*map(F.lit, WEEKDAYS)), F.col(weekday))


def _midnight(day: date) -> Column:
    return F.lit(day.isoformat()).cast("timestamp_ntz")


def _date(day: date | str) -> date:
    return day if isinstance(day, date) else date.fromisoformat(day)


def day_before(day: date | str, time: str = "time") -> Column:
    """The play happened before `day` began."""
    return F.col(time) < _midnight(_date(day))


def days_between(start: date | str, end: date | str, time: str = "time") -> Column:
    """Calendar day strictly between `start` and `end`.

    Both ends are exclusive as whole days. Written as bounds on the timestamp
    itself, so that file statistics can skip row groups.
    """
    first_moment = _midnight(_date(start) + timedelta(days=1))
    return (F.col(time) >= first_moment) & day_before(end, time)


def day_after(day: date | str, time: str = "time") -> Column:
    """The play happened after `day` had ended."""
    return F.col(time) >= _midnight(_date(day) + timedelta(days=1))


def months_between(year: int, first: int = 1, last: int = 12, time: str = "time") -> Column:
    """Months `first` to `last` of a year, both included, as timestamp bounds."""
    for month in (first, last):
        if not 1 <= month <= 12:
            raise ValueError(f"month out of range: {month}")
    after = date(year + last // 12, last % 12 + 1, 1)
    return (F.col(time) >= _midnight(date(year, first, 1))) & (F.col(time) < _midnight(after))
