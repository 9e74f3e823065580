from earshot.functions.columns import (
    asc,
    day_before,
    days_between,
    desc,
    iso_weekday,
    minutes,
    months_between,
    n_distinct,
    strict_mean,
    weekday_name,
    whole,
)
from earshot.functions.frames import file_order, first_per_key, numbered, top_n

__all__ = [
    "asc",
    "day_before",
    "days_between",
    "desc",
    "file_order",
    "first_per_key",
    "iso_weekday",
    "minutes",
    "months_between",
    "n_distinct",
    "numbered",
    "strict_mean",
    "top_n",
    "weekday_name",
    "whole",
]
