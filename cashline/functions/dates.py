"""Calendar expressions."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import Column
from pyspark.sql import functions as F

# Fixed value: last day of a period that has not ended.
OPEN_END = dt.date(9999, 12, 31)


def date_from_file_name(c: Column | str) -> Column:
    """Date in the first run of eight digits of a file name; a name without one raises.

    By the pattern parser, which names the digits once: Spark computes a part that is named several times
    again each time in a filter, and finding the digits costs more than reading them.
    """
    column = F.col(c) if isinstance(c, str) else c
    return F.to_date(F.regexp_extract(column, "[0-9]{8}", 0), "yyyyMMdd")


def days_between(later: Column | str, earlier: Column | str) -> Column:
    return F.datediff(later, earlier).cast("bigint")


def add_days(day: Column | str, n: int) -> Column:
    return F.date_add(day, n)


def is_weekend(day: Column | str) -> Column:
    return F.weekday(day) >= 5


def month_name(day: Column | str) -> Column:
    return F.date_format(day, "MMMM")


def day_name(day: Column | str) -> Column:
    return F.date_format(day, "EEEE")


def year_number(day: Column | str) -> Column:
    return F.year(day).cast("bigint")


def quarter_number(day: Column | str) -> Column:
    return F.quarter(day).cast("bigint")


def month_number(day: Column | str) -> Column:
    return F.month(day).cast("bigint")


def month_start(day: Column | str) -> Column:
    return F.trunc(day, "month")
