"""Date spine and date dimension."""

from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from cashline.functions import (
    day_name,
    is_weekend,
    month_name,
    month_number,
    quarter_number,
    year_number,
)


def date_bounds(sources: Sequence[tuple[DataFrame, str]]) -> DataFrame:
    """One row (first_day, last_day) over the date columns of several tables.

    One pass per table; empty tables and NULL dates do not count.
    """
    per_table = [
        df.agg(F.min(column).alias("first_day"), F.max(column).alias("last_day"))
        for df, column in sources
    ]
    return reduce(DataFrame.unionByName, per_table).agg(
        F.min("first_day").alias("first_day"), F.max("last_day").alias("last_day")
    )


def date_spine(bounds: DataFrame) -> DataFrame:
    """One row per day from `first_day` to `last_day`; none if a bound is NULL or they cross."""
    in_order = F.col("first_day") <= F.col("last_day")
    days = F.when(in_order, F.sequence("first_day", "last_day", F.expr("interval 1 day")))
    return bounds.select(F.explode(days).alias("date_day"))


def date_dimension(bounds: DataFrame) -> DataFrame:
    """The days between the bounds with their calendar attributes."""
    day = F.col("date_day")
    return date_spine(bounds).select(
        day,
        year_number(day).alias("year"),
        quarter_number(day).alias("quarter"),
        month_number(day).alias("month_number"),
        month_name(day).alias("month_name"),
        day_name(day).alias("day_name"),
        is_weekend(day).alias("is_weekend"),
    )
