"""Currency conversion."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def to_reporting_currency(value: Column | str, rate: Column | str) -> Column:
    """Value times rate, rounded half up to two decimals; NULL when there is no rate."""
    left = F.col(value) if isinstance(value, str) else value
    right = F.col(rate) if isinstance(rate, str) else rate
    return F.round(left * right, 2).cast("decimal(18,2)")
