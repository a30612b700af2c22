"""The exchange-rate seed."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

RATE_SCHEMA = "currency string, rate_to_usd decimal(9,6)"

# Illustrative rates to the reporting currency.
EXCHANGE_RATES = [("USD", "1.00"), ("CAD", "0.73")]


def exchange_rates(spark: SparkSession, path: str | None = None) -> DataFrame:
    """Rates to USD, from a CSV file with a header or the built-in ones."""
    if path is not None:
        return spark.read.schema(RATE_SCHEMA).option("header", True).csv(path)
    values = ", ".join(f"('{currency}', {rate})" for currency, rate in EXCHANGE_RATES)
    return spark.sql(
        f"select currency, cast(rate as decimal(9,6)) as rate_to_usd "
        f"from values {values} as rates(currency, rate)"
    )
