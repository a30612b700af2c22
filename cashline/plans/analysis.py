"""The questions the star schema answers, as plain aggregations over the marts."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cashline.functions import days_between, month_start
from cashline.operators.joins import lookup, same_key


def _value_by_month(facts: DataFrame, customers: DataFrame, day: str, value: Column) -> DataFrame:
    # Looked up before the one sum: where few rows share version, material and month, a sum per version moves nearly
    # all of them once more. A customer who has a third of all rows is split by the join, and summed in the map tasks.
    rows = facts.select("customer_key", "material_id", month_start(day).alias("month"), value.alias("value"))
    # A version without a customer adds none. Left out here as by `point_in_time`, history is shuffled once for both.
    versions = customers.filter(F.col("customer_id").isNotNull())
    named = lookup(rows, versions, {"customer_key": "customer_key"}, ["customer_id"])
    return named.groupBy("customer_id", "material_id", "month").agg(
        F.sum("value").cast("decimal(28,2)").alias("value_usd"), F.count("*").alias("n_items")
    )


def ordered_value_by_month(sales: DataFrame, customers: DataFrame) -> DataFrame:
    """Ordered value by customer, material and month."""
    return _value_by_month(sales, customers, "order_date", F.col("net_value_usd"))


def billed_value_by_month(
    billing: DataFrame, customers: DataFrame, *, include_orphans: bool = True
) -> DataFrame:
    """Billed value by customer, material and month, without cancelled invoices."""
    billed = billing.filter(~F.col("is_cancelled"))
    if not include_orphans:
        billed = billed.filter(~F.col("is_orphan_item"))
    return _value_by_month(billed, customers, "billing_date", F.col("net_value_usd"))


def unbilled_items(sales: DataFrame, billing: DataFrame) -> DataFrame:
    """Order items neither rejected nor on an invoice in force."""
    billed = (
        billing.filter(~F.col("is_cancelled"))
        .select(F.col("sales_order_id").alias("__order"), F.col("sales_order_item_no").alias("__item"))
        .dropna()
        .dropDuplicates()
    )
    open_items = sales.filter(~F.col("is_rejected"))
    same = same_key(open_items, billed, {"sales_order_id": "__order", "item_no": "__item"})
    return open_items.join(billed, same, "left_anti")


def open_order_value(sales: DataFrame, billing: DataFrame) -> DataFrame:
    """Value of unbilled order items by currency."""
    return unbilled_items(sales, billing).groupBy("currency").agg(
        F.sum("net_value_doc_currency").cast("decimal(28,2)").alias("open_value_doc_currency"),
        F.sum("net_value_usd").cast("decimal(28,2)").alias("open_value_usd"),
        F.count("*").alias("n_items"),
    )


def order_to_invoice_days(billing: DataFrame, sales: DataFrame) -> DataFrame:
    """Days from order to invoice by billing month: count, mean, median and extremes."""
    invoiced = lookup(
        billing.filter(~F.col("is_cancelled")),
        sales,
        {"sales_order_id": "sales_order_id", "sales_order_item_no": "item_no"},
        ["order_date"],
    ).filter(F.col("order_date").isNotNull())
    return (
        invoiced.withColumn("days", days_between("billing_date", "order_date"))
        .groupBy(month_start("billing_date").alias("month"))
        .agg(
            F.count("days").alias("n_items"),
            F.avg("days").alias("avg_days"),
            F.percentile("days", 0.5).alias("median_days"),
            F.min("days").alias("min_days"),
            F.max("days").alias("max_days"),
        )
    )


def shipped_against_ordered(sales: DataFrame, deliveries: DataFrame) -> DataFrame:
    """Shipped and ordered quantity per order item; items never shipped show zero.

    Deliveries are summed by the number of their order item, which they carry, and not by its key,
    which they would first have to look up.
    """
    shipped = deliveries.groupBy("sales_order_id", "sales_order_item_no").agg(
        F.sum("shipped_qty").alias("shipped_qty"), F.count("*").alias("n_deliveries")
    )
    on = {"sales_order_id": "sales_order_id", "item_no": "sales_order_item_no"}
    items = lookup(sales, shipped, on, ["shipped_qty", "n_deliveries"])
    shipped_qty = F.coalesce("shipped_qty", F.lit(0)).cast("decimal(28,3)")
    return items.select(
        "sales_order_item_key",
        "sales_order_id",
        "item_no",
        "ordered_qty",
        shipped_qty.alias("shipped_qty"),
        F.coalesce("n_deliveries", F.lit(0)).cast("bigint").alias("n_deliveries"),
        (shipped_qty > F.col("ordered_qty")).alias("is_over_shipped"),
    )


def receivables_by_status(receivables: DataFrame) -> DataFrame:
    """Receivables by status and currency, with the mean days to clear."""
    return receivables.groupBy("status", "currency").agg(
        F.count("*").alias("n_items"),
        F.sum("amount_doc_currency").cast("decimal(28,2)").alias("amount_doc_currency"),
        F.sum("amount_usd").cast("decimal(28,2)").alias("amount_usd"),
        F.avg("days_to_clear").alias("avg_days_to_clear"),
    )
