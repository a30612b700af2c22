"""The star schema: three dimensions and four fact tables, as functions of staging tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cashline.functions import (
    date_from_file_name,
    days_between,
    fingerprint,
    sap_text,
    surrogate_key,
    to_reporting_currency,
)
from cashline.operators.calendar import date_bounds, date_dimension
from cashline.operators.joins import lookup, mark_missing, point_in_time, with_header
from cashline.operators.versions import load_order, scd2
from cashline.schema import LOADED_AT, SOURCE_FILE

# A step of a fact. As `deal` it puts rows together for their file, and adds columns of where they go.
Step = Callable[[DataFrame], DataFrame]

CUSTOMER_ATTRIBUTES = ["customer_name", "city", "region", "country_code"]


def customer_history(raw_kna1: DataFrame) -> DataFrame:
    """Every customer row as a state on the date of its extract file."""
    return raw_kna1.select(
        sap_text("KUNNR").alias("customer_id"),
        sap_text("NAME1").alias("customer_name"),
        sap_text("ORT01").alias("city"),
        sap_text("REGIO").alias("region"),
        sap_text("LAND1").alias("country_code"),
        date_from_file_name(SOURCE_FILE).alias("valid_from"),
        LOADED_AT,
        SOURCE_FILE,
    )


def customer_fingerprint() -> Column:
    return fingerprint(*CUSTOMER_ATTRIBUTES)


def dim_customer(raw_kna1: DataFrame) -> DataFrame:
    """Customer versions, from every raw row: a version starts on its extract file's date."""
    return scd2(
        customer_history(raw_kna1),
        key="customer_id",
        attributes=CUSTOMER_ATTRIBUTES,
        order_by=load_order(),
        version_key="customer_key",
    )


def dim_material(mara: DataFrame, makt: DataFrame) -> DataFrame:
    """Materials with their English description; NULL where there is none."""
    english = makt.filter(F.col("language_key") == "E")
    described = lookup(mara, english, {"material_id": "material_id"}, ["material_description"])
    return described.select(
        "material_id",
        "material_description",
        "material_type",
        "material_group",
        "base_unit",
        "created_on",
        "changed_on",
    )


def dim_date(
    vbak: DataFrame, vbrk: DataFrame, *more: tuple[DataFrame, str]
) -> DataFrame:
    """Calendar over all order and billing dates, and over further columns if given."""
    return date_dimension(date_bounds([(vbak, "order_date"), (vbrk, "billing_date"), *more]))


# The start of the customer version in force on the date of a document.
SINCE = "__customer_since"


def _with_customer(facts: DataFrame, customers: DataFrame | None, key: str, on_date: str) -> DataFrame:
    """Add the start of the customer version in force.

    Customer and date belong to the document header, so this joins headers, before items:
    fewer rows to resolve, and items are shuffled for their header only. The key of a version is a hash
    of customer and start, 32 characters that no codec makes smaller: a fact makes it at its end
    (`_customer_key`), so that no shuffle moves it.
    """
    if customers is None:
        return facts.withColumn(SINCE, F.lit(None).cast("date"))
    return point_in_time(
        facts,
        customers.withColumn(SINCE, F.col("valid_from")),
        key=key,
        on_date=on_date,
        version_id="customer_id",
        columns=[SINCE],
        disjoint=True,
    )


def _customer_key(key: str) -> Column:
    """The key that `dim_customer` gives the version in force, NULL where there is none."""
    return surrogate_key(key, SINCE).alias("customer_key")


def _with_rate(facts: DataFrame, rates: DataFrame | None) -> DataFrame:
    if rates is None:
        return facts.withColumn("rate_to_usd", F.lit(None).cast("decimal(9,6)"))
    return lookup(facts, rates, {"currency": "currency"}, ["rate_to_usd"], small=True)


def _header_last(items: DataFrame, with_headers: Step, with_order_items: Step, n_buckets: int | None) -> DataFrame:
    """Items with what their header and their order item add to them.

    The header adds more columns, so it comes last and items move for their order item without them. Items that
    are stored in buckets of their document do not move for their header, and find it first.
    """
    return with_order_items(with_headers(items)) if n_buckets else with_headers(with_order_items(items))


def _select(facts: DataFrame, deal: Step | None, *columns: Column | str) -> DataFrame:
    """The columns of a fact and those of where its rows go.

    Rows are dealt before the keys are made: hashes of 32 characters that no codec makes smaller are not moved.
    """
    dealt = deal(facts) if deal else facts
    return dealt.select(*columns, *[c for c in dealt.columns if c not in facts.columns])


def _read_only(
    facts: DataFrame,
    customers: DataFrame | None,
    rates: DataFrame | None,
    deal: Step | None,
    *columns: Column | str,
) -> DataFrame:
    """The columns of a fact that its inputs allow: without customers or rates those that need them go.

    Spark keeps a left join also where nobody reads what it adds, so a question that needs neither
    asks for the fact without them.
    """
    out = _select(facts, deal, *columns)
    left_out = {"customer_key"} if customers is None else set()
    return out.drop(*left_out, *[c for c in out.columns if c.endswith("_usd") and rates is None])


def fct_sales_order_items(
    vbap: DataFrame,
    vbak: DataFrame,
    customers: DataFrame | None,
    rates: DataFrame | None,
    *,
    n_buckets: int | None = None,
    deal: Step | None = None,
) -> DataFrame:
    """Ordered quantity and value, one row per order item, in the item's currency.

    Here and below `n_buckets` says that the tables are stored in so many buckets of their document, and `deal`
    puts rows together before their keys are made.
    """
    headers = _with_customer(vbak, customers, "customer_id", "order_date")
    of_header = ["order_date", "order_type", "customer_id", SINCE]
    items = with_header(vbap, headers, "sales_order_id", of_header, n_buckets=n_buckets)
    facts = _with_rate(items, rates)
    return _read_only(
        facts,
        customers,
        rates,
        deal,
        surrogate_key("sales_order_id", "item_no").alias("sales_order_item_key"),
        "sales_order_id",
        "item_no",
        "order_date",
        _customer_key("customer_id"),
        "material_id",
        "order_type",
        "ordered_qty",
        "sales_unit",
        "currency",
        F.col("net_value").alias("net_value_doc_currency"),
        to_reporting_currency("net_value", "rate_to_usd").alias("net_value_usd"),
        "rejection_reason",
        F.col("rejection_reason").isNotNull().alias("is_rejected"),
    )


def fct_billing_items(
    vbrp: DataFrame,
    vbrk: DataFrame,
    vbap: DataFrame | None,
    customers: DataFrame | None,
    rates: DataFrame | None,
    *,
    n_buckets: int | None = None,
    deal: Step | None = None,
) -> DataFrame:
    """Billed quantity and value; cancelled and orphaned items are flagged, not removed.

    Without order items (`vbap`) `is_orphan_item` is left out.
    """
    headers = _with_customer(vbrk, customers, "payer_id", "billing_date")
    of_header = ["billing_date", "billing_type", "currency", "is_cancelled", "payer_id", SINCE]
    with_headers = lambda items: with_header(items, headers, "billing_id", of_header, n_buckets=n_buckets)
    on = {"sales_order_id": "sales_order_id", "sales_order_item_no": "item_no"}

    def marked(items: DataFrame) -> DataFrame:
        if vbap is None:
            return items
        return mark_missing(items, vbap, on, "is_orphan_item", unique=True, n_buckets=n_buckets)

    facts = _with_rate(_header_last(vbrp, with_headers, marked, n_buckets), rates)
    return _read_only(
        facts,
        customers,
        rates,
        deal,
        surrogate_key("billing_id", "item_no").alias("billing_item_key"),
        "billing_id",
        "item_no",
        "billing_date",
        _customer_key("payer_id"),
        "sales_order_id",
        "sales_order_item_no",
        "material_id",
        "billing_type",
        "billed_qty",
        "sales_unit",
        "currency",
        F.col("net_value").alias("net_value_doc_currency"),
        to_reporting_currency("net_value", "rate_to_usd").alias("net_value_usd"),
        "is_cancelled",
        *["is_orphan_item"] * (vbap is not None),
    )


def fct_delivery_items(
    lips: DataFrame,
    likp: DataFrame,
    sales_items: DataFrame | None,
    customers: DataFrame | None,
    *,
    n_buckets: int | None = None,
    deal: Step | None = None,
) -> DataFrame:
    """Shipped quantity against each order item, and days from order to delivery.

    Without order items (`sales_items`) what is looked up in them is left out. Their key is that of
    `fct_sales_order_items`.
    """
    headers = _with_customer(likp, customers, "ship_to_customer_id", "delivery_date")
    of_header = ["delivery_date", "ship_to_customer_id", SINCE]
    with_headers = lambda items: with_header(items, headers, "delivery_id", of_header, n_buckets=n_buckets)
    on = {"sales_order_id": "sales_order_id", "sales_order_item_no": "item_no"}

    def ordered(items: DataFrame) -> DataFrame:
        if sales_items is None:
            return items
        found = sales_items.select("sales_order_id", "item_no", "order_date", F.lit(True).alias("__found"))
        return lookup(items, found, on, ["order_date", "__found"], n_buckets=n_buckets, spread=True)

    facts = _header_last(lips, with_headers, ordered, n_buckets)
    looked_up = sales_items is not None
    # The key of an order item is a hash of its number, which deliveries carry: made here, it is not moved.
    order_item_key = [F.when(F.col("__found"), surrogate_key("sales_order_id", "sales_order_item_no"))] * looked_up
    return _read_only(
        facts,
        customers,
        None,
        deal,
        surrogate_key("delivery_id", "item_no").alias("delivery_item_key"),
        "delivery_id",
        "item_no",
        "delivery_date",
        _customer_key("ship_to_customer_id"),
        *[key.alias("sales_order_item_key") for key in order_item_key],
        "sales_order_id",
        "sales_order_item_no",
        "material_id",
        "shipped_qty",
        "sales_unit",
        *["order_date", days_between("delivery_date", "order_date").alias("days_order_to_delivery")] * looked_up,
    )


def fct_receivable_items(
    bsid: DataFrame,
    bsad: DataFrame,
    customers: DataFrame,
    rates: DataFrame,
    *,
    n_buckets: int | None = None,
    deal: Step | None = None,
) -> DataFrame:
    """One row per posted receivable item, open or cleared, with days to clear."""
    document = ["company_code", "accounting_doc_id", "fiscal_year", "doc_item"]
    # Buckets are those of the number, of which the other key columns have few values each.
    on = {k: k for k in sorted(document, key=lambda k: k != "accounting_doc_id")}
    items = lookup(bsid, bsad, on, ["cleared_on", "clearing_doc_id"], n_buckets=n_buckets)
    facts = _with_rate(_with_customer(items, customers, "customer_id", "posting_date"), rates)
    is_cleared = F.col("cleared_on").isNotNull()
    return _select(
        facts,
        deal,
        surrogate_key(*document).alias("receivable_key"),
        *document,
        "billing_id",
        _customer_key("customer_id"),
        "posting_date",
        "due_date",
        F.col("amount").alias("amount_doc_currency"),
        "currency",
        to_reporting_currency("amount", "rate_to_usd").alias("amount_usd"),
        "cleared_on",
        "clearing_doc_id",
        is_cleared.alias("is_cleared"),
        F.when(is_cleared, "cleared").otherwise("open").alias("status"),
        days_between("cleared_on", "posting_date").alias("days_to_clear"),
    )
