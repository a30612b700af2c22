"""The declared data-quality checks of staging tables, marts and the seed."""

from __future__ import annotations

from collections.abc import Mapping

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from cashline.operators.checks import (
    ERROR,
    WARN,
    Check,
    KeyUse,
    Pass,
    duplicate_values,
    missing_parents,
    overlapping_versions,
    run_checks,
    share_keys,
)
from cashline.operators.joins import same_key, with_header
from cashline.plans.staging import STAGING

SEED = "exchange_rates"

# Columns that must not be NULL.
NOT_NULL: dict[str, list[str]] = {
    "stg_sap__kna1": ["customer_id"],
    "stg_sap__mara": ["material_id"],
    "stg_sap__makt": ["material_id", "language_key"],
    "stg_sap__vbak": ["sales_order_id", "customer_id", "net_value"],
    "stg_sap__vbap": ["sales_order_id", "item_no", "material_id"],
    "stg_sap__vbrk": ["billing_id", "payer_id", "is_cancelled"],
    "stg_sap__vbrp": ["billing_id", "item_no", "sales_order_id"],
    "stg_sap__likp": ["delivery_id", "delivery_date"],
    "stg_sap__lips": ["delivery_id", "item_no", "shipped_qty"],
    "stg_sap__bsid": ["accounting_doc_id", "billing_id", "amount"],
    "stg_sap__bsad": ["accounting_doc_id", "cleared_on"],
    "dim_customer": ["customer_key", "customer_id", "valid_from", "valid_to"],
    "dim_material": ["material_id", "material_description"],
    "dim_date": ["date_day"],
    "fct_sales_order_items": ["sales_order_item_key", "order_date", "customer_key", "material_id"],
    "fct_billing_items": [
        "billing_item_key",
        "billing_date",
        "customer_key",
        "material_id",
        "is_cancelled",
        "is_orphan_item",
    ],
    "fct_delivery_items": [
        "delivery_item_key",
        "delivery_date",
        "sales_order_item_key",
        "shipped_qty",
    ],
    "fct_receivable_items": ["receivable_key", "billing_id", "customer_key"],
    "exchange_rates": ["currency", "rate_to_usd"],
}

# Columns that must be unique.
UNIQUE: list[tuple[str, str]] = [
    ("stg_sap__kna1", "customer_id"),
    ("stg_sap__mara", "material_id"),
    ("stg_sap__vbak", "sales_order_id"),
    ("stg_sap__vbrk", "billing_id"),
    ("stg_sap__likp", "delivery_id"),
    ("dim_customer", "customer_key"),
    ("dim_material", "material_id"),
    ("dim_date", "date_day"),
    ("fct_sales_order_items", "sales_order_item_key"),
    ("fct_billing_items", "billing_item_key"),
    ("fct_delivery_items", "delivery_item_key"),
    ("fct_receivable_items", "receivable_key"),
    ("exchange_rates", "currency"),
]

# Child table and column, parent table and column, severity.
RELATIONSHIPS: list[tuple[str, str, str, str, str]] = [
    ("stg_sap__vbak", "customer_id", "stg_sap__kna1", "customer_id", ERROR),
    ("stg_sap__vbap", "sales_order_id", "stg_sap__vbak", "sales_order_id", ERROR),
    ("stg_sap__vbap", "material_id", "stg_sap__mara", "material_id", ERROR),
    ("stg_sap__vbrk", "payer_id", "stg_sap__kna1", "customer_id", ERROR),
    ("stg_sap__vbrp", "billing_id", "stg_sap__vbrk", "billing_id", ERROR),
    ("stg_sap__vbrp", "sales_order_id", "stg_sap__vbap", "sales_order_id", WARN),
    ("stg_sap__lips", "delivery_id", "stg_sap__likp", "delivery_id", ERROR),
    ("fct_sales_order_items", "customer_key", "dim_customer", "customer_key", ERROR),
    ("fct_sales_order_items", "material_id", "dim_material", "material_id", ERROR),
    ("fct_billing_items", "customer_key", "dim_customer", "customer_key", ERROR),
    ("fct_billing_items", "material_id", "dim_material", "material_id", ERROR),
    (
        "fct_delivery_items",
        "sales_order_item_key",
        "fct_sales_order_items",
        "sales_order_item_key",
        ERROR,
    ),
    ("fct_receivable_items", "customer_key", "dim_customer", "customer_key", ERROR),
]

# Columns with a closed list of values.
ACCEPTED: list[tuple[str, str, list[str]]] = [
    ("stg_sap__vbak", "currency", ["USD", "CAD"]),
    ("stg_sap__vbap", "currency", ["USD", "CAD"]),
    ("stg_sap__vbrk", "currency", ["USD", "CAD"]),
    ("fct_sales_order_items", "currency", ["USD", "CAD"]),
    ("fct_receivable_items", "status", ["open", "cleared"]),
    ("fct_receivable_items", "currency", ["USD", "CAD"]),
]

Tables = Mapping[str, DataFrame]

BILLED_TOO_MUCH = "billed_qty > ordered_qty"
CLEARED_TOO_EARLY = "cleared_on < posting_date"


def billed_over_ordered(billing: DataFrame, sales: DataFrame) -> DataFrame:
    """Billing items with more than the ordered quantity of their order item."""
    ordered = _billed_order_items(billing, sales, ["ordered_qty"])
    return ordered.filter(BILLED_TOO_MUCH).select(
        "billing_item_key", "billed_qty", "ordered_qty"
    )


def billed_though_rejected(billing: DataFrame, sales: DataFrame) -> DataFrame:
    """Billing items of rejected order items."""
    rejected = sales.filter("is_rejected")
    return _billed_order_items(billing, rejected, ["sales_order_item_key"]).select(
        "billing_item_key", "sales_order_item_key"
    )


def _billed_order_items(billing: DataFrame, sales: DataFrame, columns: list[str]) -> DataFrame:
    order_items = sales.select(
        F.col("sales_order_id").alias("__order"), F.col("item_no").alias("__item"), *columns
    )
    billed = billing.select(
        "billing_item_key", "sales_order_id", "sales_order_item_no", "billed_qty"
    )
    on = {"sales_order_id": "__order", "sales_order_item_no": "__item"}
    return billed.join(order_items, same_key(billed, order_items, on), "inner")


def cleared_before_posting(receivables: DataFrame) -> DataFrame:
    """Receivables cleared before they were posted."""
    return receivables.filter(CLEARED_TOO_EARLY).select(
        "receivable_key", "posting_date", "cleared_on"
    )


def receivable_differs_from_invoice(receivables: DataFrame, invoices: DataFrame) -> DataFrame:
    """Receivables whose amount is not the net value of their invoice."""
    joined = with_header(receivables, invoices, "billing_id", ["net_value"])
    return joined.filter(F.col("amount_doc_currency") != F.col("net_value")).select(
        "receivable_key", "amount_doc_currency", "net_value"
    )


def shipped_over_ordered(deliveries: DataFrame, sales: DataFrame) -> DataFrame:
    """Delivery items with more than the ordered quantity of their order item.

    Met by the order item's own number, so that deliveries need not look up its key before.
    """
    ordered = sales.select(F.col("sales_order_id").alias("__order"), F.col("item_no").alias("__item"), "ordered_qty")
    shipped = deliveries.select("delivery_item_key", "sales_order_id", "sales_order_item_no", "shipped_qty")
    on = {"sales_order_id": "__order", "sales_order_item_no": "__item"}
    joined = shipped.join(ordered, same_key(shipped, ordered, on), "inner")
    return joined.filter(F.col("shipped_qty") > F.col("ordered_qty")).select(
        "delivery_item_key", "shipped_qty", "ordered_qty"
    )


def parent_keys(tables: Tables) -> dict[tuple[str, str], KeyUse]:
    """The key columns that checks are about, by table and column."""
    named = [*UNIQUE, *[(parent, column) for _, _, parent, column, _ in RELATIONSHIPS]]
    return {(t, c): KeyUse((t, c), lambda t=t: tables[t], c) for t, c in dict.fromkeys(named) if t in tables}


def generic_checks(tables: Tables) -> list[Check]:
    """Unique and relationship checks whose tables are all given."""
    keys = parent_keys(tables)
    checks = [
        Check(
            f"unique_{table}_{column}",
            table,
            "unique",
            lambda t=table, c=column: duplicate_values(tables[t], [c]),
            key=keys[table, column],
        )
        for table, column in UNIQUE
        if table in tables
    ]
    # The extracts' composite keys, which the declared list leaves out.
    checks += [
        Check(
            f"unique_{name}_{'_'.join(spec.keys)}",
            name,
            "unique",
            lambda n=name, s=spec: duplicate_values(tables[n], s.keys),
        )
        for name, spec in STAGING.items()
        if len(spec.keys) > 1 and name in tables
    ]
    checks += [
        Check(
            f"relationships_{child}_{column}__{parent}",
            child,
            "relationships",
            lambda c=child, k=column, p=parent, pk=parent_column: missing_parents(
                tables[c], k, tables[p], pk
            ),
            severity,
            "n_records",
            KeyUse((parent, parent_column), lambda c=child: tables[c], column),
        )
        for child, column, parent, parent_column, severity in RELATIONSHIPS
        if child in tables and parent in tables
    ]
    return checks


def business_checks(tables: Tables) -> list[Check]:
    """The rules that need a plan of their own, for the tables given; `table_passes` has the others."""
    declared = [
        (
            "customer_versions_do_not_overlap",
            ("dim_customer",),
            lambda customers: overlapping_versions(
                customers, key="customer_id", version_key="customer_key"
            ),
            ERROR,
        ),
        (
            "receivable_matches_invoice",
            ("fct_receivable_items", "stg_sap__vbrk"),
            receivable_differs_from_invoice,
            ERROR,
        ),
        (
            "shipped_qty_within_ordered_qty",
            ("fct_delivery_items", "fct_sales_order_items"),
            shipped_over_ordered,
            WARN,
        ),
    ]
    return [
        Check(
            name,
            inputs[0],
            "business_rule",
            lambda q=query, i=inputs: q(*[tables[t] for t in i]),
            severity,
        )
        for name, inputs, query, severity in declared
        if all(t in tables for t in inputs)
    ]


def table_passes(tables: Tables) -> list[Pass]:
    """One pass per table for its not-null and accepted-value checks and its own rules, and one over the
    billed order items for both rules on them."""
    rules = {"fct_receivable_items": {"cleared_after_posting": CLEARED_TOO_EARLY}}
    passes = [
        Pass(
            table,
            lambda t=table: tables[t],
            columns,
            {c: values for t, c, values in ACCEPTED if t == table},
            rules.get(table, {}),
        )
        for table, columns in NOT_NULL.items()
        if table in tables
    ]
    if "fct_billing_items" in tables and "fct_sales_order_items" in tables:
        billing, sales = tables["fct_billing_items"], tables["fct_sales_order_items"]
        on_items = {
            "billed_qty_within_ordered_qty": BILLED_TOO_MUCH,
            "no_billing_for_rejected_order_items": "is_rejected",
        }
        joined = lambda: _billed_order_items(billing, sales, ["ordered_qty", "is_rejected"])
        passes.append(Pass("fct_billing_items", joined, rules=on_items))
    return passes


def check_tables(spark: SparkSession, tables: Tables, only: set[str] | None = None) -> DataFrame:
    """Run every declared check on the given tables, or only those reported under `only`."""

    def wanted(checks: list) -> list:
        return [check for check in checks if only is None or check.table in only]

    shared = share_keys(wanted(generic_checks(tables)), parent_keys(tables))
    return run_checks(spark, [*shared, *wanted(business_checks(tables))], wanted(table_passes(tables)))
