"""Staging: typed columns and the latest version of every record, one table per extract."""

from __future__ import annotations

from collections.abc import Sequence
from dataclasses import dataclass

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from cashline.functions import flag_set, sap_amount, sap_date, sap_quantity, sap_text
from cashline.operators.versions import change_order, latest_version, load_order
from cashline.schema import LOADED_AT, SOURCE_FILE

CLEANERS = {
    "text": sap_text,
    "date": sap_date,
    "amount": sap_amount,
    "quantity": sap_quantity,
    "flag": flag_set,
}


@dataclass(frozen=True)
class StagingSpec:
    """How one extract becomes a staging table."""

    raw: str
    keys: tuple[str, ...]
    columns: str  # lines "RAW_COLUMN name cleaner"
    changed_on: str | None = "changed_on"

    def mapping(self) -> list[tuple[str, str, str]]:
        return [tuple(line.split()) for line in self.columns.splitlines() if line.strip()]

    def newest_first(self) -> list[Column]:
        return change_order(self.changed_on) if self.changed_on else load_order()


_RECEIVABLE_COLUMNS = """
    BUKRS company_code text
    BELNR accounting_doc_id text
    GJAHR fiscal_year text
    BUZEI doc_item text
    KUNNR customer_id text
    BLART doc_type text
    BUDAT posting_date date
    FAEDT due_date date
    ZTERM payment_terms text
    WRBTR amount amount
    WAERS currency text
    ZUONR billing_id text
"""
_RECEIVABLE_KEYS = ("company_code", "accounting_doc_id", "fiscal_year", "doc_item")

# Names, keys and column maps of the staging tables. Customers, descriptions and
# receivables carry no change date, so there the latest load decides.
STAGING: dict[str, StagingSpec] = {
    "stg_sap__kna1": StagingSpec(
        "KNA1",
        ("customer_id",),
        """
        KUNNR customer_id text
        NAME1 customer_name text
        ORT01 city text
        REGIO region text
        LAND1 country_code text
        ERDAT created_on date
        """,
        changed_on=None,
    ),
    "stg_sap__mara": StagingSpec(
        "MARA",
        ("material_id",),
        """
        MATNR material_id text
        MTART material_type text
        MATKL material_group text
        MEINS base_unit text
        ERSDA created_on date
        LAEDA changed_on date
        """,
    ),
    "stg_sap__makt": StagingSpec(
        "MAKT",
        ("material_id", "language_key"),
        """
        MATNR material_id text
        SPRAS language_key text
        MAKTX material_description text
        """,
        changed_on=None,
    ),
    "stg_sap__vbak": StagingSpec(
        "VBAK",
        ("sales_order_id",),
        """
        VBELN sales_order_id text
        AUART order_type text
        KUNNR customer_id text
        AUDAT order_date date
        WAERK currency text
        NETWR net_value amount
        ERDAT created_on date
        AEDAT changed_on date
        """,
    ),
    "stg_sap__vbap": StagingSpec(
        "VBAP",
        ("sales_order_id", "item_no"),
        """
        VBELN sales_order_id text
        POSNR item_no text
        MATNR material_id text
        KWMENG ordered_qty quantity
        VRKME sales_unit text
        NETWR net_value amount
        WAERK currency text
        ABGRU rejection_reason text
        ERDAT created_on date
        AEDAT changed_on date
        """,
    ),
    "stg_sap__vbrk": StagingSpec(
        "VBRK",
        ("billing_id",),
        """
        VBELN billing_id text
        FKART billing_type text
        FKDAT billing_date date
        KUNRG payer_id text
        WAERK currency text
        NETWR net_value amount
        FKSTO is_cancelled flag
        ERDAT created_on date
        AEDAT changed_on date
        """,
    ),
    "stg_sap__vbrp": StagingSpec(
        "VBRP",
        ("billing_id", "item_no"),
        """
        VBELN billing_id text
        POSNR item_no text
        AUBEL sales_order_id text
        AUPOS sales_order_item_no text
        MATNR material_id text
        FKIMG billed_qty quantity
        VRKME sales_unit text
        NETWR net_value amount
        ERDAT created_on date
        AEDAT changed_on date
        """,
    ),
    "stg_sap__likp": StagingSpec(
        "LIKP",
        ("delivery_id",),
        """
        VBELN delivery_id text
        LFART delivery_type text
        KUNNR ship_to_customer_id text
        LFDAT delivery_date date
        ERDAT created_on date
        AEDAT changed_on date
        """,
    ),
    "stg_sap__lips": StagingSpec(
        "LIPS",
        ("delivery_id", "item_no"),
        """
        VBELN delivery_id text
        POSNR item_no text
        VGBEL sales_order_id text
        VGPOS sales_order_item_no text
        MATNR material_id text
        LFIMG shipped_qty quantity
        VRKME sales_unit text
        ERDAT created_on date
        AEDAT changed_on date
        """,
    ),
    "stg_sap__bsid": StagingSpec("BSID", _RECEIVABLE_KEYS, _RECEIVABLE_COLUMNS, changed_on=None),
    "stg_sap__bsad": StagingSpec(
        "BSAD",
        _RECEIVABLE_KEYS,
        _RECEIVABLE_COLUMNS
        + """
    AUGDT cleared_on date
    AUGBL clearing_doc_id text
""",
        changed_on=None,
    ),
}


def clean(raw: DataFrame, spec: StagingSpec) -> DataFrame:
    """All versions, renamed and typed, with their lineage columns."""
    typed = [CLEANERS[cleaner](source).alias(name) for source, name, cleaner in spec.mapping()]
    return raw.select(*typed, LOADED_AT, SOURCE_FILE)


def _content(columns: Sequence[str], spec: StagingSpec) -> Column:
    return F.xxhash64(*[c for c in columns if c not in spec.keys])


def newest_versions(raw: DataFrame, name: str) -> DataFrame:
    """The latest version of each business key, with its lineage columns.

    Rows that tie in change date, load and file are told apart by a hash of their content, so that
    a repeated task, or another query, picks the same one; one hash sorts faster than all columns.
    """
    spec = STAGING[name]
    versions = clean(raw, spec)
    content = F.desc(_content(versions.columns, spec))
    return latest_version(versions, spec.keys, [*spec.newest_first(), content])


def version_rank(columns: Sequence[str], name: str) -> Column:
    """What `newest_versions` picks the greatest of, as one value to compare versions of a key by.

    In a struct NULL is the least value, as it is where undated rows come last. `columns` are those of
    the versions, in their order.
    """
    spec = STAGING[name]
    changed = [F.coalesce(spec.changed_on, "created_on")] if spec.changed_on else []
    return F.struct(*changed, LOADED_AT, SOURCE_FILE, _content(columns, spec))


def stage(raw: DataFrame, name: str) -> DataFrame:
    """The staging table `name`: the latest version of each business key."""
    return newest_versions(raw, name).drop(LOADED_AT, SOURCE_FILE)


def clean_bad_dates(raw: DataFrame, name: str) -> DataFrame:
    """Rows whose text in some date column is no date; staging would stop at them."""
    columns = [source for source, _, cleaner in STAGING[name].mapping() if cleaner == "date"]
    bad = F.lit(False)
    for source in columns:
        given = ~F.trim(source).isin("", "00000000")
        bad = bad | F.coalesce(given & sap_date(source, strict=False).isNull(), F.lit(False))
    return raw.filter(bad)
