"""Staging, marts and analysis on hand-made raw rows with known results."""

import datetime as dt
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cashline.plans import analysis, build, marts, quality, registry, testbed
from cashline.plans.build import (
    BuildResult,
    CheckFailed,
    Model,
    all_tables,
    build_all,
    build_models,
    current_tables,
    remove_old_builds,
)
from cashline.plans.publish import as_temp_views, publish
from cashline.plans.quality import check_tables
from cashline.plans.staging import STAGING, clean_bad_dates, stage
from cashline.schema import RAW_COLUMNS, RAW_KEYS
from cashline.session import INITIAL_PARTITIONS
from cashline.sources.seeds import exchange_rates
from conftest import collected, raw_frame

D = dt.date


def order(n, **more):
    return {"VBELN": n, "AUART": "OR", "ERDAT": "20260105", "AUDAT": "20260105", "KUNNR": "c1", "WAERK": "USD", "NETWR": "100.00", "AEDAT": "00000000", **more}


def item(n, pos="10", **more):
    return {"VBELN": n, "POSNR": pos, "MATNR": "m1", "KWMENG": "5", "VRKME": "EA", "NETWR": "100.00", "WAERK": "USD", "ERDAT": "20260105", "AEDAT": "00000000", **more}


RAW = {
    "KNA1": [
        ("KNA1_20260101.csv", 1, {"KUNNR": "c1", "NAME1": 'Brook, Hale and "Sons"', "ORT01": "Pella", "LAND1": "US"}),
        ("KNA1_20260107.csv", 7, {"KUNNR": "c1", "NAME1": 'Brook, Hale and "Sons"', "ORT01": "Peoria", "LAND1": "US"}),
        ("KNA1_20260107.csv", 7, {"KUNNR": "c1", "NAME1": 'Brook, Hale and "Sons"', "ORT01": "Peoria", "LAND1": "US"}),
        ("KNA1_20260106.csv", 6, {"KUNNR": "c2", "NAME1": "Late", "ORT01": "Regina", "LAND1": "CA"}),
    ],
    "MARA": [("MARA_20260101.csv", 1, {"MATNR": m, "MTART": "FERT", "ERSDA": "20260101", "LAEDA": "00000000"}) for m in ("m1", "m2")],
    "MAKT": [
        ("MAKT_20260101.csv", 1, {"MATNR": "m1", "SPRAS": "E", "MAKTX": "Drill"}),
        ("MAKT_20260101.csv", 1, {"MATNR": "m2", "SPRAS": "D", "MAKTX": "Bohrer"}),
    ],
    "VBAK": [
        # The change date wins although its file has the earlier name and load.
        ("VBAK_20260104.csv", 4, order("o1", NETWR="150.00", AEDAT="20260106")),
        ("VBAK_20260105.csv", 5, order("o1")),
        ("VBAK_20260105.csv", 5, order("o2", KUNNR="c2")),
        ("VBAK_20260105.csv", 5, order("o3", WAERK="CAD", AUDAT="20260108")),
        ("VBAK_20260105.csv", 5, order("o4", ERDAT="00000000")),
        ("VBAK_20260101.csv", 1, order("o4", AUART="ZZ", ERDAT="20260101")),
    ],
    "VBAP": [
        ("VBAP_20260105.csv", 5, item("o1", "10")),
        ("VBAP_20260105.csv", 5, item("o1", "10")),
        ("VBAP_20260105.csv", 5, item("o1", "20", ABGRU="02")),
        ("VBAP_20260105.csv", 5, item("o2", "10", WAERK="EUR")),
        ("VBAP_20260105.csv", 5, item("o3", "10", WAERK="CAD", NETWR="0.50")),
        ("VBAP_20260105.csv", 5, item("o9", "10")),
    ],
    "VBRK": [
        ("VBRK_20260108.csv", 8, {"VBELN": "b1", "FKART": "F2", "FKDAT": "20260108", "KUNRG": "c1", "WAERK": "CAD", "NETWR": "100.00", "ERDAT": "20260108", "AEDAT": "00000000"}),
        ("VBRK_20260108.csv", 8, {"VBELN": "b2", "FKART": "F2", "FKDAT": "20260108", "KUNRG": "c1", "WAERK": "USD", "NETWR": "70.00", "ERDAT": "20260108", "AEDAT": "00000000"}),
        ("VBRK_20260110.csv", 9, {"VBELN": "b2", "FKART": "F2", "FKDAT": "20260108", "KUNRG": "c1", "WAERK": "USD", "NETWR": "70.00", "FKSTO": "X ", "ERDAT": "20260108", "AEDAT": "20260110"}),
    ],
    "VBRP": [
        ("VBRP_20260108.csv", 8, {"VBELN": b, "POSNR": p, "AUBEL": o, "AUPOS": i, "MATNR": "m1", "FKIMG": q, "NETWR": "100.00", "ERDAT": "20260108", "AEDAT": "00000000"})
        for b, p, o, i, q in [("b1", "10", "o1", "10", "6"), ("b1", "20", "o1", "20", "5"), ("b1", "30", "o7", "10", "1"), ("b1", "40", "o1", "99", "1"), ("b1", "50", "", "10", "1"), ("b2", "10", "o3", "10", "1")]
    ],
    "LIKP": [("LIKP_20260109.csv", 9, {"VBELN": "d1", "LFART": "LF", "ERDAT": "20260109", "LFDAT": "20260109", "KUNNR": "c1", "AEDAT": "00000000"})],
    "LIPS": [
        ("LIPS_20260109.csv", 9, {"VBELN": "d1", "POSNR": p, "VGBEL": o, "VGPOS": "10", "MATNR": "m1", "LFIMG": q, "VRKME": "EA", "ERDAT": "20260109"})
        for p, o, q in [("10", "o1", "6.5"), ("20", "o7", "1"), ("30", "o3", "2")]
    ],
    "BSID": [
        ("BSID_20260108.csv", 8, {"BUKRS": "1000", "BELNR": b, "GJAHR": "2026", "BUZEI": "001", "KUNNR": "c1", "BUDAT": "20260108", "FAEDT": "20260207", "WRBTR": w, "WAERS": "USD", "ZUONR": z})
        for b, w, z in [("1", "100.00", "b1"), ("2", "71.00", "b2"), ("3", "1.00", "b7")]
    ],
    "BSAD": [
        ("BSAD_20260112.csv", 12, {"BUKRS": "1000", "BELNR": b, "GJAHR": "2026", "BUZEI": "001", "AUGDT": d, "AUGBL": "9"})
        for b, d in [("1", "20260112"), ("2", "20260107"), ("8", "20260112")]
    ],
}


@pytest.fixture(scope="module")
def tables(spark):
    raw = {name: raw_frame(spark, name, RAW[name]) for name in RAW_COLUMNS}
    return {name: df.cache() for name, df in all_tables(raw, exchange_rates(spark)).items()}


def pick(df, key, *columns):
    return {row[0]: tuple(row)[1:] for row in df.select(key, *columns).collect()}


def test_schema():
    assert list(RAW_COLUMNS) == list(RAW_KEYS) and len(RAW_COLUMNS) == 11
    for table, columns in RAW_COLUMNS.items():
        assert columns[0] == "MANDT" and set(RAW_KEYS[table]) <= set(columns)
        spec = next(s for s in STAGING.values() if s.raw == table)
        source_of = {name: source for source, name, _ in spec.mapping()}
        assert [source_of[k] for k in spec.keys] == RAW_KEYS[table]


def test_staging_keeps_the_newest_version(tables):
    orders = pick(tables["stg_sap__vbak"], "sales_order_id", "net_value", "order_type", "changed_on")
    assert orders["o1"] == (Decimal("150.00"), "OR", D(2026, 1, 6))
    assert orders["o4"][1] == "ZZ"  # rows without any date rank last
    assert tables["stg_sap__vbap"].count() == 5
    assert pick(tables["stg_sap__vbrk"], "billing_id", "is_cancelled") == {"b1": (False,), "b2": (True,)}
    assert pick(tables["stg_sap__kna1"], "customer_id", "city") == {"c1": ("Peoria",), "c2": ("Regina",)}


def test_later_named_file_wins_within_one_load(spark):
    rows = [(f"KNA1_2026010{d}.csv", 1, {"KUNNR": "c", "ORT01": str(d)}) for d in (2, 3, 1)]
    assert stage(raw_frame(spark, "KNA1", rows), "stg_sap__kna1").first()["city"] == "3"


def test_tied_rows_give_the_same_result_whatever_their_order(spark):
    rows = [("KNA1_20260101.csv", 1, {"KUNNR": "c", "ORT01": f"city {n}"}) for n in range(40)]
    picked = {
        stage(raw_frame(spark, "KNA1", rows[n:] + rows[:n]).repartition(4), "stg_sap__kna1").first()["city"]
        for n in (0, 7, 23)
    }
    assert len(picked) == 1


def test_bad_dates_stop_staging_and_can_be_listed(spark):
    raw = raw_frame(spark, "VBAK", [("VBAK_20260105.csv", 1, order("o1", AUDAT="20261340")), ("VBAK_20260105.csv", 1, order("o2"))])
    with pytest.raises(Exception):
        stage(raw, "stg_sap__vbak").collect()
    assert [r["VBELN"] for r in clean_bad_dates(raw, "stg_sap__vbak").collect()] == ["o1"]


def test_customer_history(tables):
    got = collected(tables["dim_customer"].select("customer_id", "city", "region", "valid_from", "valid_to", "is_current"), "customer_id", "valid_from")
    assert got == [
        ("c1", "Pella", None, D(2026, 1, 1), D(2026, 1, 6), False),
        ("c1", "Peoria", None, D(2026, 1, 7), D(9999, 12, 31), True),
        ("c2", "Regina", None, D(2026, 1, 6), D(9999, 12, 31), True),
    ]


def test_material_and_date_dimensions(spark, tables):
    assert pick(tables["dim_material"], "material_id", "material_description") == {"m1": ("Drill",), "m2": (None,)}
    days = tables["dim_date"].agg(F.min("date_day"), F.max("date_day"), F.count("*")).first()
    assert tuple(days) == (D(2026, 1, 5), D(2026, 1, 8), 4)
    more = marts.dim_date(tables["stg_sap__vbak"], tables["stg_sap__vbrk"], (tables["stg_sap__likp"], "delivery_date"))
    assert more.count() == 5


def test_sales_items(tables):
    sales = tables["fct_sales_order_items"]
    assert sales.columns == "sales_order_item_key sales_order_id item_no order_date customer_key material_id order_type ordered_qty sales_unit currency net_value_doc_currency net_value_usd rejection_reason is_rejected".split()
    got = {(r["sales_order_id"], r["item_no"]): r for r in sales.collect()}
    assert set(got) == {("o1", "10"), ("o1", "20"), ("o2", "10"), ("o3", "10")}  # o9 has no header
    versions = {(r["customer_id"], r["valid_from"].day): r["customer_key"] for r in tables["dim_customer"].collect()}
    assert got["o1", "10"]["customer_key"] == versions["c1", 1]
    assert got["o3", "10"]["customer_key"] == versions["c1", 7]
    assert got["o2", "10"]["customer_key"] is None  # ordered before the first version
    assert got["o2", "10"]["net_value_usd"] is None  # no rate
    assert got["o3", "10"]["net_value_usd"] == Decimal("0.37")
    assert got["o1", "20"]["is_rejected"] and not got["o1", "10"]["is_rejected"]


def test_billing_items(tables):
    billing = tables["fct_billing_items"]
    assert billing.columns == "billing_item_key billing_id item_no billing_date customer_key sales_order_id sales_order_item_no material_id billing_type billed_qty sales_unit currency net_value_doc_currency net_value_usd is_cancelled is_orphan_item".split()
    got = {(r["billing_id"], r["item_no"]): r for r in billing.collect()}
    assert {k: r["is_orphan_item"] for k, r in got.items()} == {
        ("b1", "10"): False, ("b1", "20"): False, ("b1", "30"): True, ("b1", "40"): True, ("b1", "50"): True, ("b2", "10"): False,
    }
    assert got["b2", "10"]["is_cancelled"] and got["b1", "10"]["currency"] == "CAD"
    assert got["b1", "10"]["net_value_usd"] == Decimal("73.00")


def test_delivery_items(tables):
    deliveries = tables["fct_delivery_items"]
    assert deliveries.columns == "delivery_item_key delivery_id item_no delivery_date customer_key sales_order_item_key sales_order_id sales_order_item_no material_id shipped_qty sales_unit order_date days_order_to_delivery".split()
    got = pick(deliveries, "item_no", "sales_order_item_key", "order_date", "days_order_to_delivery")
    assert got["20"] == (None, None, None)
    assert got["10"][1:] == (D(2026, 1, 5), 4) and got["30"][2] == 1


def test_receivables(tables):
    receivables = tables["fct_receivable_items"]
    assert receivables.columns == "receivable_key company_code accounting_doc_id fiscal_year doc_item billing_id customer_key posting_date due_date amount_doc_currency currency amount_usd cleared_on clearing_doc_id is_cleared status days_to_clear".split()
    assert pick(receivables, "accounting_doc_id", "status", "is_cleared", "days_to_clear") == {
        "1": ("cleared", True, 4), "2": ("cleared", True, -1), "3": ("open", False, None),
    }


def test_checks_find_what_was_planted(spark, tables):
    found = {r["check_name"]: (r["n_violations"], r["status"]) for r in check_tables(spark, tables).collect() if r["n_violations"]}
    assert found == {
        "billed_qty_within_ordered_qty": (1, "fail"),
        "no_billing_for_rejected_order_items": (1, "fail"),
        "cleared_after_posting": (1, "fail"),
        "receivable_matches_invoice": (1, "fail"),
        "shipped_qty_within_ordered_qty": (1, "warn"),
        "relationships_stg_sap__vbap_sales_order_id__stg_sap__vbak": (1, "fail"),
        "relationships_stg_sap__vbrp_sales_order_id__stg_sap__vbap": (1, "warn"),
        "accepted_values_stg_sap__vbap_currency": (1, "fail"),
        "accepted_values_fct_sales_order_items_currency": (1, "fail"),
        "not_null_stg_sap__vbrp_sales_order_id": (1, "fail"),
        "not_null_dim_material_material_description": (1, "fail"),
        "not_null_fct_sales_order_items_customer_key": (1, "fail"),
        "not_null_fct_delivery_items_sales_order_item_key": (1, "fail"),
    }


def test_declared_checks_are_complete(tables):
    generic = quality.generic_checks(tables)
    kinds = {k: sum(c.kind == k for c in generic) for k in ("unique", "relationships")}
    composite = sum(len(s.keys) > 1 for s in STAGING.values())
    assert kinds == {"unique": 13 + composite, "relationships": 13}
    passes = quality.table_passes(tables)
    assert sum(len(p.not_null) for p in passes) == 52
    assert sum(len(p.accepted) for p in passes) == 6
    assert len(quality.business_checks(tables)) + sum(len(p.rules) for p in passes) == 6
    assert len({c.name for c in generic}) == len(generic)


def test_lazy_tables_answer_sql(spark, tables):
    as_temp_views(tables)
    late = spark.sql("select d.city from fct_billing_items b join dim_customer d using (customer_key) where b.item_no = '10' and not b.is_cancelled")
    assert collected(late) == [("Peoria",)]


def test_analysis(tables):
    sales, billing = tables["fct_sales_order_items"], tables["fct_billing_items"]
    customers = tables["dim_customer"]
    month = D(2026, 1, 1)
    assert set(collected(analysis.ordered_value_by_month(sales, customers))) == {
        ("c1", "m1", month, Decimal("200.37"), 3), (None, "m1", month, None, 1),
    }
    assert collected(analysis.billed_value_by_month(billing, customers, include_orphans=False)) == [("c1", "m1", month, Decimal("146.00"), 2)]
    assert collected(analysis.billed_value_by_month(billing, customers)) == [("c1", "m1", month, Decimal("365.00"), 5)]
    assert pick(analysis.open_order_value(sales, billing), "currency", "n_items") == {"EUR": (1,), "CAD": (1,)}
    days = analysis.order_to_invoice_days(billing, sales).first()
    assert tuple(days) == (month, 2, 3.0, 3.0, 3, 3)
    shipped = analysis.shipped_against_ordered(sales, tables["fct_delivery_items"])
    assert {(r["sales_order_id"], r["item_no"]): (r["shipped_qty"], r["is_over_shipped"]) for r in shipped.collect()} == {
        ("o1", "10"): (Decimal("6.500"), True), ("o1", "20"): (Decimal("0.000"), False),
        ("o2", "10"): (Decimal("0.000"), False), ("o3", "10"): (Decimal("2.000"), False),
    }
    status = analysis.receivables_by_status(tables["fct_receivable_items"])
    assert pick(status, "status", "n_items", "avg_days_to_clear") == {"open": (1, None), "cleared": (2, 1.5)}


def clean_extracts(folder, days=("20260105", "20260106")):
    for n, day in enumerate(days):
        for table in RAW_COLUMNS:
            folder.rows(table, day)
        folder.rows("KNA1", day, {"KUNNR": "c1", "NAME1": "N", "ORT01": f"city {n}", "LAND1": "US", "ERDAT": days[0]})
        if n == 0:
            folder.rows("MARA", day, {"MATNR": "m1", "ERSDA": day, "LAEDA": "00000000"})
            folder.rows("MAKT", day, {"MATNR": "m1", "SPRAS": "E", "MAKTX": "Drill"})
            folder.rows("VBAK", day, order("o1"))
            folder.rows("VBAP", day, item("o1"))
        else:
            folder.rows("VBRK", day, {"VBELN": "b1", "FKDAT": day, "KUNRG": "c1", "WAERK": "USD", "NETWR": "100.00", "ERDAT": day, "AEDAT": "00000000"})
            folder.rows("VBRP", day, {"VBELN": "b1", "POSNR": "10", "AUBEL": "o9", "AUPOS": "10", "MATNR": "m1", "FKIMG": "5", "NETWR": "100.00", "ERDAT": day, "AEDAT": "00000000"})
            folder.rows("LIKP", day, {"VBELN": "d1", "LFDAT": day, "KUNNR": "c1", "ERDAT": day, "AEDAT": "00000000"})
            folder.rows("LIPS", day, {"VBELN": "d1", "POSNR": "10", "VGBEL": "o1", "VGPOS": "10", "MATNR": "m1", "LFIMG": "9", "ERDAT": day})
            folder.rows("BSID", day, {"BUKRS": "1", "BELNR": "1", "GJAHR": "2026", "BUZEI": "1", "KUNNR": "c1", "BUDAT": day, "FAEDT": day, "WRBTR": "100.00", "WAERS": "USD", "ZUONR": "b1"})


def test_build_all(spark, folder, tmp_path):
    clean_extracts(folder)
    out = str(tmp_path / "out")
    built = build_all(spark, str(folder), out)
    assert built.load.files_loaded == 22
    status = {r["check_name"]: r["status"] for r in built.checks}
    assert len(status) == 90 + sum(len(s.keys) > 1 for s in STAGING.values())
    assert {n for n, s in status.items() if s == "warn"} == {
        "shipped_qty_within_ordered_qty", "relationships_stg_sap__vbrp_sales_order_id__stg_sap__vbap",
    }
    assert "fail" not in status.values()
    assert current_tables(spark, out)["dim_customer"].count() == 2
    assert {o.status for o in built.outcomes} == {"built"} and len(built.outcomes) == 19
    views = publish(spark, out)
    assert {"raw.VBAK", "raw._load_log", "staging.stg_sap__vbak", "marts.dim_customer"} <= set(views)
    assert spark.sql("select count(*) from raw.VBAK").first()[0] == 1
    assert spark.sql("select sum(is_orphan_item::int) from marts.fct_billing_items").first()[0] == 1
    before = built.tables["fct_billing_items"].collect()
    again = build_all(spark, str(folder), out)
    assert again.load.files_skipped == 22
    assert again.tables["fct_billing_items"].collect() == before
    assert spark.sql("select count(*) from seeds.exchange_rates").first()[0] == 2
    build_all(spark, None, out)
    gone = remove_old_builds(spark, out)
    assert len(gone) == 19 and current_tables(spark, out)["fct_billing_items"].collect() == before


def test_failed_check_skips_only_what_depends_on_it(spark, folder, tmp_path):
    clean_extracts(folder)
    out = str(tmp_path / "out")
    first = build_all(spark, str(folder), out)
    sales = first.tables["fct_sales_order_items"].collect()
    folder.rows("VBAK", "20260107", order("o2", WAERK="EUR"))
    seen = []
    with pytest.raises(CheckFailed, match="accepted_values_stg_sap__vbak_currency"):
        build_all(spark, str(folder), out, on_finish=seen.append)
    status = {o.table_name: o.status for o in seen[0].outcomes}
    assert {n for n, s in status.items() if s != "built"} == {
        "stg_sap__vbak", "dim_date", "fct_sales_order_items", "fct_delivery_items",
    }
    assert status["stg_sap__vbak"] == "failed" and status["fct_sales_order_items"] == "skipped"
    assert "fct_sales_order_items" not in seen[0].tables and "fct_receivable_items" in seen[0].tables
    assert any(r["status"] == "fail" for r in seen[0].checks)
    # Readers still see what passed last.
    assert current_tables(spark, out)["fct_sales_order_items"].collect() == sales
    assert current_tables(spark, out)["stg_sap__vbak"].count() == 1
    whole = build_all(spark, None, out, stop_on_failure=False)
    assert "fct_delivery_items" in whole.tables and current_tables(spark, out)["stg_sap__vbak"].count() == 2


def test_a_rebuild_that_dies_leaves_the_old_table(spark, folder, tmp_path):
    """A plan that raises after its shuffle, as an unreadable value late in a mart would."""
    out = str(tmp_path / "out")
    bad = {"n": 0}

    def make(tables):
        counts = tables["start"].groupBy("k").count()
        late = F.when(F.col("count") * bad["n"] > 1, F.raise_error(F.lit("late"))).otherwise(F.col("k"))
        return counts.select(late.alias("k"), "count")

    models = {"five": Model("marts", ("start",), make), "more": Model("marts", ("five",), lambda t: t["five"])}
    start = {"start": spark.range(20).selectExpr("id % 5 as k")}
    build_models(spark, start, out, BuildResult(None), models=models)
    bad["n"] = 1
    result = build_models(spark, start, out, BuildResult(None), models=models)
    assert [(o.table_name, o.status) for o in result.outcomes] == [("five", "error"), ("more", "skipped")]
    assert "late" in result.problems()
    assert {n: t.count() for n, t in current_tables(spark, out).items()} == {"five": 5, "more": 5}


def test_declared_checks_raise_where_a_model_cannot_be_built(spark, tmp_path, monkeypatch):
    """Else the checks that are left look like all there are."""
    from pyspark.sql.types import DateType

    tables = {
        "orders": [(1, 1, "O", 5.0, dt.datetime(2026, 1, 1), "1-URGENT")],
        "lineitem": [(1, 1, 1, 1, 1.0, 5.0, 0.0, 0.0, "N", "O", dt.datetime(2026, 1, 2))],
        "part": [(1, "p", "b", "t", 1, 1.0)],
    }
    for name, rows in tables.items():
        spark.createDataFrame(rows, testbed.SCHEMAS[name]).write.parquet(f"{tmp_path}/{name}.parquet")
    whole = {r["check_name"] for r in registry.declared_checks(spark, str(tmp_path)).collect()}
    assert len(whole) == 90 + sum(len(s.keys) > 1 for s in STAGING.values())
    late = F.raise_error(F.lit("disk full")).cast(DateType())
    calendar = build.MODELS["dim_date"].make
    broken = Model("marts", build.MODELS["dim_date"].parents, lambda t: calendar(t).withColumn("date_day", late))
    monkeypatch.setitem(build.MODELS, "dim_date", broken)
    with pytest.raises(CheckFailed, match="dim_date: .*disk full") as raised:
        registry.declared_checks(spark, str(tmp_path))
    assert "disk full" in str(raised.value.__cause__)
    assert ("dim_date", "marts", "error") in [tuple(r) for r in registry.build_report(spark, str(tmp_path)).collect()]


def test_seed_from_file(spark, tmp_path):
    path = tmp_path / "rates.csv"
    path.write_text("currency,rate_to_usd\nUSD,1.00\nEUR,1.1\n")
    assert collected(exchange_rates(spark, str(path)), "currency") == [("EUR", Decimal("1.100000")), ("USD", Decimal("1.000000"))]


def test_models_shuffle_into_enough_partitions(spark, tmp_path, monkeypatch):
    """Whoever calls `build_models`: one partition per 64 MB of the largest table it starts with."""
    before, seen = spark.conf.get(INITIAL_PARTITIONS, None), []
    monkeypatch.setattr(build, "estimated_bytes", lambda df: 1 << 40)
    make = lambda t: seen.append(spark.conf.get(INITIAL_PARTITIONS, None)) or t["raw.ONE"]
    models = {"copy": Model("staging", ("raw.ONE",), make)}
    build_models(spark, {"raw.ONE": spark.range(3).toDF("id")}, str(tmp_path), BuildResult(None), models=models)
    assert seen == [str(1 << 14)] and spark.conf.get(INITIAL_PARTITIONS, None) == before
