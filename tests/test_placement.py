"""Tables in buckets of their document: no shuffle where rows lie already, and the same rows."""

import re

import duckdb
import pytest
from conftest import SF_DIR, collected, plan_of
from pyspark.sql import functions as F

from cashline.operators.buckets import write_buckets
from cashline.operators.joins import lookup, mark_missing, with_header
from cashline.operators.placement import placed_join, read_placed, write_placed
from cashline.plans import marts
from cashline.plans.build import MODELS, PLACED, BuildResult, Model, build_models, current_tables
from cashline.plans.registry import StarSchema

N = 4


@pytest.fixture(scope="module")
def apart(spark):
    """No side but a handful of rates is small enough to broadcast."""
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for name in names:
        spark.conf.set(name, "1k")
    yield spark
    for name in names:
        spark.conf.unset(name)


@pytest.fixture(scope="module")
def stored(apart, tmp_path_factory):
    """The document tables of the smallest test tables, written in buckets."""
    folder, star = tmp_path_factory.mktemp("placed"), StarSchema(apart, SF_DIR)
    frames = {name: star.stg(name.removeprefix("stg_sap__")) for name in PLACED if name.startswith("stg_")}
    frames["fct_sales_order_items"] = star.sales
    return star, {name: write_placed(df, f"{folder}/{name}", PLACED[name], N) for name, df in frames.items()}


def exchanges(df):
    return re.findall(r"Exchange hashpartitioning\(([a-z_]+)", plan_of(df))


def facts(star, stored, customers, n_buckets):
    stg = {name.removeprefix("stg_sap__"): df for name, df in stored.items()}
    options = {"n_buckets": n_buckets}
    return {
        "sales": marts.fct_sales_order_items(stg["vbap"], stg["vbak"], customers, star.rates, **options),
        "billing": marts.fct_billing_items(stg["vbrp"], stg["vbrk"], stg["vbap"], customers, star.rates, **options),
        "deliveries": marts.fct_delivery_items(
            stg["lips"], stg["likp"], stored["fct_sales_order_items"], customers, **options
        ),
    }


def test_documents_meet_without_shuffles(stored):
    star, tables = stored
    placed, moved = facts(star, tables, None, N), facts(star, tables, None, None)
    assert exchanges(placed["sales"]) == [] and len(exchanges(moved["sales"])) == 2
    # Items go to their orders; neither headers, items on their way to headers, nor orders move.
    for name in ("billing", "deliveries"):
        assert exchanges(placed[name]) == ["__place"] and len(exchanges(moved[name])) == 4
    receivables = marts.fct_receivable_items(tables["stg_sap__bsid"], tables["stg_sap__bsad"], star.customers, star.rates, n_buckets=N)
    assert "accounting_doc_id" not in exchanges(receivables)


def test_with_customers_only_headers_move(stored):
    star, tables = stored
    keys = exchanges(facts(star, tables, star.customers, N)["sales"])
    assert keys.count("__header") == 1 and "sales_order_id" not in keys


@pytest.mark.parametrize("name", ["sales", "billing", "deliveries"])
def test_the_rows_are_those_of_shuffled_joins(stored, name):
    star, tables = stored
    placed, moved = (facts(star, tables, None, n)[name] for n in (N, None))
    assert placed.columns == moved.columns
    assert placed.exceptAll(moved).isEmpty() and moved.exceptAll(placed).isEmpty()
    assert placed.count() == moved.count() > 0


def test_rows_without_a_key_are_spread(apart, tmp_path):
    orders = apart.range(100).select(F.format_string("%05d", "id").alias("o"), F.lit(1).alias("i"))
    orders = write_placed(orders, f"{tmp_path}/orders", "o", N)
    items = apart.range(4000).select("id", F.when(F.col("id") % 4 == 0, F.format_string("%05d", F.col("id") % 200)).alias("k"), F.lit(1).alias("i"))
    joined = placed_join(items, orders.withColumnRenamed("i", "j"), [("k", "o"), ("i", "j")], "left", N, spread=True)
    assert joined.columns == ["id", "k", "i", "o", "j"]
    sizes = [n for _, n in collected(joined.filter("k is null").groupBy(F.spark_partition_id().alias("p")).agg(F.count("*")))]
    assert len(sizes) == N and max(sizes) < 1.3 * 3000 / N
    marked = {n: mark_missing(items, orders, {"k": "o", "i": "i"}, "gone", unique=True, n_buckets=n) for n in (N, None)}
    assert sorted(collected(marked[N])) == sorted(collected(marked[None])) and marked[N].filter("gone").count() == 3500


def test_keys_that_look_like_a_spread_row_find_nothing(apart):
    items = apart.createDataFrame([(None,)], "k string")
    lost = items.select(F.concat(F.lit("\0"), F.xxhash64("k").cast("string")).alias("o"), F.lit("found").alias("v"))
    assert collected(lookup(items, lost, {"k": "o"}, ["v"], n_buckets=N, spread=True)) == [(None, None)]


def test_ties_nulls_and_tables_without_rows(apart, tmp_path):
    headers = apart.createDataFrame([("a", 1), ("b", 2), (None, 3)], "d string, h int")
    items = apart.createDataFrame([("a", 1), ("a", 1), (None, 2), ("c", 3)], "d string, i int")
    for number, (left, right, rows) in enumerate([(items, headers, 2), (items.limit(0), headers, 0), (items, headers.limit(0), 0)]):
        left = write_placed(left, f"{tmp_path}/left {number}", "d", N)
        right = write_placed(right, f"{tmp_path}/right'{number}", "d", N)
        joined = with_header(left, right, "d", ["h"], n_buckets=N)
        assert joined.count() == rows and joined.columns == ["d", "i", "h"] and exchanges(joined) == []


def test_another_session_reads_the_buckets_and_no_table_is_left(apart, tmp_path):
    rows = apart.range(1000).select(F.format_string("%04d", F.col("id") % 300).alias("d"), "id")
    write_placed(rows, f"{tmp_path}/it's", "d", N)
    other = apart.newSession()
    other.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    again = read_placed(other, f"{tmp_path}/it's", rows.schema, "d", N)
    counted = again.groupBy("d").count()
    assert exchanges(counted) == [] and counted.count() == 300
    assert apart.read.parquet(f"{tmp_path}/it's").count() == 1000
    assert not [t for t in apart.catalog.listTables() if t.name.startswith("placed_")]


def test_builds_in_buckets_read_alike(apart, tmp_path):
    star = StarSchema(apart, SF_DIR)
    start = {f"raw.{t}": star.raw(t).filter("MANDT is not null" if t != "VBAP" else "false") for t in ("VBAK", "VBAP", "KNA1")}
    models = {n: MODELS[n] for n in ("stg_sap__vbak", "stg_sap__vbap", "dim_customer", "fct_sales_order_items")}
    start |= {"exchange_rates": star.rates}
    built = build_models(apart, start, str(tmp_path), BuildResult(None), models=models, stop_on_failure=False, document_buckets=N)
    assert not [o for o in built.outcomes if o.status == "error"], built.outcomes
    read = current_tables(apart, str(tmp_path))
    assert read["fct_sales_order_items"].schema.names == star.sales.columns and read["fct_sales_order_items"].count() == 0
    assert read["stg_sap__vbak"].count() == star.stg("vbak").count()


def test_stored_tables_need_half_the_bytes_for_hashed_keys(apart, tmp_path):
    rows = apart.range(20_000).select(F.md5(F.col("id").cast("string")).alias("d"), "id")
    write_placed(rows, f"{tmp_path}/placed", "d", N)
    write_buckets(rows, ["d"], N, f"{tmp_path}/buckets")
    build_models(apart, {"hashes": rows}, f"{tmp_path}/out", BuildResult(None), models={"t": Model("marts", ("hashes",), lambda t: t["hashes"])})
    for folder in ("placed/*.parquet", "buckets/*/*.parquet", "out/marts/t/*/*.parquet"):
        found = duckdb.sql(
            f"select sum(total_compressed_size) from parquet_metadata('{tmp_path}/{folder}') where path_in_schema = 'd'"
        )
        assert found.fetchall()[0][0] < 20_000 * 24
