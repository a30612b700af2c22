"""Plans as they would be for data too large to broadcast."""

import re

import pytest
from pyspark.sql import functions as F

from cashline.functions import OPEN_END
from cashline.operators.buckets import BUCKET, deal
from cashline.operators.joins import (
    broadcast_if_small,
    broadcast_limit,
    lookup,
    mark_missing,
    point_in_time,
    with_header,
)
from cashline.operators.checks import SharedKeys, run_checks, share_keys
from cashline.operators.versions import latest_version
from cashline.plans import analysis, marts, quality, testbed
from cashline.plans.build import MODELS, SEED
from cashline.plans.registry import StarSchema, all_queries, latest_lines
from cashline.plans.staging import STAGING
from cashline.session import INITIAL_PARTITIONS, sized_shuffles
from cashline.sources.seeds import exchange_rates
from conftest import SF_DIR, plan_of


@pytest.fixture
def large(spark):
    """No side but a handful of rates counts as small enough to broadcast, as at full scale."""
    names = ["spark.sql.autoBroadcastJoinThreshold", "spark.sql.adaptive.autoBroadcastJoinThreshold"]
    for name in names:
        spark.conf.set(name, "1k")
    yield spark
    for name in names:
        spark.conf.unset(name)


# These load or build when they are asked for; what they return is a table read again.
RUN_AT_ONCE = """loaded_customers loaded_reordered streamed_customers load_log_rows load_counts rejected_files
    rebuilt_mart declared_checks build_report published_view refreshed_orders spliced_customers refreshed_sales_items
    refreshed_billing_items refreshed_delivery_items refreshed_receivable_items placed_sales_items placed_billing_items
    placed_delivery_items placed_receivable_items""".split()


@pytest.mark.parametrize("name", [name for name in all_queries() if name not in RUN_AT_ONCE])
def test_no_cartesian_or_python_step(large, name):
    plan = plan_of(all_queries()[name](large, SF_DIR))
    for step in ("CartesianProduct", "BroadcastNestedLoopJoin", "BatchEvalPython", "ArrowEvalPython", "MapInPandas"):
        assert step not in plan
    # One task only where one row is all there is: the bounds of a calendar, a check's total.
    for match in re.finditer(r"Exchange SinglePartition[^\n]*\n([^\n]*)", plan):
        assert "partial_" in match.group(1) and "keys=[]" in match.group(1)


@pytest.mark.parametrize("name", list(STAGING))
def test_staging_reduces_before_its_only_shuffle(large, name):
    plan = plan_of(StarSchema(large, SF_DIR).stg(name.removeprefix("stg_sap__")))
    assert plan.count("Exchange") == 1
    assert plan.index("Exchange") < plan.index("row_number(), 1, Partial")


def test_scans_read_only_needed_columns(large):
    plan = plan_of(latest_lines(large, SF_DIR).select("l_orderkey", "l_linenumber", "l_quantity"))
    scan = next(line for line in plan.splitlines() if "FileScan" in line)
    assert "l_quantity" in scan and "l_tax" not in scan and "l_returnflag" not in scan
    open_orders = testbed.table(large, SF_DIR, "orders").filter("o_orderstatus = 'O'").select("o_orderkey")
    assert "EqualTo(o_orderstatus,O)" in plan_of(open_orders)


def test_facts_shuffle_items_once(large):
    """Header and item meet on the document number; the version lookup moves headers only."""
    sales = StarSchema(large, SF_DIR).sales
    plan = plan_of(sales)
    joins = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    assert len(joins) == 2  # header and version; rates are broadcast
    assert plan.count("BroadcastHashJoin") == 1
    assert sum("__in_force" in line or "__id" in line for line in joins) == 1


def test_shuffles_start_with_enough_partitions(spark):
    before = spark.conf.get(INITIAL_PARTITIONS, None)
    for size, more, expected in (
        (10, {}, before),
        (1 << 40, {}, str(1 << 14)),
        (1 << 60, {"most": 100_000}, "100000"),
        (1 << 30, {"partition_bytes": 1 << 20}, "1024"),
    ):
        with sized_shuffles(spark, size, **more):
            assert spark.conf.get(INITIAL_PARTITIONS, None) == expected
        assert spark.conf.get(INITIAL_PARTITIONS, None) == before


def test_broadcast_needs_a_small_size(spark):
    rates = exchange_rates(spark)
    assert "ResolvedHint" in broadcast_if_small(rates)._jdf.queryExecution().analyzed().toString()
    name = "spark.sql.autoBroadcastJoinThreshold"
    for limit, size in (("-1", -1), ("1", 1), ("1b", 1), ("2k", 2048), ("10MB", 10 << 20)):
        spark.conf.set(name, limit)
        try:
            assert broadcast_limit(spark) == size
            hinted = "ResolvedHint" in broadcast_if_small(rates)._jdf.queryExecution().analyzed().toString()
            assert hinted == (size > 1)
        finally:
            spark.conf.unset(name)


def test_skewed_join_keys_are_split(spark):
    """A third of all rows under one key: the join splits that partition at run time."""
    settings = {
        "spark.sql.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.autoBroadcastJoinThreshold": "-1",
        "spark.sql.adaptive.skewJoin.skewedPartitionThresholdInBytes": "20kb",
        "spark.sql.adaptive.advisoryPartitionSizeInBytes": "10kb",
        "spark.sql.adaptive.skewJoin.skewedPartitionFactor": "2",
        "spark.sql.shuffle.partitions": "16",
    }
    saved = {k: spark.conf.get(k, None) for k in settings}
    for key, value in settings.items():
        spark.conf.set(key, value)
    try:
        items = spark.range(0, 60000, 1, 8).select(
            F.when(F.col("id") % 3 == 0, F.lit("hot")).otherwise(F.concat(F.lit("k"), F.col("id") % 500)).alias("k"),
            F.sha2(F.col("id").cast("string"), 256).alias("payload"),
        )
        headers = spark.range(500).select(F.concat(F.lit("k"), "id").alias("k"), F.col("id").alias("h"))
        headers = headers.union(spark.sql("select 'hot', 1L"))
        dated = items.withColumn("day", F.lit("2026-01-02").cast("date"))
        versions = headers.withColumn("valid_from", F.lit("2026-01-01").cast("date"))
        versions = latest_version(versions, ["k"], ["h"]).withColumn("valid_to", F.lit(OPEN_END))
        asked = dict(key="k", on_date="day", version_id="k", columns=["h"])
        joins = {
            "header": with_header(items, headers, "k", ["h"]),
            "orphan": mark_missing(items, headers.filter("h < 250"), {"k": "k"}, "gone"),
            "lookup": lookup(items, latest_version(headers, ["k"], ["h"]), {"k": "k"}, ["h"]),
            "range": point_in_time(dated, versions, strategy="range", **asked),
            "as_of": point_in_time(dated, versions, strategy="as_of", **asked),
        }
        for name, df in joins.items():
            assert len(df.collect()) == 60000, name
            assert "isSkew=true" in plan_of(df) or "skew=true" in plan_of(df), (name, plan_of(df))
    finally:
        for key, value in saved.items():
            spark.conf.unset(key) if value is None else spark.conf.set(key, value)


def test_checks_scan_each_table_few_times(spark, tmp_path):
    """One pass per table, its unique keys and its relationships: no scan per column."""
    star = StarSchema(spark, SF_DIR)
    frames = {name: star.stg(name.removeprefix("stg_sap__")) for name in STAGING}
    frames |= {"dim_customer": star.customers, "dim_material": star.materials, "dim_date": star.dates}
    frames |= {"fct_sales_order_items": star.sales, "fct_billing_items": star.billing}
    frames |= {"fct_delivery_items": star.deliveries, "fct_receivable_items": star.receivables, SEED: star.rates}
    assert set(frames) == {*MODELS, SEED}
    stored = {}
    for name, df in frames.items():
        spark.createDataFrame([], df.schema).write.parquet(f"{tmp_path}/{name}")
        stored[name] = spark.read.parquet(f"{tmp_path}/{name}")
    plan = plan_of(quality.check_tables(spark, stored))
    # 19 tables once each, 13 unique keys and 6 composite ones, both sides of 13 relationships, and the
    # joins of 4 rules over two tables.
    scans = plan.count("FileScan parquet")
    assert len(quality.table_passes(stored)) == len(stored) + 1
    assert len(STAGING) < scans <= 19 + 13 + 6 + 2 * 13 + 2 + 2 + 2 + 1


def test_checks_of_one_key_share_their_shuffle(large, tmp_path):
    star = StarSchema(large, SF_DIR)
    frames = {name: star.stg(name.removeprefix("stg_sap__")) for name in STAGING}
    frames |= {"dim_customer": star.customers, "dim_material": star.materials, "fct_sales_order_items": star.sales}
    frames |= {"fct_billing_items": star.billing, "fct_delivery_items": star.deliveries, "fct_receivable_items": star.receivables}
    for name, df in frames.items():
        large.createDataFrame([], df.schema).write.parquet(f"{tmp_path}/{name}")
        frames[name] = large.read.parquet(f"{tmp_path}/{name}")
    checks = quality.generic_checks(frames)
    shared = share_keys(checks, quality.parent_keys(frames))
    assert sum(len(s.children) for s in shared if isinstance(s, SharedKeys)) == 13
    apart, together = (plan_of(run_checks(large, c)).count("Exchange hashpartitioning") for c in (checks, shared))
    keys = len({c.key.parent for c in checks if c.key})
    assert together == keys + sum(c.key is None for c in checks) and 2 * together <= apart


def test_shipped_against_ordered_plans_the_order_fact_once(large):
    plan = plan_of(all_queries()["shipped_vs_ordered"](large, SF_DIR))
    assert plan.count("FileScan parquet") == 4 and plan.count("Exchange hashpartitioning") <= 11


def test_questions_without_lookups_shuffle_half_as_often(large):
    star = StarSchema(large, SF_DIR)
    whole = plan_of(analysis.shipped_against_ordered(star.sales, star.deliveries))
    narrow = plan_of(all_queries()["shipped_vs_ordered"](large, SF_DIR))
    assert 2 * narrow.count("Exchange hashpartitioning") <= whole.count("Exchange hashpartitioning")


def test_lines_move_for_their_order_only(large):
    """Currency and version are looked up by the order, before its lines join: lines move to be ranked and to meet it."""
    plan = plan_of(all_queries()["fct_items"](large, SF_DIR))
    joins = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    assert len(joins) == 3 and "l_orderkey" in joins[0] and sum("l_orderkey" in line for line in joins) == 1


def test_staging_carries_no_hash_of_its_keys(large):
    plan = plan_of(StarSchema(large, SF_DIR).stg("vbap"))
    exchange = next(line for line in plan.splitlines() if "Exchange" in line)
    assert "hashpartitioning(sales_order_id" in exchange and "_w" not in exchange


def test_deliveries_make_the_key_of_their_order_item(large):
    """A hash per row is not moved where it can be made of what the row has."""
    plan = plan_of(StarSchema(large, SF_DIR).deliveries)
    assert sum("sales_order_item_key" in line for line in plan.splitlines()) == 1


@pytest.mark.parametrize("fact", ["sales", "billing", "deliveries", "receivables"])
def test_keys_of_customer_versions_are_not_moved(large, fact):
    """They are made of customer and start at the end of a fact, after its last join."""
    plan = plan_of(getattr(StarSchema(large, SF_DIR), fact))
    assert sum("customer_key" in line for line in plan.splitlines()) == 1


def test_rows_leave_a_join_in_the_order_of_its_key(large):
    plan = plan_of(StarSchema(large, SF_DIR).billing)
    sorts = [line for line in plan.splitlines() if "Sort [" in line and "xxhash64(" in line]
    assert sorts and not any("Sort [xxhash64(" in line for line in sorts)


def test_values_by_month_make_history_once_and_sum_once(large):
    star = StarSchema(large, SF_DIR)
    value = analysis.billed_value_by_month(star.billing, star.customers, include_orphans=False)
    value.collect()  # AQE finds the shuffles that are alike as it runs
    plan = plan_of(value)
    final = plan[: plan.index("Initial Plan")] if "Initial Plan" in plan else plan
    assert final.count("ReusedExchange") >= 1
    initial = plan_of(analysis.billed_value_by_month(star.billing, star.customers, include_orphans=False))
    assert len(re.findall(r"HashAggregate\(keys=\[customer_", initial)) == 2  # partial and final


@pytest.mark.parametrize("fact, document", [("billing", "billing_id"), ("deliveries", "delivery_id")])
def test_items_meet_their_header_last(large, fact, document):
    """It adds the most columns, which the shuffle for the order item then does not move."""
    plan = plan_of(getattr(StarSchema(large, SF_DIR), fact))
    joins = [line for line in plan.splitlines() if "SortMergeJoin" in line]
    assert document in joins[0] and "sales_order_id" in joins[1]


def test_rows_are_dealt_to_buckets_before_their_keys_are_made(large):
    star = StarSchema(large, SF_DIR)
    dealt = lambda rows: deal(rows, ["sales_order_id"], 4)
    sales = marts.fct_sales_order_items(star.stg("vbap"), star.stg("vbak"), star.customers, star.rates, deal=dealt)
    assert sales.columns == [*star.sales.columns, BUCKET]
    made, moved = plan_of(sales).split("REBALANCE_PARTITIONS_BY_COL")
    assert made.count("md5(") == 2 and "md5(" not in moved
