"""Every operator and model as a query over the shared test tables.

The order-to-cash models run on text extracts projected from these tables (see `testbed`); the
generic operators run on the tables directly. All queries read whole tables.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence
from functools import cached_property, reduce
from uuid import uuid4

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cashline.functions import (
    date_from_file_name,
    days_between,
    flag_set,
    sap_amount,
    sap_date,
    sap_quantity,
    sap_text,
    surrogate_key,
    to_reporting_currency,
)
from cashline.operators.calendar import date_bounds, date_dimension
from cashline.operators.checks import (
    WARN,
    Check,
    Pass,
    duplicate_values,
    missing_parents,
    overlapping_versions,
    run_checks,
    unaccepted_values,
)
from cashline.operators.joins import lookup, mark_missing, point_in_time, with_header
from cashline.operators.versions import (
    attribute_changes,
    latest_version,
    latest_version_by_max,
    one_per_day,
    scd2,
)
from cashline.plans import analysis, marts, quality, testbed
from cashline.plans.build import MODELS, BuildResult, build_models, current_tables, sources
from cashline.plans.publish import publish
from cashline.plans.refresh import needed_for, refresh_tables
from cashline.plans.staging import STAGING, clean_bad_dates, stage
from cashline.plans.testbed import pad, table
from cashline.schema import RAW_COLUMNS
from cashline.session import shared_folder
from cashline.sources.extracts import LoadError, discover
from cashline.sources.raw import load_extracts, load_log, not_yet_loaded, raw_table
from cashline.sources.seeds import exchange_rates
from cashline.storage import move_files, write_text
from cashline.streaming.ingest import stream_extracts

Query = Callable[[SparkSession, str], DataFrame]
LINE_KEY = ["l_orderkey", "l_linenumber"]
LINE_ORDER = ["l_shipdate", "l_partkey", "l_suppkey"]


class StarSchema:
    """The models over one folder of test tables; each is planned only when asked for."""

    def __init__(self, spark: SparkSession, sf_dir: str):
        self.spark, self.sf_dir = spark, sf_dir

    def raw(self, name: str) -> DataFrame:
        return testbed.RAW_VIEWS[name](self.spark, self.sf_dir)

    def stg(self, name: str) -> DataFrame:
        full = f"stg_sap__{name}"
        return stage(self.raw(STAGING[full].raw), full)

    @cached_property
    def rates(self) -> DataFrame:
        return exchange_rates(self.spark)

    @cached_property
    def customers(self) -> DataFrame:
        return marts.dim_customer(self.raw("KNA1"))

    @cached_property
    def materials(self) -> DataFrame:
        return marts.dim_material(self.stg("mara"), self.stg("makt"))

    @cached_property
    def dates(self) -> DataFrame:
        return marts.dim_date(self.stg("vbak"), self.stg("vbrk"))

    @cached_property
    def sales(self) -> DataFrame:
        return marts.fct_sales_order_items(
            self.stg("vbap"), self.stg("vbak"), self.customers, self.rates
        )

    @cached_property
    def sales_alone(self) -> DataFrame:
        """Order items without customer versions."""
        return marts.fct_sales_order_items(self.stg("vbap"), self.stg("vbak"), None, self.rates)

    @cached_property
    def billing_alone(self) -> DataFrame:
        """Billing items without customer versions, values in USD and the orphan mark."""
        return marts.fct_billing_items(self.stg("vbrp"), self.stg("vbrk"), None, None, None)

    @cached_property
    def deliveries_alone(self) -> DataFrame:
        """Delivery items without customer versions and without what they look up in order items."""
        return marts.fct_delivery_items(self.stg("lips"), self.stg("likp"), None, None)

    @cached_property
    def billing(self) -> DataFrame:
        return marts.fct_billing_items(
            self.stg("vbrp"), self.stg("vbrk"), self.stg("vbap"), self.customers, self.rates
        )

    @cached_property
    def deliveries(self) -> DataFrame:
        return marts.fct_delivery_items(
            self.stg("lips"), self.stg("likp"), self.sales, self.customers
        )

    @cached_property
    def receivables(self) -> DataFrame:
        return marts.fct_receivable_items(
            self.stg("bsid"), self.stg("bsad"), self.customers, self.rates
        )


def star(build: Callable[[StarSchema], DataFrame]) -> Query:
    return lambda spark, sf_dir: build(StarSchema(spark, sf_dir))


# ---- Cleaning -------------------------------------------------------------------------------


def clean_text(spark: SparkSession, sf_dir: str) -> DataFrame:
    flag = F.col("l_returnflag")
    dirty = F.when(flag == "N", "  ").when(flag == "A", " A ").otherwise("")
    return (
        table(spark, sf_dir, "lineitem")
        .select(*LINE_KEY, *LINE_ORDER, dirty.alias("dirty"), flag.alias("mark"))
        .select(
            "l_orderkey",
            "l_linenumber",
            "l_partkey",
            sap_text("dirty").alias("cleaned"),
            flag_set("mark", "R").alias("is_returned"),
        )
    )


def clean_date_amount_qty(spark: SparkSession, sf_dir: str) -> DataFrame:
    texts = table(spark, sf_dir, "orders").select(
        pad("o_orderkey", 10).alias("order_id"),
        F.when(F.col("o_orderpriority") == "5-LOW", "00000000")
        .when(F.col("o_orderpriority") == "2-HIGH", " ")
        .otherwise(testbed.day_text(testbed.order_day()))
        .alias("date_text"),
        F.when(F.col("o_orderkey") % 11 == 0, "100.00-")
        .otherwise(F.concat(F.lit(" "), testbed.amount_text("o_totalprice")))
        .alias("amount_text"),
        F.when(F.col("o_orderkey") % 7 == 0, "abc")
        .otherwise((F.col("o_custkey") % 50).cast("string"))
        .alias("quantity_text"),
    )
    return texts.select(
        "order_id",
        sap_date("date_text").alias("order_date"),
        sap_amount("amount_text").alias("amount"),
        sap_quantity("quantity_text").alias("quantity"),
    )


def file_name_date(spark: SparkSession, sf_dir: str) -> DataFrame:
    name = testbed.file_name("VBAK", testbed.order_day())
    return table(spark, sf_dir, "orders").select(
        "o_orderkey", name.alias("file_name"), date_from_file_name(name).alias("file_date")
    )


def bad_dates(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Raw orders with unreadable dates planted in, found before staging would stop at them."""
    order = F.col("VBELN").cast("bigint")
    planted = testbed.vbak(spark, sf_dir).withColumn(
        "AUDAT", F.when(order % 500 == 3, "20261340").when(order % 500 == 4, "soon").otherwise(F.col("AUDAT"))
    )
    return clean_bad_dates(planted, "stg_sap__vbak").select("VBELN", "AUDAT", "AEDAT")


# ---- Versions -------------------------------------------------------------------------------


def latest_lines(spark: SparkSession, sf_dir: str) -> DataFrame:
    newest_first = [F.desc(c) for c in LINE_ORDER]
    return latest_version(table(spark, sf_dir, "lineitem"), LINE_KEY, newest_first)


def latest_by_change(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_lines(spark, sf_dir).select(
        *LINE_KEY, *LINE_ORDER, "l_returnflag", F.col("l_quantity").cast("decimal(18,3)").alias("quantity")
    )


def latest_max_by(spark: SparkSession, sf_dir: str) -> DataFrame:
    lines = table(spark, sf_dir, "lineitem").select(
        *LINE_KEY, *LINE_ORDER, F.col("l_quantity").cast("decimal(18,3)").alias("quantity")
    )
    return latest_version_by_max(lines, LINE_KEY, LINE_ORDER)


def latest_by_load(spark: SparkSession, sf_dir: str) -> DataFrame:
    return latest_version(
        table(spark, sf_dir, "events"),
        ["user_id", "event_type"],
        [F.desc("ts"), F.desc("event_id")],
    ).select("user_id", "event_type", "ts", "event_id")


def daily_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return table(spark, sf_dir, "events").withColumn("day", F.col("ts").cast("date"))


def events_one_per_day(spark: SparkSession, sf_dir: str) -> DataFrame:
    return one_per_day(
        daily_events(spark, sf_dir),
        key="user_id",
        day="day",
        order_by=[F.desc("ts"), F.desc("event_id")],
    ).select("user_id", "day", "event_type", "event_id")


def events_attribute_changes(spark: SparkSession, sf_dir: str) -> DataFrame:
    daily = events_one_per_day(spark, sf_dir)
    return attribute_changes(daily, key="user_id", day="day", attributes=["event_type"])


def scd2_events(spark: SparkSession, sf_dir: str) -> DataFrame:
    return scd2(
        daily_events(spark, sf_dir),
        key="user_id",
        attributes=["event_type"],
        valid_from="day",
        order_by=[F.desc("ts"), F.desc("event_id")],
    ).withColumnRenamed("day", "valid_from")


def scd2_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    history = table(spark, sf_dir, "orders").withColumn("valid_from", testbed.order_day())
    return scd2(
        history,
        key="o_custkey",
        attributes=["o_orderpriority"],
        order_by=[F.desc("o_orderkey")],
    )


# ---- Joins ----------------------------------------------------------------------------------


def inner_header_item(spark: SparkSession, sf_dir: str) -> DataFrame:
    headers = table(spark, sf_dir, "orders").withColumnRenamed("o_orderkey", "l_orderkey")
    items = table(spark, sf_dir, "lineitem").select(*LINE_KEY, "l_partkey", "l_suppkey")
    return with_header(items, headers, "l_orderkey", ["o_custkey", "o_orderstatus"])


def _events_in_time(strategy: str) -> Query:
    """Events with the version of their user on the day before."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        events = daily_events(spark, sf_dir).select(
            "event_id", "user_id", F.date_add("day", -1).alias("day_before")
        )
        return point_in_time(
            events,
            scd2_events(spark, sf_dir),
            key="user_id",
            on_date="day_before",
            version_id="user_id",
            columns=["version_key"],
            strategy=strategy,
            disjoint=True,
        ).select("event_id", "user_id", "day_before", "version_key")

    return query


def _orders_in_overlapping_time(strategy: str) -> Query:
    """Orders with all versions of their customer that hold their date, periods running 30 days too long."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        versions = scd2_orders(spark, sf_dir).select(
            F.col("o_custkey").alias("id"),
            "version_key",
            "valid_from",
            F.when(F.col("is_current"), F.col("valid_to")).otherwise(F.date_add("valid_to", 30)).alias("valid_to"),
        )
        orders = table(spark, sf_dir, "orders").select("o_orderkey", "o_custkey", testbed.order_day().alias("day"))
        return point_in_time(
            orders,
            versions,
            key="o_custkey",
            on_date="day",
            version_id="id",
            columns=["version_key"],
            strategy=strategy,
        )

    return query


def _in_usd(spark: SparkSession, sf_dir: str, currency_of_nation: Column) -> DataFrame:
    customers = table(spark, sf_dir, "customer").select(
        F.col("c_custkey").alias("o_custkey"), currency_of_nation.alias("currency")
    )
    orders = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_custkey", F.col("o_totalprice").cast("decimal(18,2)").alias("value")
    )
    priced = orders.join(customers, "o_custkey", "inner")
    rated = lookup(
        priced, exchange_rates(spark), {"currency": "currency"}, ["rate_to_usd"], small=True
    )
    return rated.select(
        "o_orderkey",
        "currency",
        to_reporting_currency("value", "rate_to_usd").alias("value_usd"),
    )


def usd_value(spark: SparkSession, sf_dir: str) -> DataFrame:
    return _in_usd(
        spark, sf_dir, F.when(F.col("c_nationkey") % 2 == 0, "USD").otherwise("CAD")
    )


def usd_missing_rate(spark: SparkSession, sf_dir: str) -> DataFrame:
    nation = F.col("c_nationkey")
    return _in_usd(
        spark, sf_dir, F.when(nation % 3 == 0, "USD").when(nation % 3 == 1, "CAD").otherwise("EUR")
    )


def lines_with_orphans(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All lines; those of every seventh supplier name an order that does not exist."""
    broken = F.when(F.col("l_suppkey") % 7 == 0, -F.col("l_orderkey")).otherwise(F.col("l_orderkey"))
    return table(spark, sf_dir, "lineitem").withColumn("l_orderkey", broken)


def orphan_flag(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = lines_with_orphans(spark, sf_dir).select(*LINE_KEY, "l_partkey", "l_suppkey")
    return mark_missing(items, table(spark, sf_dir, "orders"), {"l_orderkey": "o_orderkey"}, "is_orphan")


def left_const_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    suppliers = table(spark, sf_dir, "supplier").filter(F.col("s_nationkey") == 3)
    parts = table(spark, sf_dir, "part").select("p_partkey", "p_name")
    return lookup(parts, suppliers, {"p_partkey": "s_suppkey"}, ["s_name"])


def open_vs_cleared(spark: SparkSession, sf_dir: str) -> DataFrame:
    posted = table(spark, sf_dir, "orders").select(
        "o_orderkey", "o_orderstatus", testbed.order_day().alias("posting_date")
    )
    cleared = (
        table(spark, sf_dir, "lineitem")
        .groupBy("l_orderkey")
        .agg(F.min(testbed.ship_day()).alias("cleared_on"))
    )
    finished = posted.filter(F.col("o_orderstatus") == "F").select(F.col("o_orderkey").alias("l_orderkey"))
    cleared = cleared.join(finished, "l_orderkey", "left_semi")
    items = lookup(posted, cleared, {"o_orderkey": "l_orderkey"}, ["cleared_on"])
    return items.select(
        "o_orderkey",
        "cleared_on",
        F.col("cleared_on").isNotNull().alias("is_cleared"),
        F.when(F.col("cleared_on").isNull(), "open").otherwise("cleared").alias("status"),
        days_between("cleared_on", "posting_date").alias("days_to_clear"),
    )


def delivery_lag(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select("o_orderkey", testbed.order_day().alias("order_date"))
    items = table(spark, sf_dir, "lineitem").select(
        *LINE_KEY, "l_partkey", "l_suppkey", testbed.ship_day().alias("ship_date")
    )
    return lookup(items, orders, {"l_orderkey": "o_orderkey"}, ["order_date"]).select(
        *LINE_KEY,
        "l_partkey",
        "l_suppkey",
        "order_date",
        days_between("ship_date", "order_date").alias("days_to_ship"),
    )


def order_calendar(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders").select(testbed.order_day().alias("day"))
    shipped = table(spark, sf_dir, "lineitem").select(testbed.ship_day().alias("day"))
    return date_dimension(date_bounds([(orders, "day"), (shipped, "day")]))


# ---- Facts on the test tables as they are ---------------------------------------------------


def fct_items(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Latest order lines with their header, the customer version on the order date, and USD."""
    # Customer and date belong to the order, so both are looked up before its lines join: lines move once for all.
    headers = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("l_orderkey"), "o_custkey", testbed.order_day().alias("order_date")
    )
    customers = table(spark, sf_dir, "customer").select(
        "c_custkey", F.when(F.col("c_nationkey") % 2 == 0, "USD").otherwise("CAD").alias("currency")
    )
    headers = lookup(headers, customers, {"o_custkey": "c_custkey"}, ["currency"])
    # Versions start 20 days after the order they come from, so early facts have none.
    history = table(spark, sf_dir, "orders").withColumn("valid_from", F.date_add(testbed.order_day(), 20))
    versions = scd2(
        history, key="o_custkey", attributes=["o_orderpriority"], order_by=[F.desc("o_orderkey")]
    )
    headers = point_in_time(
        headers,
        versions,
        key="o_custkey",
        on_date="order_date",
        version_id="o_custkey",
        columns=["version_key"],
        disjoint=True,
    )
    of_header = ["order_date", "currency", "version_key"]
    facts = with_header(latest_lines(spark, sf_dir), headers, "l_orderkey", of_header)
    facts = lookup(
        facts, exchange_rates(spark), {"currency": "currency"}, ["rate_to_usd"], small=True
    )
    value = F.col("l_extendedprice").cast("decimal(18,2)")
    return facts.select(
        surrogate_key("l_orderkey", "l_linenumber").alias("item_key"),
        "l_orderkey",
        "l_linenumber",
        "order_date",
        F.col("version_key").alias("customer_key"),
        "l_partkey",
        F.col("l_quantity").cast("decimal(18,3)").alias("quantity"),
        "currency",
        value.alias("net_value"),
        to_reporting_currency(value, "rate_to_usd").alias("net_value_usd"),
        (F.col("l_returnflag") == "R").alias("is_rejected"),
    )


def billing_fact(spark: SparkSession, sf_dir: str) -> DataFrame:
    line = F.col("l_linenumber") + F.when(F.col("l_partkey") % 9 == 0, 100).otherwise(0)
    items = fct_items(spark, sf_dir).select(
        "item_key", "l_orderkey", "l_linenumber", "net_value_usd", line.alias("billed_line")
    )
    status = table(spark, sf_dir, "orders").select(
        F.col("o_orderkey").alias("order_id"), (F.col("o_orderstatus") == "P").alias("is_cancelled")
    )
    billed = lookup(items, status, {"l_orderkey": "order_id"}, ["is_cancelled"])
    on = {"l_orderkey": "l_orderkey", "billed_line": "l_linenumber"}
    return mark_missing(billed, table(spark, sf_dir, "lineitem"), on, "is_orphan_item").drop("billed_line")


# ---- Checks ---------------------------------------------------------------------------------


def check_unique(spark: SparkSession, sf_dir: str) -> DataFrame:
    return duplicate_values(table(spark, sf_dir, "lineitem"), LINE_KEY)


def check_not_null(spark: SparkSession, sf_dir: str) -> DataFrame:
    items = fct_items(spark, sf_dir)
    return run_checks(
        spark, [], [Pass("fct_items", lambda: items, ["item_key", "customer_key", "net_value_usd", "order_date"])]
    )


def check_relationships(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = table(spark, sf_dir, "orders")
    return missing_parents(lines_with_orphans(spark, sf_dir), "l_orderkey", orders, "o_orderkey")


def check_accepted_values(spark: SparkSession, sf_dir: str) -> DataFrame:
    return unaccepted_values(table(spark, sf_dir, "orders"), "o_orderpriority", ["1-URGENT", "2-HIGH"])


def check_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily periods run one day too long: each one that the next day's start falls into."""
    periods = events_one_per_day(spark, sf_dir).select(
        "user_id",
        F.col("day").alias("valid_from"),
        F.date_add("day", 1).alias("valid_to"),
        F.col("event_id").alias("version_key"),
    )
    return overlapping_versions(periods, key="user_id", version_key="version_key")


def check_no_overlap(spark: SparkSession, sf_dir: str) -> DataFrame:
    return overlapping_versions(scd2_orders(spark, sf_dir), key="o_custkey", version_key="version_key")


def check_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Severities and statuses over all kinds of checks."""
    lines = table(spark, sf_dir, "lineitem")
    orders = table(spark, sf_dir, "orders")
    broken = lines_with_orphans(spark, sf_dir)
    checks = [
        Check("unique_orders", "orders", "unique", lambda: duplicate_values(orders, ["o_orderkey"])),
        Check("unique_lines", "lineitem", "unique", lambda: duplicate_values(lines, LINE_KEY)),
        Check(
            "lines_have_placed_order",
            "lineitem",
            "relationships",
            lambda: missing_parents(broken, "l_orderkey", orders, "o_orderkey"),
            WARN,
            "n_records",
        ),
        Check(
            "accepted_priorities",
            "orders",
            "accepted_values",
            lambda: unaccepted_values(orders, "o_orderpriority", ["1-URGENT"]),
        ),
    ]
    return run_checks(spark, checks, [Pass("orders", lambda: orders, ["o_orderkey", "o_custkey"])])


# ---- Loading --------------------------------------------------------------------------------


def load_skip(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Daily file names of all orders that a log kept until the end of 1997 does not hold."""
    named = testbed.file_name("VBAK", testbed.order_day()).alias("file_name")
    orders = table(spark, sf_dir, "orders")
    files = orders.select(named).distinct()
    log = orders.filter(F.col("o_orderdate") < "1998-01-01").select(named).distinct()
    return not_yet_loaded(files, log)


def file_row_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Rows per daily file of open orders, zero for days that have none."""
    orders = table(spark, sf_dir, "orders").withColumn(
        "file_name", testbed.file_name("VBAK", testbed.order_day())
    )
    counts = (
        orders.filter(F.col("o_orderstatus") == "O").groupBy("file_name").agg(F.count("*").alias("n"))
    )
    files = orders.select("file_name").distinct()
    return lookup(files, counts, {"file_name": "file_name"}, ["n"]).select(
        "file_name", F.coalesce("n", F.lit(0)).cast("bigint").alias("row_count")
    )


def loaded_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer extracts written as CSV files, loaded twice, and read back from raw.

    Some names hold commas, quotes and line breaks, so both ways of reading a file take part.
    """
    folder = f"{shared_folder(spark)}/extracts-{uuid4().hex}"
    raw = testbed.kna1(spark, sf_dir)
    two_lines = F.col("KUNNR").cast("bigint") % 89 == 0
    raw = raw.withColumn(
        "NAME1", F.when(two_lines, F.concat("NAME1", F.lit('\nc/o "Home"'))).otherwise(F.col("NAME1"))
    )
    testbed.write_extracts(raw, "KNA1", f"{folder}/in")
    load_extracts(spark, f"{folder}/in", f"{folder}/raw")
    load_extracts(spark, f"{folder}/in", f"{folder}/raw")
    return _loaded_customers(spark, f"{folder}/raw")


def _folder(spark: SparkSession, name: str) -> str:
    return f"{shared_folder(spark)}/{name}-{uuid4().hex}"


_CUSTOMER = ("KUNNR", "NAME1", "ORT01", "REGIO", "LAND1", "ERDAT")


def _loaded_customers(spark: SparkSession, raw_dir: str) -> DataFrame:
    month = F.regexp_extract("_source_file", "[0-9]{6}", 0)
    return raw_table(spark, raw_dir, "KNA1").select(*_CUSTOMER, month.alias("month"))


def loaded_reordered(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer extracts whose header has the columns the other way round."""
    folder = _folder(spark, "extracts")
    turned = RAW_COLUMNS["KNA1"][::-1]
    testbed.write_extracts(testbed.kna1(spark, sf_dir), "KNA1", f"{folder}/in", turned)
    load_extracts(spark, f"{folder}/in", f"{folder}/raw")
    return _loaded_customers(spark, f"{folder}/raw")


def streamed_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer extracts loaded as a stream, first those of orders until 1995, then the later ones."""
    folder = _folder(spark, "extracts")
    raw = testbed.kna1(spark, sf_dir)
    early = F.col("ERDAT") < "19960101"
    for number, part in enumerate((raw.filter(early), raw.filter(~early))):
        testbed.write_extracts(part, "KNA1", f"{folder}/part{number}")
        move_files(spark, f"{folder}/part{number}/KNA1", f"{folder}/in/KNA1")
        stream = stream_extracts(
            spark, f"{folder}/in", f"{folder}/raw", checkpoint_dir=f"{folder}/checkpoint"
        )
        stream.awaitTermination()
    return _loaded_customers(spark, f"{folder}/raw")


def load_log_rows(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Logged rows by table and month; one file has a header only."""
    folder = _folder(spark, "extracts")
    testbed.write_extracts(testbed.kna1(spark, sf_dir), "KNA1", f"{folder}/in")
    header = ",".join(RAW_COLUMNS["KNA1"])
    write_text(spark, f"{folder}/in/KNA1/KNA1_20991201.csv", f"{header}\n")
    load_extracts(spark, f"{folder}/in", f"{folder}/raw")
    month = F.regexp_extract("file_name", "[0-9]{6}", 0).alias("month")
    return load_log(spark, f"{folder}/raw").groupBy("table_name", month).agg(F.sum("row_count").alias("row_count"))


def load_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What two loads in a row say they did; files are counted against those there are."""
    folder = _folder(spark, "extracts")
    testbed.write_extracts(testbed.vbak(spark, sf_dir), "VBAK", f"{folder}/in")
    files = discover(spark, f"{folder}/in").count()
    rows = []
    for number in (1, 2):
        done = load_extracts(spark, f"{folder}/in", f"{folder}/raw")
        rows.append((number, done.rows_loaded, done.files_loaded == files, done.files_skipped == files))
    return spark.createDataFrame(
        rows, "load int, rows_loaded bigint, loads_all_files boolean, skips_all_files boolean"
    )


def rejected_files(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Extracts of four tables, three of them broken: whether a table is refused, and the rows loaded of it."""
    folder = _folder(spark, "extracts")
    testbed.write_extracts(testbed.kna1(spark, sf_dir), "KNA1", f"{folder}/in")
    # A column lacking, fields too many for want of quotes, and text that is not UTF-8.
    testbed.write_extracts(testbed.mara(spark, sf_dir), "MARA", f"{folder}/in", RAW_COLUMNS["MARA"][:-1])
    commas = testbed.makt(spark, sf_dir).withColumn("MAKTX", F.concat("MAKTX", F.lit(", new")))
    testbed.write_extracts(commas, "MAKT", f"{folder}/in", quote="")
    umlauts = testbed.vbak(spark, sf_dir).withColumn("AUART", F.lit("für"))
    testbed.write_extracts(umlauts, "VBAK", f"{folder}/in", encoding="ISO-8859-1")
    said = ""
    try:
        load_extracts(spark, f"{folder}/in", f"{folder}/raw")
    except LoadError as error:
        said = str(error)
    loaded = [raw_table(spark, f"{folder}/raw", t).agg(F.count("*").alias("n_rows")).select(
        F.lit(t).alias("table_name"), F.lit(f"/{t}_" in said).alias("is_refused"), "n_rows"
    ) for t in ("KNA1", "MARA", "MAKT", "VBAK")]
    return reduce(DataFrame.union, loaded)


# ---- Builds ---------------------------------------------------------------------------------


def _built(
    spark: SparkSession,
    sf_dir: str,
    folder: str,
    only: Sequence[str] | None = None,
    *,
    stop: bool = True,
    document_buckets: int | None = None,
    report: bool = False,
) -> BuildResult:
    """A build of the test tables. A model that could not be built raises, unless the outcomes are what is asked for."""
    raw = {name: view(spark, sf_dir) for name, view in testbed.RAW_VIEWS.items()}
    models = {name: model for name, model in MODELS.items() if only is None or name in only}
    start = sources(raw, exchange_rates(spark))
    built = build_models(
        spark, start, folder, BuildResult(None), models=models, stop_on_failure=stop, document_buckets=document_buckets
    )
    if not report:
        built.raise_errors()
    return built


def rebuilt_mart(spark: SparkSession, sf_dir: str) -> DataFrame:
    """The material dimension built twice and read through the build log."""
    folder = _folder(spark, "build")
    for _ in range(2):
        _built(spark, sf_dir, folder, ["stg_sap__mara", "stg_sap__makt", "dim_material"], stop=False)
    return current_tables(spark, folder)["dim_material"]


def published_view(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer versions and rates, built, published and read with SQL."""
    folder = _folder(spark, "build")
    _built(spark, sf_dir, folder, ["stg_sap__kna1", "dim_customer"])
    publish(spark, folder)
    return spark.sql(
        "select v.customer_id, v.customer_key, v.valid_from, v.valid_to, v.is_current, c.city, r.rate_to_usd "
        "from marts.dim_customer v join staging.stg_sap__kna1 c on c.customer_id = v.customer_id "
        "join seeds.exchange_rates r on r.currency = if(c.country_code = 'US', 'USD', 'CAD')"
    )


def declared_checks(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All declared checks over all tables, stored by a build that failures do not stop."""
    built = _built(spark, sf_dir, _folder(spark, "build"), stop=False)
    return spark.createDataFrame(
        built.checks,
        "check_name string, table_name string, kind string, severity string, n_violations bigint, status string",
    )


def build_report(spark: SparkSession, sf_dir: str) -> DataFrame:
    """What is built, fails or is skipped where failures keep what depends on them from being built."""
    built = _built(spark, sf_dir, _folder(spark, "build"), report=True)
    rows = [(o.table_name, o.layer, o.status) for o in built.outcomes]
    return spark.createDataFrame(rows, "table_name string, layer string, status string")


# ---- Refreshes ------------------------------------------------------------------------------


def _refreshed(
    spark: SparkSession, sf_dir: str, name: str, part_of: Callable[[str, Column], Column], parts: Sequence[int]
) -> DataFrame:
    """A table after refreshes that each bring the rows of one part; the part of a row goes by the day of its file."""
    folder = _folder(spark, "refresh")
    wanted = needed_for([name])
    raws = [spec.raw for table, spec in STAGING.items() if table in wanted]
    raws += ["KNA1"] if "dim_customer" in wanted else []
    for part in parts:
        own = lambda raw: part_of(raw, date_from_file_name("_source_file")) == part  # noqa: E731,B023
        rows = {raw: testbed.RAW_VIEWS[raw](spark, sf_dir).filter(own(raw)) for raw in raws}
        refresh_tables(spark, folder, rows, only=[name], n_buckets=16)
    return current_tables(spark, folder)[name]


def refreshed_orders(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Orders after three refreshes, of files until 1994, until 1996, and of the later ones."""
    period = lambda _, day: F.when(day < "1995-01-01", 0).when(day < "1997-01-01", 1).otherwise(2)
    return _refreshed(spark, sf_dir, "stg_sap__vbak", period, (0, 1, 2))


def spliced_customers(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Customer history after refreshes that bring every third day, those in the middle first and the first ones last."""
    return _refreshed(spark, sf_dir, "dim_customer", lambda _, day: F.pmod(F.unix_date(day), F.lit(3)), (1, 2, 0))


def refreshed_fact(name: str) -> Query:
    """Facts after two refreshes: every other day of customer history comes late, and so do some documents."""

    def part(raw: str, day: Column) -> Column:
        every = 2 if raw == "KNA1" else 10
        return (F.pmod(F.unix_date(day), F.lit(every)) == 0).cast("int")

    return lambda spark, sf_dir: _refreshed(spark, sf_dir, name, part, (0, 1))


def placed_fact(name: str) -> Query:
    """Facts of a build that stores documents in buckets, read through the build log."""

    def query(spark: SparkSession, sf_dir: str) -> DataFrame:
        folder = _folder(spark, "build")
        n_buckets = int(spark.conf.get("spark.sql.shuffle.partitions"))
        _built(spark, sf_dir, folder, _with_parents(name), stop=False, document_buckets=n_buckets)
        return current_tables(spark, folder)[name]

    return query


def _with_parents(name: str) -> set[str]:
    parents = [p for p in MODELS[name].parents if p in MODELS]
    return {name}.union(*map(_with_parents, parents))


FLAGSHIP = "fct_items"


def all_queries() -> dict[str, Query]:
    """Query name to function of (session, folder of test tables)."""
    generic: dict[str, Query] = {
        "clean_text": clean_text,
        "clean_date_amount_qty": clean_date_amount_qty,
        "file_name_date": file_name_date,
        "bad_dates": bad_dates,
        "latest_by_change": latest_by_change,
        "latest_max_by": latest_max_by,
        "latest_by_load": latest_by_load,
        "one_per_day": events_one_per_day,
        "attribute_changes": events_attribute_changes,
        "scd2_events": scd2_events,
        "scd2_orders": scd2_orders,
        "inner_header_item": inner_header_item,
        "pit_join": _events_in_time("range"),
        "pit_join_as_of": _events_in_time("as_of"),
        "pit_join_overlapping": _orders_in_overlapping_time("range"),
        "pit_join_overlapping_as_of": _orders_in_overlapping_time("as_of"),
        "pit_join_overlapping_auto": _orders_in_overlapping_time("auto"),
        "usd_value": usd_value,
        "usd_missing_rate": usd_missing_rate,
        "orphan_flag": orphan_flag,
        "left_const_join": left_const_join,
        "open_vs_cleared": open_vs_cleared,
        "delivery_lag": delivery_lag,
        "order_calendar": order_calendar,
        "fct_items": fct_items,
        "billing_fact": billing_fact,
        "check_unique": check_unique,
        "check_not_null": check_not_null,
        "check_relationships": check_relationships,
        "check_accepted_values": check_accepted_values,
        "check_overlap": check_overlap,
        "check_no_overlap": check_no_overlap,
        "check_report": check_report,
        "loaded_customers": loaded_customers,
        "loaded_reordered": loaded_reordered,
        "streamed_customers": streamed_customers,
        "load_log_rows": load_log_rows,
        "load_counts": load_counts,
        "rejected_files": rejected_files,
        "rebuilt_mart": rebuilt_mart,
        "published_view": published_view,
        "declared_checks": declared_checks,
        "build_report": build_report,
        "refreshed_orders": refreshed_orders,
        "spliced_customers": spliced_customers,
        "refreshed_sales_items": refreshed_fact("fct_sales_order_items"),
        "refreshed_billing_items": refreshed_fact("fct_billing_items"),
        "refreshed_delivery_items": refreshed_fact("fct_delivery_items"),
        "refreshed_receivable_items": refreshed_fact("fct_receivable_items"),
        "placed_sales_items": placed_fact("fct_sales_order_items"),
        "placed_billing_items": placed_fact("fct_billing_items"),
        "placed_delivery_items": placed_fact("fct_delivery_items"),
        "placed_receivable_items": placed_fact("fct_receivable_items"),
        "load_skip": load_skip,
        "file_row_counts": file_row_counts,
    }
    staging: dict[str, Query] = {
        name: star(lambda s, n=name: s.stg(n.removeprefix("stg_sap__"))) for name in STAGING
    }
    models: dict[str, Query] = {
        "dim_customer": star(lambda s: s.customers),
        "dim_material": star(lambda s: s.materials),
        "dim_date": star(lambda s: s.dates),
        "fct_sales_order_items": star(lambda s: s.sales),
        "fct_billing_items": star(lambda s: s.billing),
        "fct_delivery_items": star(lambda s: s.deliveries),
        "fct_receivable_items": star(lambda s: s.receivables),
    }
    rules: dict[str, Query] = {
        "billed_qty_within_ordered_qty": star(lambda s: quality.billed_over_ordered(s.billing_alone, s.sales_alone)),
        "cleared_after_posting": star(lambda s: quality.cleared_before_posting(s.receivables)),
        "customer_versions_do_not_overlap": star(
            lambda s: overlapping_versions(
                s.customers, key="customer_id", version_key="customer_key"
            )
        ),
        "no_billing_for_rejected_order_items": star(
            lambda s: quality.billed_though_rejected(s.billing_alone, s.sales_alone)
        ),
        "receivable_matches_invoice": star(
            lambda s: quality.receivable_differs_from_invoice(s.receivables, s.stg("vbrk"))
        ),
        "shipped_qty_within_ordered_qty": star(
            lambda s: quality.shipped_over_ordered(s.deliveries_alone, s.sales_alone)
        ),
    }
    questions: dict[str, Query] = {
        "value_by_customer_month": star(
            lambda s: analysis.ordered_value_by_month(s.sales, s.customers)
        ),
        "billed_value": star(
            lambda s: analysis.billed_value_by_month(s.billing, s.customers, include_orphans=False)
        ),
        "open_value": star(lambda s: analysis.open_order_value(s.sales_alone, s.billing_alone)),
        "order_to_invoice_days": star(lambda s: analysis.order_to_invoice_days(s.billing_alone, s.sales_alone)),
        "shipped_vs_ordered": star(
            lambda s: analysis.shipped_against_ordered(s.sales_alone, s.deliveries_alone)
        ),
        "receivables_by_status": star(lambda s: analysis.receivables_by_status(s.receivables)),
    }
    return generic | staging | models | rules | questions
