"""Refresh of staging tables and marts from new extract rows alone.

A build ranks all raw rows ever loaded. A refresh keeps what that comes to: per staging table the newest
row of each key with the columns it won by, per customer one row for each day it was heard of. Both lie
in hash buckets of the key (of the document, for items). New rows are reduced to one per key, compared
with the row kept, and only the buckets of keys that changed are written again.

Customer history takes days in any order. A late day can split a version, extend one or make two into
one, but only of its own customer: the versions of customers with new days are made again from their
days, and the rest stay. Comparing both histories gives the days on which another version is in force
than before, and only documents dated there get their facts made again, beside those that are new or
changed themselves, and those that look up an order item that is.

A document's header and its items lie in buckets of the same number, so a bucket of facts is made of a
bucket of headers and one of items. Everything that a refresh wrote, with the names of the files it
took in, becomes visible by one row of the build log; a refresh that dies is as if it had not begun.
"""

from __future__ import annotations

from collections.abc import Callable, Iterable, Iterator, Mapping, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import cached_property, reduce
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, Row, SparkSession
from pyspark.sql import functions as F

from cashline.operators.buckets import BUCKET, bucket_of, buckets_in, deal, matching, newer_rows, with_keys_of, write_buckets
from cashline.operators.joins import estimated_bytes
from cashline.operators.versions import changed_periods, daily_states, load_order, versions_of
from cashline.plans import marts
from cashline.plans.commits import Entry, Stored, build_log, commit, current_tables, stored_tables
from cashline.plans.quality import SEED, check_tables
from cashline.plans.staging import STAGING, newest_versions, version_rank
from cashline.schema import LOADED_AT, RAW_COLUMNS, SOURCE_FILE, raw_struct
from cashline.session import configure, sized_shuffles, work_folder
from cashline.sources.raw import LoadResult, load_extracts, load_log
from cashline.sources.seeds import exchange_rates
from cashline.storage import STORED, escaped, folders_in, remove_folder

N_BUCKETS = 64
MOST_PARTITIONS = 100_000  # also where nothing is known of the size of the new rows
STATE, STAGED, MARTS = "state", "staging", "marts"
CUSTOMER_DAYS = "customer_days"

RECEIVABLE = ("company_code", "accounting_doc_id", "fiscal_year", "doc_item")

# What decides the bucket of a row: the document, so that headers and items meet, or the master record.
BUCKET_KEYS: dict[str, tuple[str, ...]] = {
    "stg_sap__kna1": ("customer_id",),
    "stg_sap__mara": ("material_id",),
    "stg_sap__makt": ("material_id",),
    "stg_sap__vbak": ("sales_order_id",),
    "stg_sap__vbap": ("sales_order_id",),
    "stg_sap__vbrk": ("billing_id",),
    "stg_sap__vbrp": ("billing_id",),
    "stg_sap__likp": ("delivery_id",),
    "stg_sap__lips": ("delivery_id",),
    "stg_sap__bsid": RECEIVABLE,
    "stg_sap__bsad": RECEIVABLE,
    CUSTOMER_DAYS: ("customer_id",),
    "dim_customer": ("customer_id",),
    "dim_material": ("material_id",),
    "fct_sales_order_items": ("sales_order_id",),
    "fct_billing_items": ("billing_id",),
    "fct_delivery_items": ("delivery_id",),
    "fct_receivable_items": RECEIVABLE,
}

# The tables each one is made of; a refresh that leaves some out is given those it needs.
INPUTS: dict[str, tuple[str, ...]] = {
    "dim_customer": (),
    "dim_material": ("stg_sap__mara", "stg_sap__makt"),
    "dim_date": ("stg_sap__vbak", "stg_sap__vbrk"),
    "fct_sales_order_items": ("stg_sap__vbap", "stg_sap__vbak", "dim_customer"),
    "fct_billing_items": ("stg_sap__vbrp", "stg_sap__vbrk", "stg_sap__vbap", "dim_customer"),
    "fct_receivable_items": ("stg_sap__bsid", "stg_sap__bsad", "dim_customer"),
    "fct_delivery_items": ("stg_sap__lips", "stg_sap__likp", "fct_sales_order_items", "dim_customer"),
}
ALL_TABLES = (*STAGING, *INPUTS)

# Columns of staging tables of which a refresh must know what they were before.
COMPARED: dict[str, tuple[str, ...]] = {"stg_sap__vbak": ("order_date",)}


class RefreshFailed(Exception):
    """A check of severity error failed on the refreshed tables; readers keep the ones they had."""


def needed_for(tables: Iterable[str]) -> set[str]:
    """These tables and all they are made of."""
    found: set[str] = set()
    left = list(tables)
    while left:
        name = left.pop()
        if name not in found:
            found.add(name)
            left += INPUTS.get(name, ())
    return found


@dataclass
class RefreshResult:
    """What a refresh did: rows taken in, and per table the buckets it wrote, with what changed in them."""

    build_id: str | None = None
    load: LoadResult | None = None
    files: int = 0
    buckets: dict[str, list[int]] = field(default_factory=dict)
    checks: list = field(default_factory=list)


class _Refresh:
    def __init__(
        self, spark: SparkSession, out_dir: str, stored: dict[str, Stored], rates: DataFrame, last: Row | None, n_buckets: int, scratch: str
    ):
        self.spark, self.out_dir, self.rates, self.scratch = spark, out_dir, rates, scratch
        self.build_id = f"refresh-{uuid4().hex}"
        self.stored = stored
        self.generation, self.last_rates = (last["generation"], last["rates"]) if last else (None, None)
        self.n_buckets = last["n_buckets"] if last else n_buckets
        self.entries: list[Entry] = []
        self.written: dict[str, list[int]] = {}
        self.changes: dict[str, DataFrame] = {}

    # Tables as the refresh finds them, and as it leaves them.

    def old(self, name: str, schema: str, buckets: Sequence[int] | None = None) -> DataFrame:
        table = self.stored.get(name)
        if table is None or table.generation != self.generation:
            return self.spark.createDataFrame([], schema)
        return table.read(self.spark, buckets, schema)

    def has_old(self, name: str, buckets: Sequence[int]) -> bool:
        """Whether the refresh finds rows in any of these buckets."""
        table = self.stored.get(name)
        return table is not None and table.generation == self.generation and not table.paths.keys().isdisjoint(buckets)

    @cached_property
    def now(self) -> dict[str, Stored]:
        return {name: t for name, t in self.stored.items() if t.generation == self.generation}

    def table(self, name: str, buckets: Sequence[int] | None = None) -> DataFrame:
        """For readers, what this refresh has written included."""
        return self.now[name].read(self.spark, buckets)

    def write(self, name: str, layer: str, df: DataFrame, visible: Sequence[str] | None = None) -> None:
        """Replace the buckets that `df` has rows in, all rows of them; a table without rows gets an empty folder.

        The rows may be dealt already.
        """
        path = f"{layer}/{name}/{self.build_id}"
        write_buckets(df, BUCKET_KEYS[name], self.n_buckets, f"{self.out_dir}/{path}")
        found = sorted(int(f.split("=")[1]) for f in folders_in(self.spark, f"{self.out_dir}/{path}") if "=" in f)
        paths = {b: f"{path}/bucket={b}" for b in found}
        df = df.drop(BUCKET)
        if not paths and name not in self.now:
            df.limit(0).coalesce(1).write.parquet(f"{self.out_dir}/{path}/empty")
            paths = {0: f"{path}/empty"}
        self.point(name, layer, paths, df.select(*(visible or df.columns)))

    def point(self, name: str, layer: str, paths: Mapping[int, str], like: DataFrame) -> None:
        columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in like.schema)
        self.entries += [Entry(name, layer, path, bucket, columns) for bucket, path in paths.items()]
        table = self.now.setdefault(name, Stored(layer, self.generation or self.build_id, columns))
        table.columns = columns
        table.paths |= {bucket: f"{self.out_dir}/{path}" for bucket, path in paths.items()}
        self.written[name] = sorted(paths)

    def settled(self, df: DataFrame, name: str) -> DataFrame:
        path = f"{self.scratch}/{name}-{uuid4().hex}"
        df.write.options(**STORED).parquet(path)
        return self.spark.read.schema(df.schema).parquet(path)

    # Staging.

    def stage(self, name: str, delta: DataFrame) -> None:
        """Merge new raw rows into a staging table and keep what changed as `changes[name]`."""
        spec, keys = STAGING[name], STAGING[name].keys
        new = self.settled(newest_versions(delta, name), f"new-{name}")
        buckets = buckets_in(new, BUCKET_KEYS[name], self.n_buckets) if name in self.now else []
        ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in new.schema)
        rank = version_rank(new.columns, name)
        visible = [c for c in new.columns if c not in (LOADED_AT, SOURCE_FILE)]
        carried = COMPARED.get(name, ())
        if not self.has_old(name, buckets):  # all rows are new: nothing to join, nothing to keep
            before = F.when(F.lit(False), F.struct(*carried, rank.alias("__rank")))
            self.changes[name] = new.withColumn("before", before)
            if buckets or name not in self.now:
                self.write(name, STAGED, new, visible)
            return
        changed = newer_rows(new, self.old(name, ddl, buckets), keys, rank, carried)
        changed = self.changes[name] = self.settled(changed, f"changed-{name}")
        touched = buckets_in(changed, BUCKET_KEYS[name], self.n_buckets)
        if touched:
            on = {k: k for k in spec.keys}
            stay = with_keys_of(self.old(name, ddl, touched), changed, on, anti=True)
            self.write(name, STAGED, stay.unionByName(changed.drop("before")), visible)

    def changed_keys(self, name: str, *columns: str, only_new: bool = False, of: Sequence[str] = ()) -> DataFrame:
        """Distinct `columns` of changed rows: of new keys only, or of those and of rows whose `of` columns changed."""
        changed = self.changes.get(name)
        if changed is None:
            schema = self.table(name).select(*columns).schema
            return self.spark.createDataFrame([], schema)
        is_new = F.col("before").isNull()
        if only_new:
            changed = changed.filter(is_new)
        elif of:
            differs = [~F.col(c).eqNullSafe(F.col(f"before.{c}")) for c in of]
            changed = changed.filter(is_new | reduce(lambda a, b: a | b, differs))
        return changed.select(*columns).distinct()

    def all_changed(self, names: Sequence[str], *columns: str) -> DataFrame:
        return reduce(DataFrame.union, [self.changed_keys(name, *columns) for name in names])

    # Customers.

    def customers(self, delta: DataFrame) -> None:
        """Take in new customer rows, and keep the days on which another version is in force as `changes`."""
        history = marts.customer_history(delta)
        daily = daily_states(history, key="customer_id", attributes=marts.CUSTOMER_ATTRIBUTES, order_by=load_order())
        new = self.settled(daily, "new-days")
        attributes = [F.col(a) for a in marts.CUSTOMER_ATTRIBUTES]
        rank = F.struct(LOADED_AT, SOURCE_FILE, marts.customer_fingerprint(), *attributes)
        ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in new.schema)
        key = BUCKET_KEYS[CUSTOMER_DAYS]
        changed, touched = new, buckets_in(new, key, self.n_buckets)
        known = self.has_old(CUSTOMER_DAYS, touched)
        if known:
            old = self.old(CUSTOMER_DAYS, ddl, touched)
            changed = newer_rows(new, old, ("customer_id", "valid_from"), rank, ()).drop("before")
            changed = self.settled(changed, "changed-days")
            touched = buckets_in(changed, key, self.n_buckets)
        if not touched and CUSTOMER_DAYS in self.now:
            return
        days = {"customer_id": "customer_id", "valid_from": "valid_from"}
        stay = [with_keys_of(self.old(CUSTOMER_DAYS, ddl, touched), changed, days, anti=True)] if known else []
        self.write(CUSTOMER_DAYS, STATE, reduce(DataFrame.unionByName, [*stay, changed]))

        who = {"customer_id": "customer_id"}
        theirs = with_keys_of(self.table(CUSTOMER_DAYS, touched), changed.select("customer_id").distinct(), who)
        made = versions_of(theirs, key="customer_id", attributes=marts.CUSTOMER_ATTRIBUTES, version_key="customer_key")
        made = self.settled(made, "new-versions")
        ddl = ", ".join(f"{f.name} {f.dataType.simpleString()}" for f in made.schema)
        former = with_keys_of(self.old("dim_customer", ddl, touched), changed.select("customer_id").distinct(), who)
        periods = changed_periods(former, made, key="customer_id", version_key="customer_key")
        periods = self.changes["dim_customer"] = self.settled(periods, "changed-periods")
        # A state that replaces one of the same day changes the version, not the day it starts.
        rows = former.unionByName(made).groupBy(*made.columns).agg(F.count("*").alias("n")).filter("n = 1")
        others = self.settled(rows.select("customer_id").distinct(), "changed-customers")
        respliced = buckets_in(others, key, self.n_buckets)
        if respliced or "dim_customer" not in self.now:
            kept = with_keys_of(self.old("dim_customer", ddl, respliced), others, who, anti=True)
            self.write("dim_customer", MARTS, kept.unionByName(with_keys_of(made, others, who)))

    def dated_in_changed_periods(self, name: str, customer: str, day: str, *document: str) -> DataFrame:
        """Documents of a header table whose date has another customer version now."""
        headers = self.table(name).select(*document, F.col(customer).alias("__customer"), F.col(day).alias("__day"))
        periods = self.changes.get("dim_customer")
        if periods is None:
            return headers.select(*document).limit(0)
        of = periods.withColumnRenamed("customer_id", "__id")
        within = F.col("__day").between(F.col("first_day"), F.col("last_day"))
        hashes = F.xxhash64("__customer") == F.xxhash64("__id")
        return headers.join(of, [hashes, F.col("__customer") == F.col("__id"), within], "left_semi").select(*document)

    # Dimensions and facts.

    def remake(
        self, name: str, affected: Callable[[], Iterator[DataFrame]], make: Callable[[Callable[[str], DataFrame], marts.Step], DataFrame]
    ) -> None:
        """Make again the buckets that affected documents fall into, from the same buckets of their inputs.

        `affected` names documents, those that are cheap to find first; once all buckets are touched, no more are looked
        for. `make` is given a function that reads the bucketed inputs, and one that puts its rows together by bucket.
        """
        key = BUCKET_KEYS[name]
        if name in self.now and self.last_rates == self.rates_print:
            touched: list[int] = []
            for documents in affected():
                touched = sorted({*touched, *buckets_in(documents, key, self.n_buckets)})
                if len(touched) == self.n_buckets:
                    break
        else:
            touched = list(range(self.n_buckets))
        if not touched:
            return
        had = set(self.now[name].paths) if name in self.now else set()
        df = make(lambda table: self.table(table, touched), lambda rows: deal(rows, key, self.n_buckets))
        self.write(name, MARTS, df)
        df = df.drop(BUCKET)
        emptied = (had & set(touched)) - set(self.written[name])
        if emptied:  # else their rows would stay
            path = f"{MARTS}/{name}/{self.build_id}/empty"
            df.limit(0).coalesce(1).write.parquet(f"{self.out_dir}/{path}")
            kept = self.written[name]
            self.point(name, MARTS, {b: path for b in emptied}, df)
            self.written[name] = sorted({*kept, *emptied})

    @cached_property
    def rates_print(self) -> str:
        """Changes with any rate."""
        total = self.rates.agg(F.count("*"), F.bit_xor(F.xxhash64("currency", "rate_to_usd"))).first()
        return f"{total[0]}:{total[1]}"

    def materials(self) -> None:
        affected = lambda: iter([self.all_changed(("stg_sap__mara", "stg_sap__makt"), "material_id")])
        self.remake("dim_material", affected, lambda own, _: marts.dim_material(own("stg_sap__mara"), own("stg_sap__makt")))

    def dates(self) -> None:
        """The calendar is bounded by the dates of all documents, which no bucket knows alone."""
        if "dim_date" in self.now and not {"stg_sap__vbak", "stg_sap__vbrk"} & set(self.written):
            return
        df = marts.dim_date(self.table("stg_sap__vbak"), self.table("stg_sap__vbrk"))
        path = f"{MARTS}/dim_date/{self.build_id}"
        df.write.options(**STORED).parquet(f"{self.out_dir}/{path}")
        self.point("dim_date", MARTS, {0: path}, df)

    def sales(self) -> None:
        def affected() -> Iterator[DataFrame]:
            yield self.all_changed(("stg_sap__vbak", "stg_sap__vbap"), "sales_order_id")
            yield self.dated_in_changed_periods("stg_sap__vbak", "customer_id", "order_date", "sales_order_id")

        self.remake("fct_sales_order_items", affected, lambda own, dealt: marts.fct_sales_order_items(
            own("stg_sap__vbap"), own("stg_sap__vbak"), self.table("dim_customer"), self.rates, deal=dealt
        ))

    def billing(self) -> None:
        def affected() -> Iterator[DataFrame]:
            yield self.all_changed(("stg_sap__vbrk", "stg_sap__vbrp"), "billing_id")
            yield self.dated_in_changed_periods("stg_sap__vbrk", "payer_id", "billing_date", "billing_id")
            # An order item that was not there makes orphans of its invoices no orphans.
            items = self.changed_keys("stg_sap__vbap", "sales_order_id", "item_no", only_new=True)
            billed = self.table("stg_sap__vbrp").select("billing_id", "sales_order_id", "sales_order_item_no")
            on = {"sales_order_id": "sales_order_id", "sales_order_item_no": "item_no"}
            yield matching(billed, items, on).select("billing_id")

        self.remake("fct_billing_items", affected, lambda own, dealt: marts.fct_billing_items(
            own("stg_sap__vbrp"), own("stg_sap__vbrk"), self.table("stg_sap__vbap"), self.table("dim_customer"), self.rates, deal=dealt
        ))

    def deliveries(self) -> None:
        def affected() -> Iterator[DataFrame]:
            yield self.all_changed(("stg_sap__likp", "stg_sap__lips"), "delivery_id")
            yield self.dated_in_changed_periods("stg_sap__likp", "ship_to_customer_id", "delivery_date", "delivery_id")
            # Deliveries show the key and the date of their order item.
            orders = self.changed_keys("stg_sap__vbak", "sales_order_id", of=["order_date"])
            orders = orders.union(self.changed_keys("stg_sap__vbap", "sales_order_id", only_new=True))
            shipped = self.table("stg_sap__lips").select("delivery_id", "sales_order_id")
            yield matching(shipped, orders, {"sales_order_id": "sales_order_id"}).select("delivery_id")

        self.remake("fct_delivery_items", affected, lambda own, dealt: marts.fct_delivery_items(
            own("stg_sap__lips"), own("stg_sap__likp"), self.table("fct_sales_order_items"), self.table("dim_customer"), deal=dealt
        ))

    def receivables(self) -> None:
        def affected() -> Iterator[DataFrame]:
            yield self.all_changed(("stg_sap__bsid", "stg_sap__bsad"), *RECEIVABLE)
            yield self.dated_in_changed_periods("stg_sap__bsid", "customer_id", "posting_date", *RECEIVABLE)

        self.remake("fct_receivable_items", affected, lambda own, dealt: marts.fct_receivable_items(
            own("stg_sap__bsid"), own("stg_sap__bsad"), self.table("dim_customer"), self.rates, deal=dealt
        ))


def last_refresh(spark: SparkSession, out_dir: str, stored: Mapping[str, Stored], wanted: Iterable[str] = ()) -> Row | None:
    """Generation, rates and number of buckets of the last refresh, if it left tables to go on from.

    It has not where a wanted table was not among its own, or has been built whole since.
    """
    refreshes = build_log(spark, out_dir).filter("n_buckets is not null")
    last = refreshes.select("generation", "rates", "n_buckets").orderBy(F.desc("built_at"), F.desc("build_id")).first()
    if last is None:
        return None
    own = {name for name, t in stored.items() if t.generation == last["generation"]}
    return last if own >= set(wanted) else None


def merged_files(spark: SparkSession, out_dir: str, generation: str) -> DataFrame:
    """Names of the extract files that the refreshes of a generation have taken in."""
    rows = build_log(spark, out_dir).filter(F.col("generation") == generation)
    return rows.select(F.explode("files").alias("file_name")).distinct()


def refresh_tables(
    spark: SparkSession,
    out_dir: str,
    new_rows: Mapping[str, DataFrame],
    *,
    rates: DataFrame | None = None,
    only: Iterable[str] | None = None,
    n_buckets: int = N_BUCKETS,
    threads: int = 4,
    files: Iterable[str] = (),
    check: bool = False,
) -> RefreshResult:
    """Take raw rows (by extract table) into the tables under `out_dir`, or into `only` some and their inputs.

    The result equals a build from all rows that were ever given, in whatever order they came. Rows that
    were given before change nothing. With `check`, the declared checks run on the outcome, and if one of
    severity error fails, readers keep the tables they had. The first refresh of a folder decides on its
    tables and on the number of buckets, which should be such that a bucket of the largest table suits
    one task; where one of the tables is not there to go on from, all rows are to be given again.
    One refresh at a time.
    """
    configure(spark)
    scratch = f"{work_folder(spark, out_dir)}/refresh-{uuid4().hex}"
    wanted = needed_for(only or ALL_TABLES)
    rates = exchange_rates(spark) if rates is None else rates
    stored = stored_tables(spark, out_dir)
    run = _Refresh(spark, out_dir, stored, rates, last_refresh(spark, out_dir, stored, wanted), n_buckets, scratch)
    files = list(files)

    def every(steps: list[Callable[[], None]]) -> None:
        with ThreadPoolExecutor(threads) as pool:
            list(pool.map(inheritable_thread_target(spark)(lambda step: step()), steps))

    largest = max((estimated_bytes(df) or 0 for df in new_rows.values()), default=0)
    try:
        with sized_shuffles(spark, largest, most=MOST_PARTITIONS):
            empty = lambda raw: spark.createDataFrame([], raw_struct(raw))
            delta = {raw: new_rows[raw] if raw in new_rows else None for raw in RAW_COLUMNS}
            first = [
                lambda n=name, s=spec: run.stage(n, empty(s.raw) if delta[s.raw] is None else delta[s.raw])
                for name, spec in STAGING.items()
                if name in wanted and (delta[spec.raw] is not None or name not in run.now)
            ]
            if "dim_customer" in wanted and (delta["KNA1"] is not None or "dim_customer" not in run.now):
                first.append(lambda: run.customers(empty("KNA1") if delta["KNA1"] is None else delta["KNA1"]))
            every(first)
            steps = {
                "dim_material": run.materials,
                "dim_date": run.dates,
                "fct_sales_order_items": run.sales,
                "fct_billing_items": run.billing,
                "fct_receivable_items": run.receivables,
            }
            every([step for name, step in steps.items() if name in wanted])
            if "fct_delivery_items" in wanted:
                run.deliveries()
            result = RefreshResult(files=len(files), buckets=run.written)
            if check:
                tables = {n: t.read(spark) for n, t in run.now.items() if t.layer != STATE} | {SEED: rates}
                result.checks = check_tables(spark, tables).collect()
                failed = [f"{r['check_name']} ({r['n_violations']})" for r in result.checks if r["status"] == "fail"]
                if failed:
                    raise RefreshFailed(", ".join(failed))
            if run.entries or files:
                commit(
                    spark, out_dir, run.build_id, run.entries,
                    generation=run.generation, n_buckets=run.n_buckets, rates=run.rates_print, files=files,
                )
                result.build_id = run.build_id
            return result
    finally:
        remove_folder(spark, scratch)


def refresh_all(
    spark: SparkSession, extracts_dir: str | None, out_dir: str, **options
) -> RefreshResult:
    """Load new extracts and take every loaded file into the tables that has not been taken in yet.

    Only the folders of these files are read. Options are those of `refresh_tables`.
    """
    configure(spark)
    raw_dir = f"{out_dir}/raw"
    load = load_extracts(spark, extracts_dir, raw_dir) if extracts_dir else None
    wanted = needed_for(options.get("only") or ALL_TABLES)
    last = last_refresh(spark, out_dir, stored_tables(spark, out_dir), wanted)
    new = load_log(spark, raw_dir).select("table_name", "file_name", "row_count")
    if last:
        new = new.join(merged_files(spark, out_dir, last["generation"]), "file_name", "left_anti")
    listing = new.distinct().collect()  # names of files that were not taken in yet
    delta = {
        table: new_raw_rows(spark, raw_dir, table, [r["file_name"] for r in listing if r["table_name"] == table and r["row_count"]])
        for table in {r["table_name"] for r in listing if r["row_count"]}
    }
    result = refresh_tables(spark, out_dir, delta, files=[r["file_name"] for r in listing], **options)
    result.load = load
    return result


def new_raw_rows(spark: SparkSession, raw_dir: str, table: str, files: Sequence[str]) -> DataFrame:
    """The raw rows of these files, from their own folders alone."""
    root = f"{raw_dir}/{table}"
    paths = [f"{root}/{SOURCE_FILE}={escaped(spark, name)}" for name in files]
    rows = spark.read.schema(raw_struct(table)).option("basePath", root).parquet(*paths)
    return rows.select(*RAW_COLUMNS[table], LOADED_AT, SOURCE_FILE)


__all__ = ["RefreshFailed", "RefreshResult", "current_tables", "last_refresh", "merged_files", "new_raw_rows", "refresh_all", "refresh_tables", "bucket_of"]
