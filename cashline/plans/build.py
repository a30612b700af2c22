"""The whole pipeline: load, store the seed, stage, build the star schema, check.

Models are nodes of a graph and are built in waves, each as soon as its parents are there. A model
that cannot be built, or that fails a check of severity error, keeps only what depends on it from being
built. Every build of a table is written to a folder of its own, and readers are pointed to all of them at
once by a row in the build log, which is written last: a build that dies leaves every table as it was, and
nobody sees new dimensions beside old facts.
"""

from __future__ import annotations

from collections.abc import Callable, Mapping
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, field
from functools import partial
from uuid import uuid4

from pyspark import inheritable_thread_target
from pyspark.sql import DataFrame, SparkSession

from cashline.operators.joins import estimated_bytes
from cashline.operators.placement import write_placed
from cashline.plans import marts
from cashline.plans.commits import Entry, commit, current_tables, remove_old_builds
from cashline.plans.quality import SEED, check_tables
from cashline.plans.staging import STAGING, stage
from cashline.session import configure, sized_shuffles
from cashline.sources.raw import LoadResult, load_extracts, raw_tables
from cashline.sources.seeds import exchange_rates
from cashline.storage import STORED

__all__ = ["MODELS", "BuildResult", "CheckFailed", "Model", "Outcome", "all_tables", "build_all", "build_models", "current_tables", "remove_old_builds", "sources"]

Tables = Mapping[str, DataFrame]

class CheckFailed(Exception):
    """Models could not be built or failed checks of severity error; what depends on them was not built."""


@dataclass(frozen=True)
class Model:
    """A table of the warehouse: its layer, the tables it reads, and how it is made of them."""

    layer: str
    parents: tuple[str, ...]
    make: Callable[[Tables], DataFrame]


def _stage(name: str, raw: str) -> Model:
    return Model("staging", (f"raw.{raw}",), lambda t: stage(t[f"raw.{raw}"], name))


def _mart(*parents: str, make: Callable[..., DataFrame]) -> Model:
    return Model("marts", parents, lambda t: make(*[t[p] for p in parents]))


MODELS: dict[str, Model] = {name: _stage(name, spec.raw) for name, spec in STAGING.items()} | {
    "dim_customer": _mart("raw.KNA1", make=marts.dim_customer),
    "dim_material": _mart("stg_sap__mara", "stg_sap__makt", make=marts.dim_material),
    "dim_date": _mart("stg_sap__vbak", "stg_sap__vbrk", make=marts.dim_date),
    "fct_sales_order_items": _mart(
        "stg_sap__vbap", "stg_sap__vbak", "dim_customer", SEED, make=marts.fct_sales_order_items
    ),
    "fct_billing_items": _mart(
        "stg_sap__vbrp", "stg_sap__vbrk", "stg_sap__vbap", "dim_customer", SEED, make=marts.fct_billing_items
    ),
    "fct_receivable_items": _mart(
        "stg_sap__bsid", "stg_sap__bsad", "dim_customer", SEED, make=marts.fct_receivable_items
    ),
    "fct_delivery_items": _mart(
        "stg_sap__lips", "stg_sap__likp", "fct_sales_order_items", "dim_customer", make=marts.fct_delivery_items
    ),
}

# Tables that `document_buckets` stores in buckets of their document, and the facts that join by them.
# Billed and delivered facts stay as they are: their order number is NULL in many rows.
PLACED = {
    "stg_sap__vbak": "sales_order_id",
    "stg_sap__vbap": "sales_order_id",
    "stg_sap__vbrk": "billing_id",
    "stg_sap__vbrp": "billing_id",
    "stg_sap__likp": "delivery_id",
    "stg_sap__lips": "delivery_id",
    "stg_sap__bsid": "accounting_doc_id",
    "stg_sap__bsad": "accounting_doc_id",
    "fct_sales_order_items": "sales_order_id",
}


def placed_models(models: Mapping[str, Model], n_buckets: int) -> dict[str, Model]:
    """The models with facts that join tables in `n_buckets` buckets of their document."""

    def placed(name: str, model: Model) -> Model:
        if not name.startswith("fct_") or model is not MODELS.get(name):
            return model
        return _mart(*model.parents, make=partial(getattr(marts, name), n_buckets=n_buckets))

    return {name: placed(name, model) for name, model in models.items()}


BUILT, FAILED, ERROR, SKIPPED = "built", "failed", "error", "skipped"


@dataclass(frozen=True)
class Outcome:
    """What became of a model, and why."""

    table_name: str
    layer: str
    status: str
    reason: str | None = None


@dataclass
class BuildResult:
    load: LoadResult | None
    tables: dict[str, DataFrame] = field(default_factory=dict)
    checks: list = field(default_factory=list)
    outcomes: list[Outcome] = field(default_factory=list)
    build_id: str | None = None
    errors: dict[str, Exception] = field(default_factory=dict)

    def problems(self) -> str:
        return "; ".join(f"{o.table_name}: {o.reason}" for o in self.outcomes if o.status in (FAILED, ERROR))

    def raise_errors(self) -> None:
        """Raise if a model could not be built: tables and checks then lack some, which nothing in them shows."""
        if self.errors:
            raise CheckFailed(self.problems()) from next(iter(self.errors.values()))


def sources(raw: Tables, rates: DataFrame) -> dict[str, DataFrame]:
    """What the models begin with, under the names they ask for."""
    return {f"raw.{name}": df for name, df in raw.items()} | {SEED: rates}


def all_tables(raw: Tables, rates: DataFrame) -> dict[str, DataFrame]:
    """Staging, dimensions and facts as lazy DataFrames, nothing materialized."""
    tables = sources(raw, rates)
    for name, model in MODELS.items():
        tables[name] = model.make(tables)
    return {name: df for name, df in tables.items() if not name.startswith("raw.")}


def _columns(df: DataFrame) -> str:
    return ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)


def build_models(
    spark: SparkSession,
    start: Tables,
    out_dir: str,
    result: BuildResult,
    *,
    models: Mapping[str, Model] = MODELS,
    threads: int = 4,
    stop_on_failure: bool = True,
    document_buckets: int | None = None,
) -> BuildResult:
    """Build the models from the tables in `start`, check them, and at the end point readers to those that pass.

    With `stop_on_failure` off, a failed check is reported only. A model whose build raises always keeps
    what depends on it from being built. Its error is kept in the result: whoever takes the tables or checks
    of the result for those of all models calls `raise_errors` first. With `document_buckets`, document tables
    are stored in so many buckets of their document number, and the facts made of them join without moving
    items. Shuffles start with partitions enough for the largest table in `start`.
    """
    with sized_shuffles(spark, max((estimated_bytes(df) or 0 for df in start.values()), default=0)):
        return _build_models(spark, start, out_dir, result, models, threads, stop_on_failure, document_buckets)


def _build_models(
    spark: SparkSession,
    start: Tables,
    out_dir: str,
    result: BuildResult,
    models: Mapping[str, Model],
    threads: int,
    stop_on_failure: bool,
    document_buckets: int | None,
) -> BuildResult:
    if document_buckets:
        models = placed_models(models, document_buckets)
    build = f"build-{uuid4().hex}"
    tables = dict(start)
    status = {name: BUILT for name in start}
    pointed: list[Entry] = []

    def write(name: str, frame: Callable[[], DataFrame], layer: str) -> tuple[str, DataFrame | Exception]:
        path = f"{out_dir}/{layer}/{name}/{build}"
        try:
            df = frame()
            if document_buckets and name in PLACED:
                return name, write_placed(df, path, PLACED[name], document_buckets)
            df.write.options(**STORED).parquet(path)
            return name, spark.read.schema(df.schema).parquet(path)
        except Exception as error:  # noqa: BLE001  kept in the result, whose callers raise it (`raise_errors`)
            return name, error

    def wave(ready: dict[str, tuple[str, Callable[[], DataFrame]]]) -> None:
        with ThreadPoolExecutor(threads) as pool:
            run = inheritable_thread_target(spark)(lambda n: write(n, ready[n][1], ready[n][0]))
            written = dict(pool.map(run, ready))
        good = {n: df for n, df in written.items() if isinstance(df, DataFrame)}
        tables.update(good)
        # One row per check, about a hundred in all.
        checkable = {n: df for n, df in tables.items() if not n.startswith("raw.") and status.get(n, BUILT) == BUILT}
        found = check_tables(spark, checkable, set(good)).collect() if good else []
        result.checks += found
        for name, (layer, _) in ready.items():
            failed = [r for r in found if r["table_name"] == name and r["status"] == "fail"]
            if name not in good:
                status[name], reason = ERROR, str(written[name]).split("\n")[0][:500]
                result.errors[name] = written[name]
            elif failed:
                status[name] = FAILED if stop_on_failure else BUILT
                reason = ", ".join(f"{r['check_name']} ({r['n_violations']})" for r in failed)
            else:
                status[name], reason = BUILT, None
            result.outcomes.append(Outcome(name, layer, FAILED if failed else status[name], reason))
            if status[name] == BUILT:
                result.tables[name] = good[name]
                # A table in buckets has no file where it has no rows, so its columns are named.
                columns = _columns(good[name]) if document_buckets and name in PLACED else None
                pointed.append(Entry(name, layer, f"{layer}/{name}/{build}", columns=columns))

    if SEED in start:
        del status[SEED]
        wave({SEED: ("seeds", lambda: start[SEED])})
    open_models = {name: model for name, model in models.items()}
    while open_models:
        ready = {n: m for n, m in open_models.items() if all(p in status for p in m.parents)}
        if not ready:
            raise ValueError(f"models read tables that no model makes: {sorted(open_models)}")
        open_models = {n: m for n, m in open_models.items() if n not in ready}
        blocked = {n: [p for p in m.parents if status[p] != BUILT] for n, m in ready.items()}
        for name, parents in blocked.items():
            if parents:
                status[name] = SKIPPED
                result.outcomes.append(Outcome(name, ready[name].layer, SKIPPED, f"needs {', '.join(parents)}"))
        able = {n: (m.layer, lambda m=m: m.make(tables)) for n, m in ready.items() if not blocked[n]}
        if able:
            wave(able)
    if pointed:
        commit(spark, out_dir, build, pointed)
        result.build_id = build
    return result


def build_all(
    spark: SparkSession,
    extracts_dir: str | None,
    out_dir: str,
    *,
    rates: DataFrame | None = None,
    threads: int = 4,
    stop_on_failure: bool = True,
    on_finish: Callable[[BuildResult], None] | None = None,
    document_buckets: int | None = None,
) -> BuildResult:
    """Load new extracts, rebuild staging and marts under `out_dir`, and run all checks.

    Raises `CheckFailed` at the end if a model could not be built or, unless `stop_on_failure` is off,
    failed a check of severity error; all that does not depend on it is built nevertheless, and
    warnings are only reported. `on_finish` gets the result also of a build that failed. Leave
    `extracts_dir` out to rebuild from the raw tables already loaded. `document_buckets` is that of
    `build_models`; take about one per 128 MB of the largest document table, and no fewer than the
    session's shuffle partitions.
    """
    configure(spark)
    raw_dir = f"{out_dir}/raw"
    result = BuildResult(load_extracts(spark, extracts_dir, raw_dir) if extracts_dir else None)
    raw = raw_tables(spark, raw_dir)
    start = sources(raw, exchange_rates(spark) if rates is None else rates)
    try:
        build_models(spark, start, out_dir, result, threads=threads, stop_on_failure=stop_on_failure, document_buckets=document_buckets)
    finally:
        if on_finish:
            on_finish(result)
    result.raise_errors()
    if stop_on_failure and result.problems():
        raise CheckFailed(result.problems())
    return result
