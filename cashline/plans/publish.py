"""The built layers as SQL views: `raw.VBAK`, `seeds.exchange_rates`, `staging.stg_sap__vbak`, `marts.dim_customer`."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from cashline.plans.commits import Stored, stored_tables
from cashline.schema import LOADED_AT, RAW_COLUMNS, SOURCE_FILE
from cashline.sources.raw import LOG_NAME, load_log


def publish(spark: SparkSession, out_dir: str, build_id: str | None = None) -> list[str]:
    """Create one database per layer with a view per table, and name the views.

    Views of built tables show one build, the newest unless one is named, whatever is built meanwhile;
    publish again after a build. Raw views show the files in the load log whenever they are queried.
    """
    log = f"parquet.`{out_dir}/raw/{LOG_NAME}`"
    loaded = {
        row["table_name"]
        for row in load_log(spark, f"{out_dir}/raw")
        .groupBy("table_name")
        .sum("row_count")
        .filter("sum(row_count) > 0")
        .collect()
    }
    views = {f"raw.{LOG_NAME}": f"select * from {log}"} if loaded else {}
    for table in RAW_COLUMNS:
        if table in loaded:
            columns = ", ".join([*RAW_COLUMNS[table], LOADED_AT, SOURCE_FILE])
            views[f"raw.{table}"] = (
                f"select {columns} from parquet.`{out_dir}/raw/{table}` "
                f"where {SOURCE_FILE} in (select file_name from {log})"
            )
    for name, table in stored_tables(spark, out_dir, build_id).items():
        if table.layer != "state":
            views[f"{table.layer}.{name}"] = _query(spark, out_dir, table)
    for layer in ("raw", "seeds", "staging", "marts"):
        spark.sql(f"create database if not exists {layer}")
    for name, query in views.items():
        spark.sql(f"create or replace view {name} as {query}")
    return list(views)


def _query(spark: SparkSession, out_dir: str, table: Stored) -> str:
    """All folders of a table as one glob; a table without any is empty."""
    columns = table.read(spark).columns if table.columns else ["*"]
    within = [path.removeprefix(f"{out_dir}/") for path in table.paths.values()]
    return f"select {', '.join(columns)} from parquet.`{out_dir}/{{{','.join(within)}}}`"


def as_temp_views(tables: dict[str, DataFrame]) -> None:
    """Register lazy tables under their own names, for SQL without a build."""
    for name, df in tables.items():
        df.createOrReplaceTempView(name)
