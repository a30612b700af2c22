"""Text extracts derived from the shared test tables, so the real plans run on them.

Each function projects a test table to the raw layout: every business column is text, versions
repeat, some dates are empty, some references are broken. Everything is a projection of the
given table, so the work grows with it.
"""

from __future__ import annotations

from collections.abc import Callable, Sequence

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from cashline.schema import LOADED_AT, RAW_COLUMNS, SOURCE_FILE


# Declared, so that planning a query reads no file.
SCHEMAS = {
    "customer": "c_custkey bigint, c_name string, c_nationkey int, c_acctbal double, c_mktsegment string",
    "supplier": "s_suppkey bigint, s_name string, s_nationkey int, s_acctbal double",
    "part": "p_partkey bigint, p_name string, p_brand string, p_type string, p_size int, p_retailprice double",
    "orders": (
        "o_orderkey bigint, o_custkey bigint, o_orderstatus string, o_totalprice double, "
        "o_orderdate timestamp_ntz, o_orderpriority string"
    ),
    "lineitem": (
        "l_orderkey bigint, l_partkey bigint, l_suppkey bigint, l_linenumber int, "
        "l_quantity double, l_extendedprice double, l_discount double, l_tax double, "
        "l_returnflag string, l_linestatus string, l_shipdate timestamp_ntz"
    ),
    "events": (
        "event_id bigint, ts timestamp_ntz, user_id bigint, event_type string, value double, "
        "props string"
    ),
}


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.schema(SCHEMAS[name]).parquet(f"{sf_dir}/{name}.parquet")


def pad(number: Column | str, width: int) -> Column:
    column = F.col(number) if isinstance(number, str) else number
    text = column.cast("string")
    # lpad would cut longer numbers short, and with them the keys' uniqueness.
    return F.lpad(text, F.greatest(F.lit(width), F.length(text)), F.lit("0"))


def day_text(day: Column) -> Column:
    return F.replace(day.cast("string"), F.lit("-"), F.lit(""))


def amount_text(value: Column | str) -> Column:
    column = F.col(value) if isinstance(value, str) else value
    return column.cast("decimal(18,2)").cast("string")


def loaded(day: Column, micros: Column | str) -> Column:
    """A load time on a day that differs for every row."""
    offset = F.col(micros) if isinstance(micros, str) else micros
    return F.timestamp_micros(F.unix_date(day).cast("bigint") * F.lit(86_400_000_000) + offset)


def file_name(raw: str, day: Column) -> Column:
    return F.concat(F.lit(f"{raw}_"), day_text(day), F.lit(".csv"))


def _raw(df: DataFrame, raw: str, values: dict[str, Column], loaded_at: Column, source: Column) -> DataFrame:
    columns = {"MANDT": F.lit("100"), **values}
    return df.select(
        *[columns[c].alias(c) for c in RAW_COLUMNS[raw]],
        loaded_at.alias(LOADED_AT),
        source.alias(SOURCE_FILE),
    )


def _versions(df: DataFrame, last: Column) -> DataFrame:
    return df.withColumn("v", F.explode(F.sequence(F.lit(0), last.cast("int"))))


def order_day() -> Column:
    return F.col("o_orderdate").cast("date")


def ship_day() -> Column:
    return F.col("l_shipdate").cast("date")


def bill_day() -> Column:
    return F.date_add(order_day(), (F.col("o_custkey") % 7 + 1).cast("int"))


def empty_date() -> Column:
    return F.lit("00000000")


def currency() -> Column:
    return F.when(F.col("o_custkey") % 2 == 0, "USD").otherwise("CAD")


def unknown(number: str) -> Column:
    """A document number that no document has: numbers hold no letter."""
    return F.concat(F.lit("X"), pad(number, 9))


def item_file(raw: str) -> Column:
    """A file of its own per part and supplier, so that versions loaded at one time have an order."""
    return F.concat(
        F.lit(f"{raw}_"), day_text(ship_day()), F.lit("_"), pad("l_partkey", 12), F.lit("_"), pad("l_suppkey", 12), F.lit(".csv")
    )


def kna1(spark: SparkSession, sf_dir: str) -> DataFrame:
    customer = F.col("o_custkey")
    return _raw(
        table(spark, sf_dir, "orders"),
        "KNA1",
        {
            "KUNNR": pad("o_custkey", 10),
            "NAME1": F.when(customer % 97 == 0, 'Brook, Hale and "Sons"').otherwise(
                F.concat(F.lit("Customer "), customer.cast("string"))
            ),
            "ORT01": F.concat(F.lit(" "), "o_orderpriority", F.lit(" ")),
            "REGIO": F.when(F.col("o_orderstatus") == "P", "  ").otherwise(F.col("o_orderstatus")),
            "LAND1": F.when(customer % 2 == 0, "US").otherwise("CA"),
            "ERDAT": day_text(order_day()),
        },
        loaded(order_day(), "o_orderkey"),
        file_name("KNA1", order_day()),
    )


def mara(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("v")
    # The later a change, the earlier its file: only the change date can rank them rightly.
    file_day = F.date_add(F.lit("2026-01-09").cast("date"), -v)
    return _raw(
        _versions(table(spark, sf_dir, "part"), F.col("p_size") % 3),
        "MARA",
        {
            "MATNR": pad("p_partkey", 18),
            "MTART": F.col("p_type"),
            "MATKL": F.concat("p_brand", F.when(v > 0, v.cast("string")).otherwise("")),
            "MEINS": F.lit("EA"),
            "ERSDA": F.concat(F.lit("2026"), pad(F.col("p_partkey") % 12 + 1, 2), F.lit("01")),
            "LAEDA": F.when(v == 0, empty_date()).otherwise(
                F.concat(F.lit("2027"), pad(v, 2), F.lit("15"))
            ),
        },
        loaded(file_day, F.lit(0)),
        file_name("MARA", file_day),
    )


def makt(spark: SparkSession, sf_dir: str) -> DataFrame:
    languages = F.when(F.col("p_partkey") % 10 == 0, F.array(F.lit("D"))).otherwise(
        F.array(F.lit("E"), F.lit("D"))
    )
    described = _versions(table(spark, sf_dir, "part"), F.lit(1)).withColumn(
        "language", F.explode(languages)
    )
    text = F.when(F.col("language") == "D", F.upper("p_name")).otherwise(F.col("p_name"))
    file_day = F.date_add(F.lit("2026-01-01").cast("date"), F.col("v"))
    return _raw(
        described,
        "MAKT",
        {
            "MATNR": pad("p_partkey", 18),
            "SPRAS": F.col("language"),
            "MAKTX": F.concat(text, F.lit(" "), F.col("v").cast("string")),
        },
        loaded(F.lit("2026-01-09").cast("date"), F.lit(0)),
        file_name("MAKT", file_day),
    )


def vbak(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("v")
    changed = F.date_add(order_day(), v)
    return _raw(
        _versions(table(spark, sf_dir, "orders"), F.col("o_orderkey") % 3),
        "VBAK",
        {
            "VBELN": pad("o_orderkey", 10),
            "AUART": F.lit("OR"),
            "ERDAT": day_text(order_day()),
            "AUDAT": day_text(order_day()),
            "KUNNR": pad("o_custkey", 10),
            "WAERK": currency(),
            "NETWR": F.when(F.col("o_orderkey") % 101 == 0, "abc").otherwise(
                amount_text(F.col("o_totalprice").cast("decimal(18,2)") + v)
            ),
            "AEDAT": F.when(v == 0, empty_date()).otherwise(day_text(changed)),
        },
        loaded(changed, "o_orderkey"),
        file_name("VBAK", changed),
    )


def vbap(spark: SparkSession, sf_dir: str) -> DataFrame:
    order = F.col("l_orderkey")
    return _raw(
        table(spark, sf_dir, "lineitem"),
        "VBAP",
        {
            "VBELN": pad("l_orderkey", 10),
            "POSNR": pad(F.col("l_linenumber") * 10, 6),
            "MATNR": pad("l_partkey", 18),
            "KWMENG": F.col("l_quantity").cast("int").cast("string"),
            "VRKME": F.lit("EA"),
            "NETWR": amount_text("l_extendedprice"),
            "WAERK": F.when(order % 50 == 0, "EUR").when(order % 2 == 0, "USD").otherwise("CAD"),
            "ABGRU": F.when(F.col("l_returnflag") == "R", "02").otherwise(""),
            "ERDAT": day_text(F.date_add(ship_day(), -5)),
            "AEDAT": day_text(ship_day()),
        },
        loaded(ship_day(), F.lit(0)),
        item_file("VBAP"),
    )


def vbrk(spark: SparkSession, sf_dir: str) -> DataFrame:
    v = F.col("v")
    cancelled = F.when(F.col("o_orderstatus") == "P", 1).otherwise(0)
    changed = F.date_add(bill_day(), v * 3)
    return _raw(
        _versions(table(spark, sf_dir, "orders"), cancelled),
        "VBRK",
        {
            "VBELN": pad(F.col("o_orderkey") + 90_000_000, 10),
            "FKART": F.lit("F2"),
            "FKDAT": day_text(bill_day()),
            "KUNRG": pad("o_custkey", 10),
            "WAERK": currency(),
            "NETWR": amount_text("o_totalprice"),
            "FKSTO": F.when(v == 1, "X").otherwise(""),
            "ERDAT": day_text(bill_day()),
            "AEDAT": F.when(v == 0, empty_date()).otherwise(day_text(changed)),
        },
        loaded(changed, "o_orderkey"),
        file_name("VBRK", changed),
    )


def vbrp(spark: SparkSession, sf_dir: str) -> DataFrame:
    broken = F.col("l_suppkey") % 40
    position = pad(F.col("l_linenumber") * 10, 6)
    return _raw(
        table(spark, sf_dir, "lineitem"),
        "VBRP",
        {
            "VBELN": pad(F.col("l_orderkey") + 90_000_000, 10),
            "POSNR": position,
            "AUBEL": F.when(broken == 0, unknown("l_orderkey"))
            .when(broken == 1, "")
            .otherwise(pad("l_orderkey", 10)),
            "AUPOS": F.when(broken == 2, "000099").otherwise(position),
            "MATNR": pad("l_partkey", 18),
            "FKIMG": (
                F.col("l_quantity").cast("int") + F.when(F.col("l_partkey") % 50 == 0, 100).otherwise(0)
            ).cast("string"),
            "VRKME": F.lit("EA"),
            "NETWR": amount_text("l_extendedprice"),
            "ERDAT": day_text(ship_day()),
            "AEDAT": empty_date(),
        },
        loaded(ship_day(), F.lit(0)),
        item_file("VBRP"),
    )


def likp(spark: SparkSession, sf_dir: str) -> DataFrame:
    delivered = F.date_add(order_day(), (F.col("o_custkey") % 5).cast("int"))
    return _raw(
        table(spark, sf_dir, "orders"),
        "LIKP",
        {
            "VBELN": pad(F.col("o_orderkey") + 70_000_000, 10),
            "LFART": F.lit("LF"),
            "ERDAT": day_text(order_day()),
            "LFDAT": day_text(delivered),
            "KUNNR": pad("o_custkey", 10),
            "AEDAT": empty_date(),
        },
        loaded(delivered, "o_orderkey"),
        file_name("LIKP", delivered),
    )


def lips(spark: SparkSession, sf_dir: str) -> DataFrame:
    position = pad(F.col("l_linenumber") * 10, 6)
    return _raw(
        table(spark, sf_dir, "lineitem"),
        "LIPS",
        {
            "VBELN": pad(F.col("l_orderkey") + 70_000_000, 10),
            "POSNR": position,
            "VGBEL": pad("l_orderkey", 10),
            "VGPOS": F.when(F.col("l_suppkey") % 40 == 3, "000098").otherwise(position),
            "MATNR": pad("l_partkey", 18),
            # Some lines are shipped over; of the others, those that were never returned are not shipped yet.
            "LFIMG": F.when(F.col("l_partkey") % 50 == 1, F.col("l_quantity").cast("decimal(18,3)") + 100)
            .when(F.col("l_returnflag") == "N", F.lit(0))
            .otherwise(F.col("l_quantity").cast("decimal(18,3)") / 2)
            .cast("decimal(18,3)")
            .cast("string"),
            "VRKME": F.lit("EA"),
            "ERDAT": day_text(ship_day()),
            "AEDAT": F.lit(""),
        },
        loaded(ship_day(), F.lit(0)),
        item_file("LIPS"),
    )


def _receivable(amount: Column) -> dict[str, Column]:
    return {
        "BUKRS": F.lit("1000"),
        "BELNR": pad(F.col("o_orderkey") + 1_900_000_000, 10),
        "GJAHR": F.year(bill_day()).cast("string"),
        "BUZEI": F.lit("001"),
        "KUNNR": pad("o_custkey", 10),
        "BLART": F.lit("RV"),
        "BUDAT": day_text(bill_day()),
        "FAEDT": day_text(F.date_add(bill_day(), 30)),
        "ZFBDT": day_text(bill_day()),
        "ZTERM": F.lit("NT30"),
        "WRBTR": amount_text(amount),
        "WAERS": currency(),
        "ZUONR": pad(F.col("o_orderkey") + 90_000_000, 10),
    }


def bsid(spark: SparkSession, sf_dir: str) -> DataFrame:
    off_by_one = F.when(F.col("o_orderkey") % 200 == 7, 1).otherwise(0)
    return _raw(
        table(spark, sf_dir, "orders"),
        "BSID",
        _receivable(F.col("o_totalprice").cast("decimal(18,2)") + off_by_one),
        loaded(bill_day(), "o_orderkey"),
        file_name("BSID", bill_day()),
    )


def bsad(spark: SparkSession, sf_dir: str) -> DataFrame:
    cleared = F.date_add(bill_day(), (F.col("o_custkey") % 40 - 1).cast("int"))
    return _raw(
        table(spark, sf_dir, "orders").filter(F.col("o_orderstatus") == "F"),
        "BSAD",
        {
            **_receivable(F.col("o_totalprice")),
            "AUGDT": day_text(cleared),
            "AUGBL": pad(F.col("o_orderkey") + 1_950_000_000, 10),
        },
        loaded(cleared, "o_orderkey"),
        file_name("BSAD", cleared),
    )


RAW_VIEWS: dict[str, Callable[[SparkSession, str], DataFrame]] = {
    "KNA1": kna1,
    "MARA": mara,
    "MAKT": makt,
    "VBAK": vbak,
    "VBAP": vbap,
    "VBRK": vbrk,
    "VBRP": vbrp,
    "LIKP": likp,
    "LIPS": lips,
    "BSID": bsid,
    "BSAD": bsad,
}


def write_extracts(
    raw: DataFrame, name: str, folder: str, columns: Sequence[str] | None = None, **options: str
) -> None:
    """Write a raw view as extract files `<folder>/<TABLE>/<TABLE>_<month>01_<n>.csv`.

    Every task writes its own file per month, so no month has to fit into one task; the driver
    only renames files. `columns` orders or leaves out columns, `options` go to the writer.
    """
    spark = raw.sparkSession
    month = F.concat(F.regexp_extract(SOURCE_FILE, "[0-9]{6}", 0), F.lit("01"))
    options = {
        "header": "true",
        "escape": '"',
        "emptyValue": "",
        "ignoreLeadingWhiteSpace": "false",
        "ignoreTrailingWhiteSpace": "false",
    } | options
    scratch = f"{folder}/_{name}"
    raw.select(*(columns or RAW_COLUMNS[name]), month.alias("month")).write.options(**options).partitionBy(
        "month"
    ).mode("overwrite").csv(scratch)
    jvm = spark._jvm.org.apache.hadoop.fs
    files = jvm.Path(folder).getFileSystem(spark._jsc.hadoopConfiguration())
    files.mkdirs(jvm.Path(f"{folder}/{name}"))
    written = files.globStatus(jvm.Path(f"{scratch}/month=*/*.csv"))
    for number, status in enumerate(written):
        day = status.getPath().getParent().getName().removeprefix("month=")
        files.rename(status.getPath(), jvm.Path(f"{folder}/{name}/{name}_{day}_{number}.csv"))
