import datetime as dt
import hashlib
from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from cashline import functions as fn
from conftest import collected, plan_of


def values(spark, rows, *columns, schema="t string"):
    return collected(spark.createDataFrame([(r,) for r in rows], schema).select(*columns))


def test_text_blank_is_null(spark):
    got = values(spark, ["  a b ", "  ", "", None, "\tx"], fn.sap_text("t"))
    assert [g[0] for g in got] == ["a b", None, None, None, "\tx"]


def test_date_empty_forms_are_null(spark):
    got = values(spark, ["20260131", " 20240229 ", "00000000", "", "   ", None], fn.sap_date("t"))
    assert [g[0] for g in got] == [dt.date(2026, 1, 31), dt.date(2024, 2, 29), None, None, None, None]


@pytest.mark.parametrize(
    "bad", ["20261340", "20260230", "2026113", "2026-1-5", "+9990101", "9990101\t", "2026011T", "202601011"]
)
def test_bad_date_raises_or_becomes_null(spark, bad):
    with pytest.raises(Exception):
        values(spark, [bad], fn.sap_date("t"))
    assert values(spark, [bad], fn.sap_date("t", strict=False)) == [(None,)]


def test_fast_date_equals_pattern_parser(spark):
    days = spark.range(0, 60000, 7).select(
        F.date_format(F.date_add(F.lit("1900-01-01").cast("date"), F.col("id").cast("int")), "yyyyMMdd").alias("t")
    )
    wrong = days.filter(~fn.sap_date("t").eqNullSafe(F.to_date("t", "yyyyMMdd")))
    assert wrong.count() == 0
    assert values(spark, ["09991231", "00010101"], fn.sap_date("t")) == [
        (dt.date(999, 12, 31),),
        (dt.date(1, 1, 1),),
    ]


def test_amount_and_quantity(spark):
    got = values(
        spark,
        ["1234.50", " 7 ", "abc", "100.00-", "1,000", "", "1e2", "0.005"],
        fn.sap_amount("t"),
        fn.sap_quantity("t"),
    )
    assert [g[0] for g in got] == [
        Decimal("1234.50"), Decimal("7.00"), None, None, None, None, Decimal("100.00"), Decimal("0.01"),
    ]
    assert got[1][1] == Decimal("7.000") and got[7][1] == Decimal("0.005")


def test_flag(spark):
    got = values(spark, ["X", "X ", "", None, "x"], fn.flag_set("t"))
    assert [g[0] for g in got] == [True, True, False, False, False]


def test_keys(spark):
    df = spark.createDataFrame([("a", "b"), ("a", None)], "x string, y string")
    assert collected(df.select(fn.surrogate_key("x", "y"), fn.fingerprint("x", "y"))) == [
        (hashlib.md5(b"a|b").hexdigest(), "a|b"),
        (None, "a|"),
    ]


def test_calendar_expressions(spark):
    day = F.lit(dt.date(2026, 2, 28))
    got = spark.range(1).select(
        fn.is_weekend(day), fn.month_name(day), fn.day_name(day), fn.year_number(day),
        fn.quarter_number(day), fn.month_number(day), fn.add_days(day, 1), fn.month_start(day),
        fn.days_between(day, F.lit(dt.date(2026, 1, 28))), fn.days_between(day, F.lit(None).cast("date")),
    )
    assert tuple(got.first()) == (
        True, "February", "Saturday", 2026, 1, 2, dt.date(2026, 3, 1), dt.date(2026, 2, 1), 31, None,
    )
    assert dict(got.dtypes)[got.columns[3]] == "bigint"


def test_date_from_file_name(spark):
    assert values(spark, ["KNA1_20260105.csv"], fn.date_from_file_name("t")) == [(dt.date(2026, 1, 5),)]
    with pytest.raises(Exception):
        values(spark, ["KNA1.csv"], fn.date_from_file_name("t"))


def test_currency_rounds_half_up_and_needs_a_rate(spark):
    df = spark.createDataFrame(
        [(Decimal("0.50"), Decimal("0.730000")), (Decimal("9.99"), None)],
        "v decimal(18,2), r decimal(9,6)",
    )
    assert collected(df.select(fn.to_reporting_currency("v", "r"))) == [(Decimal("0.37"),), (None,)]


@pytest.mark.parametrize("ansi", ["true", "false"])
@pytest.mark.parametrize("text", ["20261340", "soon", "2026-01-01", "20260230"])
def test_strict_dates_raise_with_and_without_ansi(spark, ansi, text):
    before = spark.conf.get("spark.sql.ansi.enabled")
    spark.conf.set("spark.sql.ansi.enabled", ansi)
    try:
        dates = spark.createDataFrame([(text,)], "t string")
        with pytest.raises(Exception):
            dates.select(fn.sap_date("t")).collect()
        assert dates.select(fn.sap_date("t", strict=False)).first()[0] is None
        fine = spark.createDataFrame([(None,), (" ",), ("00000000",), ("20260131",)], "t string")
        assert [str(r[0]) for r in fine.select(fn.sap_date("t")).collect()] == ["None", "None", "None", "2026-01-31"]
    finally:
        spark.conf.set("spark.sql.ansi.enabled", before)


def test_a_filter_on_the_date_of_a_file_finds_its_digits_once(spark):
    """A filter computes each part again wherever it is named."""
    names = spark.createDataFrame([("VBAK_20260105_7.csv",), ("VBAK_20260106_00010101.csv",)], "file string")
    late = names.filter(fn.date_from_file_name("file") > "2026-01-05")
    assert [r["file"] for r in late.collect()] == ["VBAK_20260106_00010101.csv"]
    condition = next(line for line in plan_of(late).splitlines() if "Filter" in line)
    assert condition.count("regexp_extract") == 1
