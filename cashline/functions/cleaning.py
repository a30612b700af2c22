"""Turn extract text into typed values. Blank text is NULL everywhere."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

EMPTY_DATE = "00000000"


def _column(c: Column | str) -> Column:
    return F.col(c) if isinstance(c, str) else c


def sap_text(c: Column | str) -> Column:
    """Text without surrounding spaces; blank becomes NULL."""
    return F.nullif(F.trim(_column(c)), F.lit(""))


def parse_day(text: Column) -> Column:
    """`YYYYMMDD` text as a date. Anything else raises in ANSI mode and is NULL outside it.

    Eight characters whose number lies in this range can only be eight digits, so these are
    split by arithmetic, several times faster than a pattern. The pattern parser decides on
    all other text.
    """
    number = text.try_cast("int")
    return F.when(
        (F.length(text) == 8) & number.between(10000101, 99991231),
        F.make_date(
            (number / 10000).cast("int"),
            F.pmod((number / 100).cast("int"), F.lit(100)),
            F.pmod(number, F.lit(100)),
        ),
    ).otherwise(F.to_date(text, "yyyyMMdd"))


def sap_date(c: Column | str, *, strict: bool = True) -> Column:
    """`YYYYMMDD` text as a date; blank and `00000000` become NULL.

    Any other text that is no date raises, whether the session is in ANSI mode or not, unless `strict`
    is off, when it becomes NULL.
    """
    text = F.trim(_column(c))
    no_date = F.raise_error(F.concat(F.lit("not a date of the form YYYYMMDD: "), text))
    day = F.coalesce(parse_day(text), no_date) if strict else F.try_to_date(text, "yyyyMMdd")
    return F.when(text.isNull() | text.isin("", EMPTY_DATE), F.lit(None).cast("date")).otherwise(day)


def sap_amount(c: Column | str) -> Column:
    """Amount with two decimals; text that is no number becomes NULL."""
    return sap_text(c).try_cast("decimal(18,2)")


def sap_quantity(c: Column | str) -> Column:
    """Quantity with three decimals; text that is no number becomes NULL."""
    return sap_text(c).try_cast("decimal(18,3)")


def flag_set(c: Column | str, mark: str = "X") -> Column:
    """True where the flag column holds the mark, False otherwise, never NULL."""
    return F.coalesce(F.trim(_column(c)) == F.lit(mark), F.lit(False))
