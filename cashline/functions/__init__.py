"""Column expressions: text cleaning, dates, keys and money. All stay JVM-side."""

from cashline.functions.cleaning import (
    flag_set,
    sap_amount,
    sap_date,
    sap_quantity,
    sap_text,
)
from cashline.functions.dates import (
    OPEN_END,
    add_days,
    date_from_file_name,
    day_name,
    days_between,
    is_weekend,
    month_name,
    month_number,
    month_start,
    quarter_number,
    year_number,
)
from cashline.functions.keys import fingerprint, surrogate_key
from cashline.functions.money import to_reporting_currency

__all__ = [
    "OPEN_END",
    "add_days",
    "date_from_file_name",
    "day_name",
    "days_between",
    "fingerprint",
    "flag_set",
    "is_weekend",
    "month_name",
    "month_number",
    "month_start",
    "quarter_number",
    "sap_amount",
    "sap_date",
    "sap_quantity",
    "sap_text",
    "surrogate_key",
    "to_reporting_currency",
    "year_number",
]
