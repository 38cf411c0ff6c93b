"""Column-level building blocks; every function takes and returns ``Column``."""

from retailmart.functions.bins import Bin, bin_label
from retailmart.functions.dates import (
    days_between,
    month_name,
    month_start,
    parse_dmy_date,
    parse_dmy_timestamp,
    weekday_name,
)
from retailmart.functions.numbers import percent, percent_text, ratio
from retailmart.functions.text import (
    after_first,
    after_last,
    is_missing,
    strip_prefix,
    visible_length,
)

__all__ = [
    "Bin",
    "after_first",
    "after_last",
    "bin_label",
    "days_between",
    "is_missing",
    "month_name",
    "month_start",
    "parse_dmy_date",
    "parse_dmy_timestamp",
    "percent",
    "percent_text",
    "ratio",
    "strip_prefix",
    "visible_length",
    "weekday_name",
]
