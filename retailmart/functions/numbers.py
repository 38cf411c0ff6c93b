"""Ratios, percentages and number texts.

A zero divisor yields NULL. Rounding is half away from zero and is meant for
decimals: operators hand in sums narrowed to ``decimal(20, s)`` (see
``operators.totals``), which leaves Spark at least 14 fraction digits in the
quotient, so rounding to two places is not disturbed by an earlier rounding.
Without ``digits`` the quotient is a double.
"""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F


def ratio(num: Column, den: Column, digits: int | None = None) -> Column:
    if digits is None:
        return num.cast("double") / F.nullif(den.cast("double"), F.lit(0.0))
    return F.round(num / F.nullif(den, F.lit(0).cast("int")), digits)


def percent(part: Column, whole: Column, digits: int | None = 2) -> Column:
    if digits is None:
        return F.lit(100.0) * part.cast("double") / F.nullif(whole.cast("double"), F.lit(0.0))
    return ratio(F.lit(100) * part, whole, digits)


def percent_text(pct: Column) -> Column:
    """``1234.565`` as ``1,234.57 %``.

    ``format_number`` rounds half to even, hence the explicit rounding first.
    """
    return F.concat(F.format_number(F.round(pct, 2), 2), F.lit(" %"))
