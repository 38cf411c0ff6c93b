"""Change from one period to the next."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retailmart.functions import percent


def fill_months(df: DataFrame, period: str) -> DataFrame:
    """Add the missing month starts between the first and the last, NULL otherwise.

    Each month brings along the empty months up to the next one, so the months
    are computed once and need no join.
    """
    following = F.lead(period).over(Window.orderBy(period))
    last = F.coalesce(F.add_months("_next", -1), F.col(period))
    months = df.withColumn("_next", following).withColumn(
        "_month", F.explode(F.sequence(F.col(period), last, F.expr("interval 1 month")))
    )
    own = F.col("_month") == F.col(period)
    return months.select(
        *[
            F.col("_month").alias(c) if c == period else F.when(own, F.col(c)).alias(c)
            for c in df.columns
        ]
    )


def period_change(
    df: DataFrame,
    period: str,
    measure: str,
    previous: str = "previous",
    change: str = "change_pct",
    fill_calendar: bool = False,
    digits: int = 2,
) -> DataFrame:
    """Add the previous period's ``measure`` and the change in percent.

    ``df`` has one row per month or longer calendar period, so the single ordered
    window is bounded by the calendar. "Previous" is the row before; with
    ``fill_calendar`` (``period`` a month start) months without rows come first.
    """
    if fill_calendar:
        df = fill_months(df, period)
    prior = F.lag(measure).over(Window.orderBy(period))
    return df.withColumn(previous, prior).withColumn(
        change, percent(F.col(measure) - F.col(previous), F.col(previous), digits)
    )
