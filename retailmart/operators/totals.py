"""Grouped totals and what is computed from them: shares, means, order values."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from decimal import Decimal

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailmart.functions import percent, ratio

# Sums of money: 20 digits, or more where the scale needs them, hold any total below
# 10**18 (an overflow raises) and leave room for fraction digits when Spark divides them.
SUM_PRECISION = 20
WORD_DIGITS = 18


def exact_sum(df: DataFrame, column: str) -> Column:
    """``sum(column)``; for decimals of up to 18 digits as ``decimal(max(20, 18 + s), s)``.

    Wider ones keep Spark's own type of the sum, ten digits more. Decimals of up to 18 digits are summed as whole numbers of their last place:
    a sum Spark keeps in a machine word, in half the time of a decimal sum.
    """
    dtype = df.schema[column].dataType
    if not isinstance(dtype, T.DecimalType):
        return F.sum(column)
    if dtype.precision > WORD_DIGITS:
        return F.sum(column)
    total = T.DecimalType(max(SUM_PRECISION, WORD_DIGITS + dtype.scale), dtype.scale)
    units = F.sum((F.col(column) * F.lit(10**dtype.scale)).cast("bigint"))
    unit = F.lit(Decimal(1).scaleb(-dtype.scale))
    return (units.cast(T.DecimalType(SUM_PRECISION, 0)) * unit).cast(total)


def exact_mean(df: DataFrame, column: str, digits: int | None = None) -> Column:
    """Mean of the non-NULL values; a double unless rounded to ``digits``."""
    return ratio(exact_sum(df, column), F.count(column), digits)


def group_totals(
    df: DataFrame,
    keys: Sequence[str | Column],
    sums: Mapping[str, str],
    count: str | None = None,
    counts: Mapping[str, str] | None = None,
) -> DataFrame:
    """Per key: ``sums`` {output: column}, all rows as ``count``, non-NULL ``counts``.

    Sums and counts are combined on the map side, so a key holding most of the
    rows costs the reducer one row per map task.
    """
    aggs = [exact_sum(df, c).alias(out) for out, c in sums.items()]
    if count:
        aggs.append(F.count("*").alias(count))
    aggs += [F.count(c).alias(out) for out, c in (counts or {}).items()]
    return df.groupBy(*keys).agg(*aggs)


def grand_totals(totals: DataFrame, columns: Sequence[str]) -> Column:
    """One struct with the sum of each column over all rows, as a scalar subquery.

    The subquery runs over the same aggregate as the query around it; naming all
    its summed columns keeps both plans equal, so Spark computes the shuffle once.
    """
    fields = [exact_sum(totals, c).alias(c) for c in columns]
    return totals.agg(F.struct(*fields).alias("totals")).scalar()


def add_shares(
    totals: DataFrame,
    shares: Mapping[str, str],
    digits: int | None = 2,
    summed: Sequence[str] | None = None,
) -> DataFrame:
    """Add ``shares`` {output: column} as percent of the column's grand total."""
    whole = grand_totals(totals, list(summed or dict.fromkeys(shares.values())))
    return totals.withColumns(
        {out: percent(F.col(c), whole[c], digits) for out, c in shares.items()}
    )


def contribution(
    df: DataFrame,
    keys: Sequence[str | Column],
    sums: Mapping[str, str],
    shares: Mapping[str, str],
    count: str | None = None,
    counts: Mapping[str, str] | None = None,
    digits: int | None = 2,
) -> DataFrame:
    """Totals per key and each key's share of the grand total."""
    totals = group_totals(df, keys, sums, count, counts)
    summed = [*sums, *([count] if count else []), *(counts or {})]
    return add_shares(totals, shares, digits, summed)


def average_order_value(
    df: DataFrame,
    measure: str,
    by: Sequence[str | Column] = (),
    out: str = "aov",
    digits: int = 2,
) -> DataFrame:
    """Total of ``measure`` over the number of rows that have one, overall or per key.

    Keys without a measured row are dropped. That is decided on the counts, not
    by a filter on ``measure``: pushed down into the steps that compute a filled-in
    measure, such a filter would compute it twice.
    """
    value = ratio(exact_sum(df, measure), F.count(measure), digits)
    totals = df.groupBy(*by).agg(value.alias(out), F.count(measure).alias("_measured"))
    if by:
        totals = totals.filter(F.col("_measured") > 0)
    return totals.drop("_measured")


def totals_by_attribute(
    fact: DataFrame,
    dim: DataFrame,
    key: str,
    attributes: Sequence[str],
    sums: Mapping[str, str],
    count: str | None = None,
    counts: Mapping[str, str] | None = None,
    also_by: Sequence[str] = (),
    how: str = "left",
    key_count: str | None = None,
) -> DataFrame:
    """Totals per dimension attribute, aggregated by key *before* the join.

    ``key_count`` names a further column for the number of distinct keys.

    Only one row per key meets the dimension, so neither side of the join is
    fact-sized and a hot key has already been folded into one row.
    """
    per_key = group_totals(fact, [key, *also_by], sums, count, counts)
    joined = per_key.join(dim.select(key, *attributes), key, how)
    measures = [*sums, *([count] if count else []), *(counts or {})]
    if key_count and also_by:
        raise ValueError("keys are counted only where each key is in one group")
    return joined.groupBy(*attributes, *also_by).agg(
        *[exact_sum(per_key, m).alias(m) for m in measures],
        *([F.count(key).alias(key_count)] if key_count else []),
    )
