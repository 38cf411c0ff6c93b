"""Cleaning steps: each replaces or adds columns and keeps every row, in one narrow stage."""

from __future__ import annotations

from collections.abc import Mapping, Sequence
from typing import Any

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailmart.functions import (
    Bin,
    after_first as text_after_first,
    after_last as text_after_last,
    bin_label,
    days_between,
    is_missing,
    strip_prefix as without_prefix,
)
from retailmart.operators.joins import join_dimension


def strip_prefix(df: DataFrame, column: str, prefix: str) -> DataFrame:
    return df.withColumn(column, without_prefix(F.col(column), prefix))


def after_first(df: DataFrame, column: str, delim: str) -> DataFrame:
    return df.withColumn(column, text_after_first(F.col(column), delim))


def after_last(df: DataFrame, column: str, delim: str) -> DataFrame:
    return df.withColumn(column, text_after_last(F.col(column), delim))


def sentinels_to_label(
    df: DataFrame,
    columns: Sequence[str],
    sentinels: Sequence[str],
    label: str = "NA",
    case_insensitive: bool = False,
) -> DataFrame:
    """NULLs and placeholder texts become ``label``."""
    return df.withColumns(
        {
            c: F.when(is_missing(F.col(c), sentinels, case_insensitive), label).otherwise(F.col(c))
            for c in columns
        }
    )


def sentinel_to_null(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    """Per column the one value that stands for "none" becomes NULL."""
    return df.withColumns({c: F.nullif(F.col(c), F.lit(v)) for c, v in values.items()})


def null_to_default(df: DataFrame, values: Mapping[str, Any]) -> DataFrame:
    """NULLs become the column's default; column types stay."""
    return df.withColumns(
        {
            c: F.coalesce(F.col(c), F.lit(v).cast(df.schema[c].dataType))
            for c, v in values.items()
        }
    )


def fill_from_lookup(
    df: DataFrame, target: str, source: str, mapping: Mapping[Any, Any], when: Column
) -> DataFrame:
    """Set ``target`` by the value of ``source`` where ``when`` holds and the value is mapped.

    For small fixed mappings; ``fill_from_table`` takes a DataFrame. The mapping
    becomes one literal map, so ``source`` appears once in the expression however
    many values are mapped, and the chain of cleaning steps stays compilable.
    """
    kind, dtype = df.schema[source].dataType, df.schema[target].dataType
    pairs = [F.lit(x).cast(t) for k, v in mapping.items() for x, t in ((k, kind), (v, dtype))]
    found = F.element_at(F.create_map(*pairs), F.col(source))
    return df.withColumn(
        target, F.when(when, F.coalesce(found, F.col(target))).otherwise(F.col(target))
    )


def fill_from_table(
    df: DataFrame, target: str, source: str, table: DataFrame, when: Column
) -> DataFrame:
    """As ``fill_from_lookup``, with one mapping row per ``source`` in a DataFrame."""
    mapping = table.select(source, F.col(target).alias("_filled"))
    filled = F.when(when, F.coalesce(F.col("_filled"), F.col(target))).otherwise(F.col(target))
    return join_dimension(df, mapping, source).withColumn(target, filled).select(*df.columns)


def derive_mapping(df: DataFrame, source: str, target: str) -> DataFrame:
    """(source, target) pairs for the sources that go with one single target value."""
    known = df.filter(F.col(source).isNotNull() & F.col(target).isNotNull())
    return (
        known.groupBy(source)
        .agg(F.min(target).alias(target), F.max(target).alias("_other"))
        .filter(F.col(target) == F.col("_other"))
        .drop("_other")
    )


def fill_by_product(df: DataFrame, total: str, quantity: str, price: str) -> DataFrame:
    """Fill whichever of total = quantity x price is missing, when the other two are known.

    Filling total, price and quantity one after the other comes to the same, as a
    step that fires leaves nothing to fill. A zero divisor leaves the value missing.
    """
    types = {c: df.schema[c].dataType for c in (total, quantity, price)}
    t, q, p = F.col(total), F.col(quantity), F.col(price)
    values = {
        total: q * p,
        price: t / F.when(q != 0, q),
        quantity: F.round(t / F.when(p != 0, p), 0),
    }
    return df.withColumns(
        {c: F.coalesce(F.col(c), v.cast(types[c])) for c, v in values.items()}
    )


def scale_and_rename(
    df: DataFrame, column: str, new: str, factor: int, digits: int, dtype: str | None = None
) -> DataFrame:
    """``column`` times ``factor``, rounded, under a new name in the same place."""
    dtype = dtype or df.schema[column].dataType.simpleString()
    scaled = F.round(F.col(column) * F.lit(factor), digits).cast(dtype)
    return df.withColumn(column, scaled).withColumnRenamed(column, new)


def duration_days(df: DataFrame, start: str, end: str, out: str) -> DataFrame:
    return df.withColumn(out, days_between(F.col(start), F.col(end)))


def bin_column(
    df: DataFrame, column: str, bins: Sequence[Bin], otherwise: str, out: str
) -> DataFrame:
    return df.withColumn(out, bin_label(F.col(column), bins, otherwise))


def validity_flag(df: DataFrame, columns: Sequence[str], out: str) -> DataFrame:
    """0 where all ``columns`` are NULL, else 1."""
    known = F.lit(False)
    for c in columns:
        known = known | F.col(c).isNotNull()
    return df.withColumn(out, F.when(known, 1).otherwise(0))
