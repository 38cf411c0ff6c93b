"""Profiling and data-quality checks. Each returns a lazy DataFrame."""

from __future__ import annotations

from collections.abc import Mapping, Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailmart.functions import is_missing, visible_length
from retailmart.operators.joins import HOT_KEYS, hot_key_join
from retailmart.operators.totals import exact_mean


def row_count(df: DataFrame, out: str = "total_rows") -> DataFrame:
    return df.agg(F.count("*").alias(out))


def range_profile(
    df: DataFrame,
    stats: Mapping[str, tuple[str, str]],
    by: Sequence[str] = (),
    scale: Mapping[str, float] | None = None,
    digits: Mapping[str, int] | None = None,
) -> DataFrame:
    """``stats`` {output: (min|max|avg, column)}, overall or per ``by`` key.

    Means of whole numbers are truncated to whole numbers, as integer averages
    are on the database the jobs stem from. ``scale`` divides an output,
    ``digits`` rounds it.
    """
    scale, digits = scale or {}, digits or {}
    aggs = []
    for out, (stat, column) in stats.items():
        if stat == "avg":
            whole = isinstance(df.schema[column].dataType, T.IntegralType)
            value = exact_mean(df, column, digits.get(out))
            if whole:
                mean = F.sum(column) / F.count(column)
                value = F.when(mean < 0, F.ceil(mean)).otherwise(F.floor(mean))
        else:
            value = {"min": F.min, "max": F.max}[stat](column)
            if out in digits:
                value = F.round(value, digits[out])
        if out in scale:
            value = value.cast("double") / F.lit(float(scale[out]))
        aggs.append(value.alias(out))
    return df.groupBy(*by).agg(*aggs)


def duplicate_keys(df: DataFrame, keys: Sequence[str], out: str = "duplicate_count") -> DataFrame:
    """Keys occurring more than once; ``null_key`` tells keys with a NULL apart."""
    null_key = F.lit(False)
    for k in keys:
        null_key = null_key | F.col(k).isNull()
    return (
        df.groupBy(*keys)
        .agg(F.count("*").alias(out))
        .filter(F.col(out) > 1)
        .withColumn("null_key", null_key)
    )


def duplicate_rows(
    df: DataFrame, keys: Sequence[str], columns: Sequence[str], out: str = "duplicate_count"
) -> DataFrame:
    """``columns`` of every row whose key occurs more than once, with the count.

    The counts are joined back rather than taken in a window over each key, and
    they tell which keys are hot.
    """
    counts = df.groupBy(*keys).agg(F.count("*").alias(out))
    all_rows = counts.agg(F.sum(out)).scalar()
    hot = counts.filter(F.col(out) * HOT_KEYS > all_rows)
    needed = list(dict.fromkeys([*keys, *columns]))
    return hot_key_join(
        df.select(*needed), counts.filter(F.col(out) > 1), keys, "inner", null_safe=True, hot=hot
    ).select(*columns, out)


def completeness(df: DataFrame, columns: Sequence[str], mode: str = "present") -> DataFrame:
    """One row: ``total_rows`` and per column the values present or missing."""
    if mode not in ("present", "missing"):
        raise ValueError(f"mode is present or missing, not {mode!r}")
    count = F.count if mode == "present" else (lambda c: F.count("*") - F.count(c))
    return df.agg(F.count("*").alias("total_rows"), *[count(c).alias(c) for c in columns])


def sentinel_count(
    df: DataFrame,
    column: str,
    sentinels: Sequence[str],
    out: str = "missing_rows",
    case_insensitive: bool = False,
) -> DataFrame:
    """Rows whose value is NULL or a placeholder."""
    return df.agg(F.count_if(is_missing(F.col(column), sentinels, case_insensitive)).alias(out))


def breaks_prefix_or_length(column: str, prefix: str, max_length: int) -> Column:
    """The rule for keys: begins with ``prefix``, at most ``max_length`` characters."""
    c = F.col(column)
    return ~c.startswith(prefix) | (visible_length(c) > max_length)


def breaks_parse(column: str, parsed: Column) -> Column:
    """The rule for text dates: a non-NULL text must yield a value when parsed."""
    return F.col(column).isNotNull() & parsed.isNull()


def conformance(df: DataFrame, broken: Column, out: str = "broken_rows") -> DataFrame:
    """Rows that break a rule; rows for which the rule is NULL are not counted."""
    return df.agg(F.count_if(broken).alias(out))


def category_frequency(
    df: DataFrame,
    column: str,
    out: str = "n_rows",
    where: Column | None = None,
    descending: bool = True,
) -> DataFrame:
    """Rows per value, NULL being a value of its own, by frequency and then by value."""
    if where is not None:
        df = df.filter(where)
    counted = df.groupBy(column).agg(F.count("*").alias(out))
    return counted.orderBy(F.col(out).desc() if descending else F.col(out).asc(), column)


def profile_frequencies(
    df: DataFrame, columns: Sequence[str] | Mapping[str, tuple[str, Column | None]], out: str = "n_rows"
) -> DataFrame:
    """The frequencies of many columns from one scan: (column_name, value, ``out``), values as text, NULL one of them.

    ``columns`` are names, or {name: (column, filter)} to count a column under conditions of its own. Each row is
    unpivoted where it is and folded in its task, so that one row per column and value leaves it; the rows equal those
    of ``category_frequency`` column by column.
    """
    if not isinstance(columns, Mapping):
        columns = {c: (c, None) for c in columns}
    counted = [
        F.struct(
            F.lit(name).alias("column_name"),
            F.col(column).cast("string").alias("value"),
            (F.lit(True) if where is None else F.coalesce(where, F.lit(False))).alias("kept"),
        )
        for name, (column, where) in columns.items()
    ]
    pairs = F.array(*counted)
    if any(where is not None for _, where in columns.values()):
        pairs = F.filter(pairs, lambda pair: pair["kept"])
    unpivoted = df.select(F.explode(pairs).alias("pair"))
    return unpivoted.groupBy(F.col("pair.column_name"), F.col("pair.value")).agg(F.count("*").alias(out))


def profile(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    """One row per column, from one scan: rows, missing and different values, the most frequent value and its rows.

    Of equally frequent values the first in text order is shown. An empty frame has no rows.
    """
    n, value = F.col("n_rows"), F.col("value")
    known = value.isNotNull()
    first = F.min(F.when(known, F.struct((-n).alias("less"), value.alias("value")))).alias("_first")
    folded = profile_frequencies(df, columns).groupBy("column_name").agg(
        F.sum(n).alias("total_rows"),
        F.coalesce(F.sum(F.when(~known, n)), F.lit(0)).alias("missing"),
        F.count_if(known).alias("distinct_values"),
        first,
    )
    return folded.select(
        "column_name",
        "total_rows",
        "missing",
        "distinct_values",
        F.col("_first.value").alias("top_value"),
        (-F.col("_first.less")).alias("top_rows"),
    )


def distinct_values(df: DataFrame, columns: Sequence[str]) -> DataFrame:
    return df.select(*columns).distinct()


def distinct_count(
    df: DataFrame, columns: Sequence[str], exact: bool = True, rsd: float = 0.05
) -> DataFrame:
    """Distinct non-NULL values of each column, in one row.

    Exact counts expand the rows once per column; ``exact=False`` takes one pass
    with bounded state.
    """
    count = F.count_distinct if exact else (lambda c: F.approx_count_distinct(c, rsd))
    return df.agg(*[count(F.col(c)).alias(c) for c in columns])


# Registers of a sketch as a power of two: 16,384 give a relative standard error of 0.8 %.
SKETCH_BITS = 14


def sketch_error(bits: int = SKETCH_BITS) -> float:
    """The relative standard error of a sketch's estimate."""
    return 1.04 / 2 ** (bits / 2)


def distinct_sketches(
    df: DataFrame, by: Sequence[str | Column], columns: Sequence[str], bits: int = SKETCH_BITS
) -> DataFrame:
    """Per ``by`` group a sketch of the different non-NULL values of each column, as binary under the column's name.

    Sketches are small whatever the group, can be stored, e.g. one row a month, and united later without the rows.
    """
    return df.groupBy(*by).agg(*[F.hll_sketch_agg(F.col(c), F.lit(bits)).alias(c) for c in columns])


def united_distinct_count(sketches: DataFrame, columns: Sequence[str], by: Sequence[str] = ()) -> DataFrame:
    """Estimated different values over all groups of stored sketches, overall or per ``by``."""
    return sketches.groupBy(*by).agg(*[F.hll_sketch_estimate(F.hll_union_agg(c)).alias(c) for c in columns])


def orphan_keys(
    fact: DataFrame, dim: DataFrame, key: str, dim_key: str | None = None, out: str = "n_rows"
) -> DataFrame:
    """Fact keys that the dimension lacks, with their rows; NULL is no orphan.

    The fact is folded to one row per key first, so the anti join has no hot key.
    """
    used = fact.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias(out))
    return used.join(dim.select(F.col(dim_key or key).alias(key)), key, "left_anti")


def co_missing(df: DataFrame, columns: Sequence[str], out: str = "n_rows") -> DataFrame:
    """Rows per pattern of missing columns (1 = missing)."""
    flags = [F.col(c).isNull().cast("int").alias(f"{c}_missing") for c in columns]
    return df.groupBy(*flags).agg(F.count("*").alias(out))


def row_with_global_stats(
    df: DataFrame, column: str, avg: str, low: str, high: str
) -> DataFrame:
    """Each row beside mean, minimum and maximum of ``column`` over all rows.

    The three figures are one scalar subquery; the rows stay where they are.
    Means of whole numbers are truncated.
    """
    profile = range_profile(
        df, {avg: ("avg", column), low: ("min", column), high: ("max", column)}
    )
    stats = profile.select(F.struct(avg, low, high).alias("stats")).scalar()
    return df.withColumns({name: stats[name] for name in (avg, low, high)})


def group_count_extremes(
    df: DataFrame, key: str, out: str = "n_rows", high: str = "max_rows", low: str = "min_rows"
) -> DataFrame:
    """Rows per non-NULL key beside the largest and the smallest group."""
    counted = df.filter(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias(out))
    ends = counted.agg(
        F.struct(F.max(out).alias(high), F.min(out).alias(low)).alias("ends")
    ).scalar()
    return counted.withColumns({high: ends[high], low: ends[low]})

