"""Running totals and cumulative shares."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailmart.functions import percent
from retailmart.operators.joins import HOT_KEYS, hot_key_join
from retailmart.operators.totals import exact_sum, grand_totals, group_totals
from retailmart.sources.files import stored

# Positions are 64-bit integers cut into 22 + 21 + 21 bits, so that no window
# below sees more than 2**22 rows, whatever the data.
LOW_BITS = 21
MID_BITS = 21
NULL_POSITION = 2**62
# Different values of any other order that one range holds, and one window sees.
RANGE_VALUES = 2**20


def order_position(df: DataFrame, order: str, descending: bool) -> Column | None:
    """An integer that sorts like ``order``; NULLs come first ascending, last descending. None for types without one."""
    dtype = df.schema[order].dataType
    c = F.col(order)
    if isinstance(dtype, T.DateType):
        position = F.unix_date(c).cast("bigint")
    elif isinstance(dtype, T.DecimalType):
        position = (c * F.lit(10**dtype.scale)).cast("bigint")
    elif isinstance(dtype, T.IntegralType):
        position = c.cast("bigint")
    else:
        return None
    if descending:
        return F.coalesce(-position, F.lit(NULL_POSITION))
    return F.coalesce(position, F.lit(-NULL_POSITION))


def running_total(
    df: DataFrame,
    order: str,
    measure: str,
    out: str = "running_total",
    descending: bool = False,
    calendar_order: bool = False,
    before: str | None = None,
    few_rows: bool = False,
) -> DataFrame:
    """Add the sum of ``measure`` over all rows up to this one in ``order``.

    Rows that tie in ``order`` share one value; ``before`` names a further column
    for the sum ahead of the tie. ``calendar_order`` says that
    ``order`` is a calendar period with one row each: the calendar bounds the
    number of rows, and a plain ordered window is enough. ``few_rows`` states the same of
    rows that are few for another reason, say one per member of a small dimension; rows
    may tie there. Otherwise the sum is
    taken at three levels of ever coarser positions, each in windows of bounded
    size, and the offsets of the coarser levels are joined back; rows of frequent
    positions meet a broadcast, so that no tie is gathered in one task.

    Dates, whole numbers and decimals have such positions. Any other order that sorts
    (timestamps, text, doubles) is cut into ranges at values that Spark samples, see
    ``_over_ranges``.
    """
    dtype = df.agg(exact_sum(df, measure).alias("s")).schema["s"].dataType
    if calendar_order or few_rows:
        by = F.col(order).desc() if descending else F.col(order).asc()
        upto = Window.orderBy(by)
        added = {out: F.sum(measure).over(upto).cast(dtype)}
        if before:
            ties = upto.rangeBetween(Window.currentRow, Window.currentRow)
            added[before] = (F.sum(measure).over(upto) - F.sum(measure).over(ties)).cast(dtype)
        return df.withColumns(added)

    position = order_position(df, order, descending)
    if position is None:
        return _over_ranges(df, order, measure, out, descending, before, dtype)
    placed = df.withColumn("_pos", position)
    low = (
        placed.groupBy("_pos")
        .agg(exact_sum(placed, measure).alias("_step"), F.count("*").alias("_rows"))
        .withColumn("_mid", F.shiftright("_pos", LOW_BITS))
    )
    mid = (
        low.groupBy("_mid")
        .agg(F.sum("_step").alias("_mid_sum"))
        .withColumn("_high", F.shiftright("_mid", MID_BITS))
    )
    high = mid.groupBy("_high").agg(F.sum("_mid_sum").alias("_high_sum"))

    # Sum of everything before the row's own high part: at most 2**22 rows.
    earlier = Window.rowsBetween(Window.unboundedPreceding, -1)
    nothing = F.lit(0)
    high_before = F.sum("_high_sum").over(earlier.orderBy("_high"))
    high = high.select("_high", F.coalesce(high_before, nothing).alias("_high_before"))
    mid = mid.join(high, "_high").select(
        "_mid",
        (
            F.col("_high_before")
            + F.coalesce(
                F.sum("_mid_sum").over(earlier.partitionBy("_high").orderBy("_mid")), nothing
            )
        ).alias("_before"),
    )
    upto = F.col("_before") + F.sum("_step").over(Window.partitionBy("_mid").orderBy("_pos"))
    steps = low.join(mid, "_mid").select(
        "_pos",
        upto.cast(dtype).alias(out),
        *([(upto - F.col("_step")).cast(dtype).alias(before)] if before else []),
    )
    # Rows that tie on a frequent position stay where they are.
    hot = low.filter(F.col("_rows") * HOT_KEYS > low.agg(F.sum("_rows")).scalar())
    return hot_key_join(placed, steps, "_pos", "inner", hot=hot).drop("_pos")


def _over_ranges(
    df: DataFrame, order: str, measure: str, out: str, descending: bool, before: str | None, dtype: T.DataType
) -> DataFrame:
    """The running total by an order of any type: ranges of values, a sum ahead of each range, a window in each.

    Ties are folded to one row per value, and the values are written with the number of their range, so that what
    follows sees the same ranges. A range holds about ``RANGE_VALUES`` values, however frequent one is; the sums ahead
    are one row per range and are broadcast. NULLs sort first ascending and last descending, NaN above all numbers.
    """
    by = F.col(order).desc_nulls_last() if descending else F.col(order).asc_nulls_first()
    folded = df.groupBy(order).agg(exact_sum(df, measure).alias("_step"), F.count("*").alias("_rows"))
    folded = stored(folded, "running-values")
    n_values, n_rows = folded.agg(F.count("*"), F.sum("_rows")).first()
    tasks = int(df.sparkSession.conf.get("spark.sql.shuffle.partitions"))
    ranges = max(tasks, -(-n_values // RANGE_VALUES))
    steps = folded.repartitionByRange(ranges, by).withColumn("_range", F.spark_partition_id())
    steps = stored(steps, "running-ranges")

    earlier = Window.orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    sums = steps.groupBy("_range").agg(F.sum("_step").alias("_sum"))
    ahead = sums.select("_range", F.coalesce(F.sum("_sum").over(earlier), F.lit(0)).alias("_ahead"))
    inside = F.sum("_step").over(Window.partitionBy("_range").orderBy(by))
    upto = F.col("_ahead") + F.coalesce(inside, F.lit(0))
    totals = steps.join(F.broadcast(ahead), "_range").select(
        order,
        upto.cast(dtype).alias(out),
        *([(upto - F.coalesce("_step", F.lit(0))).cast(dtype).alias(before)] if before else []),
    )
    hot = folded.filter(F.col("_rows") * HOT_KEYS > (n_rows or 0)).select(order)
    joined = hot_key_join(df, totals, order, "inner", null_safe=True, hot=hot)
    return joined.select(*df.columns, out, *([before] if before else []))


def pareto(
    df: DataFrame,
    key: str,
    measure: str,
    total: str = "total",
    share: str = "share_pct",
    cumulative: str = "cumulative_pct",
    threshold: float | None = None,
    leave_out: str | None = None,
    digits: int = 2,
    few_keys: bool = False,
) -> DataFrame:
    """Total per key, its share and the cumulative share by falling total.

    Keys with equal totals share one cumulative value. With ``threshold`` only
    the leading keys are kept that are needed to reach that cumulative share.
    Keys without any measure are dropped, and so is the key ``leave_out`` (and
    NULL with it). ``few_keys`` states that there are few different keys whatever the
    data; a plain window over their totals is then enough.
    """
    totals = group_totals(df, [key], {total: measure})
    counted = F.col(total)
    if leave_out is not None:
        # One condition on key and total stays above the aggregate. A filter on
        # the key alone would be pushed into the steps that clean the key.
        counted = F.when(F.col(key) != leave_out, counted)
    totals = totals.filter(counted.isNotNull())
    whole = grand_totals(totals, [total])
    ranked = running_total(totals, total, total, "_running", descending=True, before="_before", few_rows=few_keys)
    if threshold is not None:
        ranked = ranked.filter(percent(F.col("_before"), whole[total], None) < threshold)
    return ranked.select(
        key,
        total,
        percent(F.col(total), whole[total], digits).alias(share),
        percent(F.col("_running"), whole[total], digits).alias(cumulative),
    )
