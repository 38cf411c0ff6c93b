"""Leading rows, with and without ties."""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from retailmart.operators.joins import HOT_KEYS, hot_key_join


def top_rows(
    df: DataFrame,
    order: str,
    n: int,
    tiebreak: Sequence[str],
    descending: bool = True,
    rank: str | None = None,
    dense: bool = False,
) -> DataFrame:
    """Exactly the first ``n`` rows by ``order``, ties settled by ``tiebreak``.

    Each task keeps its own ``n`` rows, so nothing but ``n`` rows per task is
    gathered. ``rank`` adds the (dense) rank, computed on those ``n`` rows: every
    row ahead of a kept row is kept as well.
    """
    by = F.col(order).desc() if descending else F.col(order).asc()
    top = df.orderBy(by, *tiebreak).limit(n)
    if rank is None:
        return top
    ranker = F.dense_rank() if dense else F.rank()
    return top.withColumn(rank, ranker.over(Window.orderBy(by)).cast("bigint"))


def top_ranked(
    df: DataFrame,
    order: str,
    n: int,
    by: Sequence[str] = (),
    rank: str = "rank",
    dense: bool = False,
    few_rows: bool = False,
) -> DataFrame:
    """All rows whose rank by falling ``order`` is at most ``n``, overall or per ``by`` group.

    Ties may make this many more than ``n`` rows, so the rows are never gathered
    to be ranked. The ranks are settled on the leading values alone: those take
    ``n`` rows per group, as every value ahead of rank ``n`` is among them; for that
    ``df`` is read again.

    ``few_rows`` states that ``df`` holds few rows whatever the data, say one per member
    of a small dimension. It is then read once, and ranked in a plain window.
    """
    if few_rows:
        falling = Window.partitionBy(*by).orderBy(F.col(order).desc())
        place = (F.dense_rank() if dense else F.rank()).over(falling)
        return df.withColumn(rank, place.cast("bigint")).filter(F.col(rank) <= n)
    if by:
        return _top_ranked_by(df, order, n, by, rank, dense)
    values = df.select(order)
    if dense:
        values = values.distinct()
    # At most n values; each row then finds its rank where it is, and rows below
    # the last leading value are dropped at the scan.
    leaders = (
        values.filter(F.col(order).isNotNull())
        .orderBy(F.col(order).desc())
        .limit(n)
        .agg(F.sort_array(F.collect_list(order), asc=False).alias("leaders"))
        .scalar()
    )
    c = F.col(order)
    nulls_lead = c.isNull() & (F.size(leaders) < n)
    place = F.when(c.isNull(), F.size(leaders) + 1).otherwise(F.array_position(leaders, c))
    return df.filter((c >= F.array_min(leaders)) | nulls_lead).withColumn(
        rank, place.cast("bigint")
    )


def _top_ranked_by(
    df: DataFrame, order: str, n: int, by: Sequence[str], rank: str, dense: bool
) -> DataFrame:
    keys = [*by, order]
    # Ties are folded to one row with their count before the groups are gathered,
    # and of each group no more than n values are kept.
    values = df.groupBy(*keys).agg(F.count("*").alias("_rows"))
    falling = Window.partitionBy(*by).orderBy(F.col(order).desc())
    place = F.row_number().over(falling)
    leading = values.withColumn("_place", place).filter(F.col("_place") <= n)
    if dense:
        settled = F.col("_place")
    else:
        ahead = F.sum("_rows").over(falling.rowsBetween(Window.unboundedPreceding, -1))
        settled = F.coalesce(ahead, F.lit(0)) + 1
    ranks = leading.withColumn(rank, settled.cast("bigint")).filter(F.col(rank) <= n)
    # Joined on group and value, so that a large group is spread by its values;
    # rows of a frequent value stay where they are.
    hot = values.filter(F.col("_rows") * HOT_KEYS > values.agg(F.sum("_rows")).scalar())
    joined = hot_key_join(
        df, ranks.select(*keys, rank), keys, "inner", null_safe=True, hot=hot.select(*keys)
    )
    return joined.select(*df.columns, rank)
