"""Joins of a large fact to a dimension.

``join_dimension`` is Spark's own join: statistics and adaptive execution choose between broadcast and shuffle, and
split skewed partitions. Where a few known or sampled keys hold much of the fact, ``hot_key_join`` keeps their rows out
of the shuffle. Both give the same rows at every size.
"""

from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

# A key is hot when it holds more than 1/HOT_KEYS of the rows, so there can be
# at most HOT_KEYS hot keys whatever the data: their broadcast is bounded.
HOT_KEYS = 1000
HOT_SAMPLE = 0.01


def join_dimension(
    fact: DataFrame, dim: DataFrame, on: str | Sequence[str], how: str = "left"
) -> DataFrame:
    """Join ``dim`` to ``fact``; ``how`` is left, inner or left_semi. Lazy: no job runs."""
    keys = [on] if isinstance(on, str) else list(on)
    if how == "left_semi":
        dim = dim.select(*keys)
    return fact.join(dim, keys, how)


def hot_keys(fact: DataFrame, keys: Sequence[str]) -> DataFrame:
    """The keys that hold much of ``fact``, at most ``HOT_KEYS``, as a literal frame.

    Estimated from a sample of the key columns (an action). A key missed or named
    in error costs time, never rows; being literal, the list reads the same in
    every part of the plan and after the loss of an executor.
    """
    counts = (
        fact.select(*keys)
        .sample(fraction=HOT_SAMPLE, seed=1)
        .groupBy(*keys)
        .agg(F.count("*").alias("_rows"))
    )
    sampled = counts.agg(F.sum("_rows")).scalar()
    found = (
        counts.filter(F.col("_rows") * HOT_KEYS > sampled)
        .orderBy(F.col("_rows").desc())
        .limit(HOT_KEYS)
        .select(*keys)
    )
    return fact.sparkSession.createDataFrame(found.collect(), fact.select(*keys).schema)


def hot_key_join(
    fact: DataFrame,
    dim: DataFrame,
    on: str | Sequence[str],
    how: str = "left",
    null_safe: bool = False,
    hot: DataFrame | None = None,
) -> DataFrame:
    """``join_dimension`` with the hot keys' rows kept out of the shuffle, and NULL keys too.

    Fact rows with a hot key meet a broadcast of the dimension rows of those keys, at
    most ``HOT_KEYS`` keys, where they are; all others are joined by shuffle, and the
    two parts are put together. The fact is read once for each part. ``hot`` may give
    the hot keys, if they are known; it must hold few rows.
    """
    keys = [on] if isinstance(on, str) else list(on)
    if how == "left_semi":
        dim = dim.select(*keys).distinct()
    hot = (hot_keys(fact, keys) if hot is None else hot).select(*_renamed(keys, "_hot_"))
    is_hot = _same(keys, "", "_hot_", null_safe)
    attrs = [c for c in dim.columns if c not in keys]
    named = dim.select(*_renamed(keys, "_dim_"), *attrs)
    match = _same(keys, "", "_dim_", null_safe)

    few = named.join(F.broadcast(hot), _same(keys, "_dim_", "_hot_", null_safe), "left_semi")
    parts = [fact.join(F.broadcast(hot), is_hot, "left_semi").join(F.broadcast(few), match, how)]
    cold = fact.join(F.broadcast(hot), is_hot, "left_anti")
    if not null_safe:
        known = F.lit(True)
        for k in keys:
            known = known & F.col(k).isNotNull()
        if how == "left":
            parts.append(
                cold.filter(~known).select("*", *[F.lit(None).cast(dim.schema[a].dataType).alias(a) for a in attrs])
            )
        cold = cold.filter(known)
    parts.append(cold.join(named, match, how))
    rest = [c for c in fact.columns if c not in keys]
    out = [*keys, *rest] if how == "left_semi" else [*keys, *rest, *attrs]
    joined = parts[0].select(*out)
    for part in parts[1:]:
        joined = joined.unionByName(part.select(*out))
    return joined


def _renamed(keys: Sequence[str], prefix: str) -> list[Column]:
    return [F.col(k).alias(prefix + k) for k in keys]


def _same(keys: Sequence[str], left: str, right: str, null_safe: bool) -> Column:
    cond = F.lit(True)
    for k in keys:
        a, b = F.col(left + k), F.col(right + k)
        cond = cond & (a.eqNullSafe(b) if null_safe else a == b)
    return cond
