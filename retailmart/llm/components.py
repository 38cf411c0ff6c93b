"""Connected components of a link table, by joins."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailmart.llm.texts import checkpointed


def connected_components(links: DataFrame) -> DataFrame:
    """(node, root) for every node of ``links`` (a, b: bigint) but the roots; the root is the least node reachable.

    Large-star and small-star steps in turn until nothing changes: each step joins the links with one row per
    node and is checkpointed. A node of very many links is one key of a many-to-one join, which adaptive
    execution splits. Nulls and self links are ignored. No links give no rows.
    """
    stars = checkpointed(
        links.where(F.col("a") != F.col("b")).select(F.greatest("a", "b").alias("u"), F.least("a", "b").alias("v")).distinct()
    )
    state = _state(stars)
    while state[0]:
        both = stars.unionByName(stars.select(F.col("v").alias("u"), F.col("u").alias("v")))
        low = both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m"))
        large = both.join(low, "u").where("v > u").select(F.col("v").alias("u"), F.col("m").alias("v")).where("u != v").distinct()
        least = large.groupBy("u").agg(F.min("v").alias("m"))
        small = large.join(least, "u").where("v != m").select(F.col("v").alias("u"), F.col("m").alias("v"))
        stars = checkpointed(small.unionByName(least.withColumnRenamed("m", "v")).distinct())
        before, state = state, _state(stars)
        if state == before:
            break
    return stars.select(F.col("u").alias("node"), F.col("v").alias("root"))


def _state(stars: DataFrame) -> tuple:
    """Rows and a checksum of them."""
    return tuple(stars.agg(F.count("*"), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first())
