"""The corpus pipeline: quality rules, near-dedup, decontamination, mixing, sharding."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from retailmart.llm import queries
from retailmart.llm.decontaminate import decontaminate
from retailmart.llm.mixing import BLOCK_ROWS, mixed_rows
from retailmart.llm.quality_rules import quality_filter
from retailmart.llm.sharding import sharded_rows
from retailmart.llm.simhash import near_dedup
from retailmart.llm.texts import kept, table

#: Places of the mixture that are shuffled together: those of one cycle.
STRETCH = (sum(queries.MIX_WEIGHTS.values()) + queries.MIX_REST) * BLOCK_ROWS


def quality_rules(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that no rule rejects."""
    return quality_filter(docs)


def simhash_near_dedup(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The document with the smallest id of each near-duplicate class."""
    return near_dedup(docs, shingle_words=3, max_distance=3)


def benchmark_decontamination(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold no benchmark item."""
    return decontaminate(docs, table(spark, sf_dir, "benchmark"))


def source_mixing(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents, in the order of the mixture, with their place in it as ``mix_place``."""
    return mixed_rows(docs, queries.MIX_WEIGHTS, queries.MIX_REST, text_col="text", place_col="mix_place")


def sharding(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """All documents with their shard and their place in it: shuffled within stretches of the mixture, which it keeps."""
    return sharded_rows(docs, shards=8, order_col="mix_place", stretch=STRETCH)


STAGES: list[tuple[str, Callable[[SparkSession, DataFrame, str], DataFrame]]] = [
    ("quality_rules", quality_rules),
    ("simhash_near_dedup", simhash_near_dedup),
    ("benchmark_decontamination", benchmark_decontamination),
    ("source_mixing", source_mixing),
    ("sharding", sharding),
]

#: XXH64 and Spark's seeded shuffle have no SQL form; the tests compare with a brute-force version.
ORACLE_SQL = None


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    """All stages over ``documents``; each stage's rows are written to the shared folder for the next."""
    docs = table(spark, sf_dir, "documents")
    for name, stage in STAGES[:-1]:
        docs = kept(stage(spark, docs, sf_dir), f"pipeline-{name}")
    return STAGES[-1][1](spark, docs, sf_dir)
