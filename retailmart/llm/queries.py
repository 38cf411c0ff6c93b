"""One query per operator, over whole tables."""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from retailmart.llm.decontaminate import contained_items
from retailmart.llm.exact_dedup import exact_dedup
from retailmart.llm.fill_middle import fill_in_middle, restored
from retailmart.llm.html_text import extract_text
from retailmart.llm.mixing import mix
from retailmart.llm.oracle import oracle_sql
from retailmart.llm.phrase_dedup import phrase_dedup
from retailmart.llm.quality_gam import fit_quality, score_quality
from retailmart.llm.quality_rules import BASE, quality_verdicts
from retailmart.llm.sharding import shard_plan
from retailmart.llm.simhash import simhash_classes
from retailmart.llm.spelling import spelling_variants
from retailmart.llm.suffix_dedup import suffix_dedup
from retailmart.llm.texts import table
from retailmart.llm.toxicity import fit_toxicity, score_toxicity

#: Slots per cycle; sources not named share MIX_REST.
MIX_WEIGHTS = {"src0": 30, "src1": 15, "src2": 10, "src3": 5}
MIX_REST = 40


def op1_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Documents and the benchmark items of which they hold 80 % or more of the five-word shingles."""
    return contained_items(table(spark, sf_dir, "documents"), table(spark, sf_dir, "benchmark"))


def op2_suffix_array_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return suffix_dedup(table(spark, sf_dir, "documents"), length=200)


def op3_simhash_near_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return simhash_classes(table(spark, sf_dir, "documents"), shingle_words=3, max_distance=3)


def op4_quality_classifier(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_quality(docs, fit_quality(docs, table(spark, sf_dir, "labels")), threshold=0.3)


def op5_sharding(spark: SparkSession, sf_dir: str) -> DataFrame:
    return shard_plan(table(spark, sf_dir, "documents"), shards=8)


def op6_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's place in a mixture of the sources by weight."""
    return mix(table(spark, sf_dir, "documents"), MIX_WEIGHTS, MIX_REST)


def op7_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    return phrase_dedup(table(spark, sf_dir, "documents"), length=20)


def op8_quality_rules(spark: SparkSession, sf_dir: str) -> DataFrame:
    verdicts = quality_verdicts(table(spark, sf_dir, "documents"), counts=BASE)
    return verdicts.select("doc_id", *BASE, "base_failed", "kept")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return extract_text(table(spark, sf_dir, "pages"))


def op10_toxicity(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = table(spark, sf_dir, "documents")
    return score_toxicity(docs, fit_toxicity(docs, table(spark, sf_dir, "labels")), threshold=0.5)


def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every word of the documents with its more frequent spelling."""
    return spelling_variants(table(spark, sf_dir, "documents"), min_length=6, min_times=5, ratio=5)


def op12_exact_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document with the one that stays of its group of equal texts."""
    return exact_dedup(table(spark, sf_dir, "documents"))


def op13_fill_in_middle(spark: SparkSession, sf_dir: str) -> DataFrame:
    """Every document's form for training, with hashes of its output and of the text rebuilt from that."""
    rows = restored(fill_in_middle(table(spark, sf_dir, "documents")))
    hashes = [F.sha2("output", 256).alias("output_sha256"), F.sha2("text", 256).alias("restored_sha256")]
    return rows.select("doc_id", "n", "form", "prefix_chars", "middle_chars", *hashes)


def queries() -> dict[str, Callable[[SparkSession, str], DataFrame]]:
    found = (
        op1_benchmark_decontamination,
        op2_suffix_array_dedup,
        op3_simhash_near_dedup,
        op4_quality_classifier,
        op5_sharding,
        op6_source_mixing,
        op7_substring_dedup,
        op8_quality_rules,
        op9_html_extraction,
        op10_toxicity,
        op11_spelling_variants,
        op12_exact_dedup,
        op13_fill_in_middle,
    )
    return {f.__name__: f for f in found}
