"""Labelled rows to learn from: a bounded sample, never of the held-out fifth."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailmart.llm.texts import doc_texts

#: Labelled rows that a model is fitted on at most; they are drawn by a hash of their ids.
TRAIN_ROWS = 20_000


def held_out(doc_id: Column) -> Column:
    """Whether crc32 of the id as text leaves no remainder by 5; a null id is not held out."""
    return F.coalesce(F.pmod(F.crc32(doc_id.cast("string").cast("binary")), F.lit(5)) == 0, F.lit(False))


def training_texts(docs: DataFrame, labels: DataFrame, label: str, rows: int = TRAIN_ROWS, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, text, label) of at most ``rows`` labelled documents that are not held out.

    The ids drawn are bounded by ``rows`` and are sent to the scan of the documents. A document with several labels
    counts with the largest; null labels are left out.
    """
    wanted = labels.select(F.col("doc_id").cast("long").alias("_id"), F.col(label).cast("int").alias("label"))
    wanted = wanted.where(F.col("_id").isNotNull() & F.col("label").isNotNull() & ~held_out(F.col("_id")))
    drawn = wanted.groupBy("_id").agg(F.max("label").alias("label")).orderBy(F.xxhash64("_id"), "_id").limit(rows)
    texts = doc_texts(docs, id_col, text_col)
    return texts.join(F.broadcast(drawn), texts["doc_id"] == F.col("_id")).select("doc_id", "text", "label")
