"""Sharding by a two-pass external shuffle, with DataFrame functions only.

Pass one scatters the rows over buckets that fit in memory, by seeded hashes. Pass two shuffles each bucket with
Fisher-Yates (Spark's ``shuffle`` of an array, seeded) and writes it. The shard of a row depends on its id and the
number of shards alone (rendezvous hashing: the shard with the largest hash wins), so one more shard takes rows only
into itself. Rows that come in an order worth keeping, such as a mixture, are shuffled within stretches of it.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql.window import Window

from retailmart.llm.texts import numbered_copies

#: Rows in a bucket: ids and sizes of so many rows are held at once.
BUCKET_ROWS = 20_000


def shard_of(doc_id: Column, shards: int, seed: int = 42) -> Column:
    """The shard whose seeded hash with the id is the largest; a null id is hashed like any value."""
    best = F.greatest(*[F.struct(F.xxhash64(F.lit(seed), doc_id, F.lit(k)).alias("h"), F.lit(k).alias("k")) for k in range(shards)])
    return best["k"]


def shard_plan(
    docs: DataFrame,
    shards: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_rows: int = BUCKET_ROWS,
    seed: int = 42,
) -> DataFrame:
    """(doc_id, size, text_crc32, law, shard, slot, grown_shard), one row per input row.

    ``law`` is ``key``. ``slot`` numbers a shard's rows from 0 in shuffled order, ``grown_shard`` is the shard with
    one shard more. ``size`` is the text's UTF-8 bytes plus 1; a null text has size 1 and the checksum of no bytes.
    Rows that share an id share a shard; their slots differ, and equal rows are interchangeable. An empty table
    gives no rows.
    """
    if shards < 2:
        raise ValueError("two shards at least")
    text = F.coalesce(F.col(text_col).cast("string"), F.lit(""))
    rows = docs.select(
        F.col(id_col).cast("long").alias("doc_id"), (F.octet_length(text) + 1).cast("long").alias("size"), F.crc32(text.cast("binary")).alias("text_crc32")
    )
    shuffled = _shuffled(rows, shards, docs.count(), bucket_rows, seed)
    return shuffled.select(
        "doc_id", "size", "text_crc32", F.lit("key").alias("law"), "shard", "slot", shard_of(F.col("doc_id"), shards + 1, seed).alias("grown_shard")
    )


def _shuffled(rows: DataFrame, shards: int, total: int, bucket_rows: int, seed: int, bucket: Column | None = None) -> DataFrame:
    """The rows with their shard and slot; ``bucket`` takes the place of the seeded scatter."""
    buckets = max(8, -(-total // (shards * bucket_rows)))
    fields = rows.columns
    rows = numbered_copies(rows)  # else equal rows would share a bucket
    if bucket is None:
        bucket = F.pmod(F.xxhash64(F.lit(seed + 1), *rows.columns), F.lit(buckets)).cast("int")
    scattered = rows.withColumn("shard", shard_of(F.col("doc_id"), shards, seed)).withColumn("_bucket", bucket)
    held = scattered.groupBy("shard", "_bucket").agg(F.array_sort(F.collect_list(F.struct(*rows.columns))).alias("_rows"))
    # The seeded shuffle draws on from row to row of a partition: sorted, a task that runs again draws the same.
    sorted_buckets = held.sortWithinPartitions("shard", "_bucket")
    dealt = sorted_buckets.select("shard", "_bucket", F.shuffle("_rows", F.lit(seed)).alias("_rows"))
    before = Window.partitionBy("shard").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    sizes = scattered.groupBy("shard", "_bucket").agg(F.count("*").alias("_n"))
    starts = sizes.select("shard", "_bucket", F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start"))
    placed = dealt.join(starts, ["shard", "_bucket"])
    dealt = placed.select("shard", "_start", F.posexplode("_rows").alias("_pos", "_row"))
    return dealt.select(*[F.col(f"_row.{c}") for c in fields], "shard", (F.col("_start") + F.col("_pos")).alias("slot"))


def sharded_rows(
    docs: DataFrame,
    shards: int = 8,
    id_col: str = "doc_id",
    text_col: str = "text",
    bucket_rows: int = BUCKET_ROWS,
    seed: int = 42,
    order_col: str | None = None,
    stretch: int = BUCKET_ROWS,
) -> DataFrame:
    """All columns of ``docs`` with ``shard`` and ``slot``, in the order of the shards: ready to be written.

    Rows that share an id and a text share the least slot of them. A column of ``docs`` named ``shard`` or ``slot``
    is replaced. With ``order_col``, whole numbers from 0 that no two rows share, the buckets are the stretches of
    ``stretch`` numbers in a row instead of a scatter: a shard's rows are shuffled inside each stretch, and the
    stretches follow each other, so what holds for every stretch of the input holds for those of each shard but for
    the chance of the ids.
    """
    if order_col is not None:
        return _in_stretches(docs, shards, id_col, seed, order_col, stretch)
    plan = shard_plan(docs, shards, id_col, text_col, bucket_rows, seed)
    slots = plan.groupBy(F.col("doc_id").alias("_id"), F.col("text_crc32").alias("_crc")).agg(
        F.min("slot").alias("_slot"), F.first("shard").alias("_shard")
    )
    crc = F.crc32(F.coalesce(F.col(text_col).cast("string"), F.lit("")).cast("binary"))
    packed = docs.select(F.struct("*").alias("_packed"), F.col(id_col).cast("long").alias("_doc"), crc.alias("_text_crc"))
    joined = packed.join(slots, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_text_crc") == F.col("_crc")))
    ordered = joined.repartitionByRange("_shard", "_slot").sortWithinPartitions("_shard", "_slot")
    columns = [F.col("_packed").getField(c).alias(c) for c in docs.columns if c not in ("shard", "slot")]
    return ordered.select(*columns, F.col("_shard").alias("shard"), F.col("_slot").alias("slot"))


def _in_stretches(docs: DataFrame, shards: int, id_col: str, seed: int, order_col: str, stretch: int) -> DataFrame:
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(order_col).cast("long").alias("place"))
    plan = _shuffled(rows, shards, 0, 1, seed, F.expr(f"place div {stretch}"))
    slots = plan.groupBy(F.col("doc_id").alias("_id"), F.col("place").alias("_place")).agg(F.min("slot").alias("_slot"), F.first("shard").alias("_shard"))
    packed = docs.select(F.struct("*").alias("_packed"), F.col(id_col).cast("long").alias("_doc"), F.col(order_col).cast("long").alias("_at"))
    joined = packed.join(slots, F.col("_doc").eqNullSafe(F.col("_id")) & (F.col("_at") == F.col("_place")))
    ordered = joined.repartitionByRange("_shard", "_slot").sortWithinPartitions("_shard", "_slot")
    columns = [F.col("_packed").getField(c).alias(c) for c in docs.columns if c not in ("shard", "slot")]
    return ordered.select(*columns, F.col("_shard").alias("shard"), F.col("_slot").alias("slot"))


def write_shards(docs: DataFrame, path: str, shards: int = 8, **settings) -> None:
    """Write the shards as parquet folders ``shard=0`` and on; each file's rows stand in the order of their slots."""
    sharded_rows(docs, shards, **settings).write.partitionBy("shard").parquet(path)
