"""Mixing sources to target weights by Pfair scheduling, with DataFrame functions only.

Each source is cut into blocks of rows. With weight w, block j of a source is released at slot floor(j / w) and due
by slot ceil((j + 1) / w); each slot takes, of the blocks released, the one due first. So after every slot each
source has had its share to within less than one block. Weights are whole numbers of slots in a cycle, and the
schedule of one cycle repeats: all shares are exact at its end.
"""

from __future__ import annotations

from collections.abc import Mapping
from fractions import Fraction
from functools import reduce
from operator import and_

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.window import Window

from retailmart.llm.texts import numbered_copies

#: Rows in a block.
BLOCK_ROWS = 16
#: Rows that one window sorts: sources are numbered in hashed buckets of about this size.
BUCKET_ROWS = 100_000


def cycle(weights: Mapping[str, int]) -> list[tuple[str, int, int]]:
    """(source, block in the cycle, slot) for one cycle of sum(weights) slots: earliest deadline first.

    The cycle's length is the sum of the weights, which the caller sets; it does not depend on the data.
    """
    length = sum(weights.values())
    done = dict.fromkeys(weights, 0)
    plan = []
    for slot in range(length):
        open_now = [s for s, w in weights.items() if done[s] < w and done[s] * length // w <= slot]
        source = min(open_now, key=lambda s: (-(-(done[s] + 1) * length // weights[s]), s))
        plan.append((source, done[source], slot))
        done[source] += 1
    return plan


def mix(
    docs: DataFrame,
    weights: Mapping[str, int],
    rest: int = 1,
    id_col: str = "doc_id",
    source_col: str = "source",
    block_rows: int = BLOCK_ROWS,
    bucket_rows: int = BUCKET_ROWS,
    seed: int = 42,
) -> DataFrame:
    """(doc_id, source, source_group, block, release, deadline, slot, slot_row): every row's place in the mixture.

    Order by (slot, slot_row) to read the mixture. ``weights`` gives whole numbers of slots in a cycle to named
    sources; all other sources that the table holds, null among them, share ``rest`` slots in equal parts: they take
    turns, so each of them, too, has had its share to within less than one block after every slot. Sources that the
    table does not hold get no slots. ``source_group`` is the source that a row's block belongs to. Rows of a source are
    dealt in the order of a seeded hash of id and source. No row is dropped or repeated: once a source has run out its
    slots stay empty, and the others keep their mutual shares. Equal rows are interchangeable. An empty table gives
    no rows.

    The plan: one count by (source, hashed bucket); a running sum over buckets; row numbers within buckets of
    about ``bucket_rows``, so a source with any share of the rows is spread over many tasks. The names of the sources
    not in ``weights`` are numbered in one task.
    """
    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(source_col).cast("string").alias("source"))
    placed = _placed(rows, dict(weights), rest, block_rows, bucket_rows, seed)
    return placed.select("doc_id", "source", F.col("source").alias("source_group"), "block", "release", "deadline", "slot", "slot_row")


def mixed_rows(
    docs: DataFrame,
    weights: Mapping[str, int],
    rest: int = 1,
    id_col: str = "doc_id",
    source_col: str = "source",
    text_col: str | None = None,
    place_col: str | None = None,
    block_rows: int = BLOCK_ROWS,
    bucket_rows: int = BUCKET_ROWS,
    seed: int = 42,
) -> DataFrame:
    """The rows of ``docs``, same columns, in the order of the mixture: files and rows in them follow the slots.

    Rows that share id and source have one place; with ``text_col`` only those that share the text as well.
    ``place_col`` names a column to add (or replace): the place, slot * block_rows + slot_row.
    """
    keys = {"doc_id": F.col(id_col).cast("long"), "source": F.col(source_col).cast("string")}
    if text_col is not None:
        keys["text_hash"] = F.xxhash64(F.col(text_col).cast("string"))
    rows = docs.select(*[c.alias(k) for k, c in keys.items()])
    placed = _placed(rows, dict(weights), rest, block_rows, bucket_rows, seed)
    place = F.col("slot") * block_rows + F.col("slot_row")
    places = placed.groupBy(*[F.col(k).alias(f"_at_{k}") for k in keys]).agg(F.min(place).alias("_place"))
    packed = docs.select(F.struct("*").alias("_packed"), *[c.alias(f"_{k}") for k, c in keys.items()])
    same = reduce(and_, [F.col(f"_{k}").eqNullSafe(F.col(f"_at_{k}")) for k in keys])
    ordered = packed.join(places, same, "left").repartitionByRange("_place").sortWithinPartitions("_place")
    columns = [F.col("_packed").getField(c).alias(c) for c in docs.columns if c != place_col]
    return ordered.select(*columns, *([F.col("_place").alias(place_col)] if place_col else []))


def _placed(rows: DataFrame, weights: dict[str, int], rest: int, block_rows: int, bucket_rows: int, seed: int) -> DataFrame:
    if any(w < 1 for w in weights.values()) or rest < 1:
        raise ValueError("weights are whole numbers from 1")
    key = rows.columns
    named = F.coalesce(F.col("source").isin(*weights), F.lit(False)) if weights else F.lit(False)
    total, held, others = rows.agg(F.count("*"), F.collect_set(F.when(named, F.col("source"))), F.max(~named)).first()
    buckets = max(64, -(-total // bucket_rows))
    rows = numbered_copies(rows)  # numbered, as equal rows would share every hash
    rows = rows.withColumn("_hash", F.xxhash64(F.lit(seed), *[F.col(c) for c in key], "_copy"))
    rows = rows.withColumn("_bucket", F.pmod(F.col("_hash"), F.lit(buckets)))
    sizes = rows.groupBy("source", "_bucket").agg(F.count("*").alias("_n"))
    before = Window.partitionBy("source").orderBy("_bucket").rowsBetween(Window.unboundedPreceding, -1)
    starts = sizes.select(
        F.col("source").alias("_g"), F.col("_bucket").alias("_b"), F.coalesce(F.sum("_n").over(before), F.lit(0)).alias("_start")
    )
    unnamed = sizes.where(~named).select("source").distinct()
    turns = unnamed.select(F.col("source").alias("_s"), (F.row_number().over(Window.orderBy("source")) - 1).cast("long").alias("_turn"))
    starts = starts.join(turns, F.col("_g").eqNullSafe(F.col("_s")), "left").crossJoin(unnamed.agg(F.count("*").alias("_unnamed")))
    inside = Window.partitionBy("source", "_bucket").orderBy("_hash", *key, "_copy")
    numbered = rows.withColumn("_rank", F.row_number().over(inside) - 1)
    placed = numbered.join(starts, F.col("source").eqNullSafe(F.col("_g")) & (F.col("_bucket") == F.col("_b")))
    index = F.col("_start") + F.col("_rank")
    placed = placed.withColumn("block", F.floor(index / block_rows)).withColumn("slot_row", F.pmod(index, F.lit(block_rows)))
    shares = {f"s:{s}": w for s, w in weights.items() if s in held}
    if others or not shares:
        shares["rest"] = rest
    return _scheduled(placed, F.when(named, F.concat(F.lit("s:"), F.col("source"))).otherwise("rest"), shares)


def _scheduled(placed: DataFrame, key: Column, shares: dict[str, int]) -> DataFrame:
    """Look the block's slot up in one cycle, held as an array per key of ``shares``.

    Of the n sources under the key "rest", the one with turn i has the blocks i, i + n, i + 2n and so on of the key.
    The key is less than one block off its share, a source in turn less than (n - 1) / n of a block off the nth part of
    what the key has had, so the source is less than 1 / n + (n - 1) / n = 1 block off its own.
    """
    slots: dict[str, list[int]] = {k: [] for k in shares}
    for source, _, slot in cycle(shares):
        slots[source].append(slot)
    length = sum(shares.values())
    per_cycle = F.create_map(*[x for k, found in slots.items() for x in (F.lit(k), _longs(found))])
    share = F.create_map(*[x for k, w in shares.items() for x in (F.lit(k), F.lit(w).cast("long"))])
    placed = placed.withColumn("_key", key).withColumn("_w", share[F.col("_key")])
    placed = placed.withColumn("_of", F.when(F.col("_key") == "rest", F.col("_unnamed")).otherwise(F.lit(1).cast("long")))
    placed = placed.withColumn("_block", F.col("block") * F.col("_of") + F.coalesce("_turn", F.lit(0)))
    left = F.pmod(F.col("_block"), F.col("_w"))
    return placed.withColumns(
        {
            "slot": F.expr(f"_block div _w * {length}") + F.get(per_cycle[F.col("_key")], left.cast("int")),
            "release": F.expr(f"block * _of * {length} div _w"),
            "deadline": F.expr(f"((block + 1) * _of * {length} + _w - 1) div _w"),
        }
    )


def _longs(values: list[int]) -> Column:
    return F.array(*[F.lit(v).cast(T.LongType()) for v in values])


def lag(weights: Mapping[str, int]) -> Fraction:
    """The largest deviation, in blocks, of any source from its share at any slot of the cycle."""
    length, worst = sum(weights.values()), Fraction(0)
    had = dict.fromkeys(weights, 0)
    for source, _, slot in cycle(weights):
        had[source] += 1
        worst = max(worst, *(abs(Fraction((slot + 1) * w, length) - had[s]) for s, w in weights.items()))
    return worst
