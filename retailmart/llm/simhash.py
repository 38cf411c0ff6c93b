"""SimHash near-dedup by deletion-variant signatures.

A 64-bit fingerprint is cut into two halves. Of two fingerprints at most three bits apart, one half differs by at
most one bit. So each fingerprint is filed 64 times, once for each bit left open, under that bit and the rest of
its half; two such fingerprints meet under equal keys, and their distance is then checked.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailmart.llm.components import connected_components
from retailmart.llm.texts import checkpointed, doc_texts, kept, map_arrow, texts_of

SEED = 42
#: Fingerprints under one key that are compared in one go. Larger groups are filed again under finer keys.
GROUP = 512


def fingerprint(text: bytes, shingle_words: int = 3) -> int:
    """Signed 64-bit SimHash of the ASCII-lower-cased words; 0 without words."""
    words = text.lower().split()
    if not words:
        return 0
    joined = b" ".join(words)
    if len(words) <= shingle_words:
        hashes = np.array([xxhash.xxh64_intdigest(joined, SEED)], np.uint64)
    else:
        ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
        first = np.concatenate([[0], ends[: len(words) - shingle_words] + 1])
        digest = xxhash.xxh64_intdigest
        spans = zip(first.tolist(), ends[shingle_words - 1 :].tolist())
        hashes = np.array([digest(joined[a:b], SEED) for a, b in spans], np.uint64)
    ones = np.zeros(64, np.int64)
    for start in range(0, len(hashes), 1 << 16):
        part = hashes[start : start + (1 << 16)].view(np.uint8).reshape(-1, 8)
        ones += np.unpackbits(part, axis=1, bitorder="little").sum(axis=0, dtype=np.int32)
    bits = np.packbits(2 * ones > len(hashes), bitorder="little")
    return int(bits.view(np.int64)[0])


def fingerprints(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", shingle_words: int = 3) -> DataFrame:
    """(doc_id, fingerprint as bigint, th: a hash of the text), one row per input row."""
    texts = doc_texts(docs, id_col, text_col).withColumn("th", _text_hash("text"))

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        found = [fingerprint(t, shingle_words) for t in texts_of(batch.column("text"))]
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), pa.array(found, pa.int64()), batch.column("th")], ["doc_id", "fp", "th"])

    return map_arrow(texts, work, "doc_id long, fp long, th long")


def _text_hash(text_col: str) -> Column:
    return F.xxhash64(F.coalesce(F.col(text_col).cast("string"), F.lit("")))


def simhash_classes(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 3,
    max_distance: int = 3,
    group: int = GROUP,
) -> DataFrame:
    """(doc_id, fingerprint, component_id), one row per input row.

    Fingerprints link at ``max_distance`` (0 to 3) or fewer differing bits; ``component_id`` is the smallest
    doc_id reachable over links. Texts without words (null, empty) have the fingerprint zero, which links like
    any other. Rows without a doc_id get the class of their text; a class without any doc_id has a null id.
    Equal fingerprints are folded before anything is compared, so copies cost nothing. An empty table gives no
    rows. Columns other than the two named are not read.
    """
    prints, rooted = _rooted(docs, id_col, text_col, shingle_words, max_distance, group)
    ids = rooted.groupBy("root").agg(F.min("first.id").alias("component_id"))
    of_print = rooted.join(ids, "root").select("fp", "component_id")
    return prints.join(of_print, "fp").select(
        "doc_id", F.lower(F.lpad(F.hex("fp"), 16, "0")).alias("fingerprint"), "component_id"
    )


def _rooted(docs: DataFrame, id_col: str, text_col: str, shingle_words: int, max_distance: int, group: int) -> tuple[DataFrame, DataFrame]:
    """The fingerprints of all rows, and (fp, first, root) of the different ones: the first row by id, those without an
    id last, and the class."""
    if not 0 <= max_distance <= 3:
        raise ValueError("max_distance is 0 to 3")
    prints = kept(fingerprints(docs, id_col, text_col, shingle_words), "fingerprints")
    place = F.struct(F.col("doc_id").isNull().alias("no_id"), F.col("doc_id").alias("id"), "th")
    classes = prints.groupBy("fp").agg(F.min(place).alias("first"))
    roots = connected_components(links(classes.select("fp"), max_distance, group))
    return prints, classes.join(roots, F.col("fp") == F.col("node"), "left").select("fp", "first", F.coalesce("root", "fp").alias("root"))


def near_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    shingle_words: int = 3,
    max_distance: int = 3,
    group: int = GROUP,
) -> DataFrame:
    """One row of each class, all columns: the one with the smallest id. Rows without an id come last, and of rows that
    share the id but not the text one is drawn by a hash of the text. Of rows that share both, any one stays: they are
    folded before the shuffle, so a much repeated row costs nothing."""
    _, rooted = _rooted(docs, id_col, text_col, shingle_words, max_distance, group)
    stays = rooted.groupBy("root").agg(F.min("first").alias("first")).select("first.no_id", F.coalesce("first.id", F.lit(0)).alias("id"), "first.th")
    doc_id = F.col(id_col).cast("long")
    packed = docs.select(
        F.struct("*").alias("_packed"), doc_id.isNull().alias("no_id"), F.coalesce(doc_id, F.lit(0)).alias("id"), _text_hash(text_col).alias("th")
    )
    different = packed.groupBy("no_id", "id", "th").agg(F.first("_packed").alias("_packed"))
    found = different.join(stays, ["no_id", "id", "th"], "left_semi")
    return found.select(*[F.col("_packed").getField(c).alias(c) for c in docs.columns])


def links(prints: DataFrame, max_distance: int = 3, group: int = GROUP) -> DataFrame:
    """(a, b): links that connect what lies within ``max_distance``; a spanning set within each key's group.

    Groups of more than ``group`` distinct fingerprints are filed again: the other half is cut in two, then the
    quarter that is still open, each with one bit open. The last keys leave 11 bits open, so a group has at
    most 2048 members and is compared whole.
    """
    half = F.when(F.col("i") < 32, F.lit(0xFFFFFFFF)).otherwise(F.lit(~0xFFFFFFFF))
    keyed = prints.select("fp", F.explode(F.sequence(F.lit(0), F.lit(63))).alias("i")).select(
        "fp", F.col("i").cast("long").alias("slot"), (half.bitwiseAND(F.bitwise_not(_bit(F.col("i"))))).alias("mask")
    )
    linked = checkpointed(_compare(keyed, max_distance, group))
    found = linked.where("b is not null").select("a", "b")
    over = linked.where("b is null").select(F.col("a").alias("fp"), "slot", "mask")
    for width, last in ((16, False), (8, True)):
        if over.isEmpty():
            break
        keyed = over.select("fp", "slot", "mask", _open_low(width).alias("low"), F.explode(F.sequence(F.lit(0), F.lit(2 * width - 1))).alias("j"))
        part = F.call_function("shiftleft", F.lit((1 << width) - 1).cast("long"), (F.col("low") + F.when(F.col("j") < width, 0).otherwise(width)).cast("int"))
        mask = F.col("mask").bitwiseOR(part.bitwiseAND(F.bitwise_not(_bit(F.col("low") + F.col("j")))))
        keyed = keyed.select("fp", (F.col("slot") * 64 + F.col("j") + 64).alias("slot"), mask.alias("mask"))
        linked = checkpointed(_compare(keyed, max_distance, None if last else group))
        found = found.unionByName(linked.where("b is not null").select("a", "b"))
        over = linked.where("b is null").select(F.col("a").alias("fp"), "slot", "mask")
    return found


def _bit(i):
    return F.call_function("shiftleft", F.lit(1).cast("long"), i.cast("int"))


def _open_low(width: int):
    """The lowest bit of the open stretch of two ``width`` bits: the stretch that the mask does not touch."""
    found = F.lit(0)
    for low in range(0, 64, 2 * width):
        stretch = ((1 << (2 * width)) - 1) << low
        stretch = stretch - (1 << 64) if stretch >= 1 << 63 else stretch
        found = F.when(F.col("mask").bitwiseAND(F.lit(stretch)) == 0, F.lit(low)).otherwise(found)
    return found


def _compare(keyed: DataFrame, max_distance: int, group: int | None) -> DataFrame:
    """(a, b, slot, mask): links found under equal keys; members of groups over ``group`` come back with b null."""
    keyed = keyed.select("fp", "slot", "mask", F.col("fp").bitwiseAND(F.col("mask")).alias("key"))
    sorted_keys = keyed.repartition("slot", "key").sortWithinPartitions("slot", "key")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        rest: list[np.ndarray] | None = None
        for batch in batches:
            rows = [batch.column(c).to_numpy() for c in ("fp", "slot", "mask", "key")]
            if rest is not None:
                rows = [np.concatenate(x) for x in zip(rest, rows)]
            if not len(rows[0]):
                continue
            change = np.flatnonzero((np.diff(rows[1]) != 0) | (np.diff(rows[3]) != 0)) + 1
            last = change[-1] if len(change) else 0
            if group is not None and len(rows[0]) - last > group and last == 0:
                # One group fills all that is held: pass it on but for a tail that keeps it known as large.
                yield _frame(rows[0][: -group - 1], None, rows[1][: -group - 1], rows[2][: -group - 1])
                rest = [x[-group - 1 :] for x in rows]
                continue
            if last:
                yield from _grouped([x[:last] for x in rows], np.concatenate([[0], change]), max_distance, group)
            rest = [x[last:] for x in rows]
        if rest is not None and len(rest[0]):
            yield from _grouped(rest, np.array([0, len(rest[0])]), max_distance, group)

    return sorted_keys.mapInArrow(run, "a long, b long, slot long, mask long")


def _grouped(rows: list[np.ndarray], cuts: np.ndarray, max_distance: int, group: int | None) -> Iterator[pa.RecordBatch]:
    fp, slot, mask, _ = rows
    sizes = np.diff(cuts)
    two = cuts[:-1][sizes == 2]
    near = two[np.bitwise_count((fp[two] ^ fp[two + 1]).view(np.uint64)) <= max_distance]
    a, b = [fp[near]], [fp[near + 1]]
    for start, size in zip(cuts[:-1][sizes > 2].tolist(), sizes[sizes > 2].tolist()):
        members = fp[start : start + size]
        if group is not None and size > group:
            yield _frame(members, None, slot[start : start + size], mask[start : start + size])
            continue
        linked = np.bitwise_count((members[:, None] ^ members[None, :]).view(np.uint64)) <= max_distance
        label = np.arange(size)
        while True:
            least = np.where(linked, label[None, :], size).min(axis=1)
            if (least == label).all():
                break
            label = least
        far = np.flatnonzero(label != np.arange(size))
        a.append(members[label[far]])
        b.append(members[far])
    a, b = np.concatenate(a), np.concatenate(b)
    if len(a):
        yield _frame(a, b, np.zeros(len(a), np.int64), np.zeros(len(a), np.int64))


def _frame(a, b, slot, mask) -> pa.RecordBatch:
    b = pa.nulls(len(a), pa.int64()) if b is None else pa.array(b, pa.int64())
    return pa.RecordBatch.from_arrays([pa.array(a, pa.int64()), b, pa.array(slot, pa.int64()), pa.array(mask, pa.int64())], ["a", "b", "slot", "mask"])
