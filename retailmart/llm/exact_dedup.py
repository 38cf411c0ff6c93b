"""Exact dedup: counting quotient filters tell which texts can have a copy, and only those are compared byte by byte."""

from __future__ import annotations

import hashlib
from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailmart.llm.texts import buffer_of, doc_texts, kept, map_arrow, numbered_copies, texts_of
from retailmart.llm.textstats import LATER, WHITE
from retailmart.operators.joins import HOT_KEYS, hot_key_join

#: Fingerprints that a merged filter holds on average, and those that a task gathers before it builds filters of them.
FILTER_ROWS = 1 << 20
GATHERED = 1 << 20
#: Bits of the table that routes texts to the comparison, at most (32 MB). A fuller table lets more texts without a copy
#: through, never fewer with one.
ROUTE_BITS = 28
ROUTE_SPARSE = 6

FILTER = "block int, width int, quotient_bits int, occupied binary, run_ends binary, counters binary, slots binary"
ROWS = "doc_id long, n_chars long, sha binary"


def _packed(size: int, places: np.ndarray) -> bytes:
    bits = np.zeros(size, bool)
    bits[places] = True
    return np.packbits(bits, bitorder="little").tobytes()


def _places(packed: bytes, size: int | None = None) -> np.ndarray:
    return np.unpackbits(np.frombuffer(packed, np.uint8), count=size, bitorder="little").astype(bool)


def folded(values: np.ndarray, counts: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Each value once in order, with the sum of its counts."""
    order = np.argsort(values, kind="stable")
    values, counts = values[order], counts[order]
    first = np.flatnonzero(np.append(True, values[1:] != values[:-1])) if len(values) else np.zeros(0, np.int64)
    return values[first], np.add.reduceat(counts, first) if len(first) else counts


@dataclass
class QuotientFilter:
    """Counts of ``width``-bit fingerprints. The high bits (quotient) are places in ``occupied``; the low bits
    (remainder) lie sorted in ``slots``, one run a quotient, each run's last slot marked in ``run_ends``. A count above
    one follows its remainder, less one and in digits of a slot's width, in slots marked in ``counters``. Nothing is
    lost: the fingerprints can be read back, and filters merge in their order."""

    width: int
    quotient_bits: int
    occupied: bytes
    run_ends: bytes
    counters: bytes
    slots: bytes

    @classmethod
    def of(cls, values: np.ndarray, counts: np.ndarray, width: int) -> QuotientFilter:
        """From sorted different fingerprints (uint64) and their counts."""
        quotient_bits = min(max(1, len(values).bit_length()), width - 1)
        rest = width - quotient_bits
        mask = np.uint64((1 << rest) - 1)
        quotients = (values >> np.uint64(rest)).astype(np.int64)
        more = (counts - 1).astype(np.uint64)
        digits = np.zeros(len(values), np.int64)
        left = more.copy()
        while left.any():
            digits += left > 0
            left = left >> np.uint64(rest) if rest < 64 else left & np.uint64(0)
        at = np.arange(len(values)) + np.cumsum(digits) - digits
        size = len(values) + int(digits.sum())
        slots = np.zeros(size, np.uint64)
        slots[at] = values & mask
        written = []
        for k in range(int(digits.max(initial=0))):
            own = np.flatnonzero(digits > k)
            slots[at[own] + 1 + k] = (more[own] >> np.uint64(rest * k)) & mask
            written.append(at[own] + 1 + k)
        last = np.append(quotients[1:] != quotients[:-1], True) if len(values) else np.zeros(0, bool)
        return cls(
            width,
            quotient_bits,
            _packed(1 << quotient_bits, quotients),
            _packed(size, (at + digits)[last]),
            _packed(size, np.concatenate(written) if written else np.zeros(0, np.int64)),
            slots.astype("<u8").view(np.uint8).reshape(size, 8)[:, : cls._bytes(rest)].tobytes(),
        )

    @staticmethod
    def _bytes(bits: int) -> int:
        return -(-bits // 8)

    def read(self) -> tuple[np.ndarray, np.ndarray]:
        """The sorted fingerprints and their counts."""
        rest = self.width - self.quotient_bits
        wide = self._bytes(rest)
        size = len(self.slots) // wide
        slots = np.zeros((size, 8), np.uint8)
        slots[:, :wide] = np.frombuffer(self.slots, np.uint8).reshape(size, wide)
        slots = slots.view("<u8").ravel().astype(np.uint64)
        ends, counter = _places(self.run_ends, size), _places(self.counters, size)
        run = np.cumsum(ends) - ends
        quotients = np.flatnonzero(_places(self.occupied)).astype(np.uint64)
        item = np.flatnonzero(~counter)
        values = (quotients[run[item]] << np.uint64(rest)) | slots[item]
        counts = np.ones(len(item), np.int64)
        digit = np.flatnonzero(counter)
        owner = np.cumsum(~counter)[digit] - 1
        shift = ((digit - item[owner] - 1) * rest).astype(np.uint64)
        np.add.at(counts, owner, (slots[digit] << shift).astype(np.int64))
        return values, counts

    @classmethod
    def merged(cls, filters: Iterator[QuotientFilter]) -> QuotientFilter:
        """One filter with the counts of all; read in turn, so that the memory is that of the result."""
        values, counts, width = np.zeros(0, np.uint64), np.zeros(0, np.int64), 1
        held: list[tuple[np.ndarray, np.ndarray]] = []
        waiting = 0
        for one in filters:
            width = one.width
            held.append(one.read())
            waiting += len(held[-1][0])
            if waiting > max(len(values), GATHERED):
                values, counts = folded(*(np.concatenate(x) for x in zip((values, counts), *held)))
                held, waiting = [], 0
        if held:
            values, counts = folded(*(np.concatenate(x) for x in zip((values, counts), *held)))
        return cls.of(values, counts, width)


def _row(block: int, f: QuotientFilter) -> tuple:
    return block, f.width, f.quotient_bits, f.occupied, f.run_ends, f.counters, f.slots


def _batch(rows: list[tuple]) -> pa.RecordBatch:
    kinds = [pa.int32()] * 3 + [pa.binary()] * 4
    names = [c.split()[0] for c in FILTER.split(", ")]
    return pa.RecordBatch.from_arrays([pa.array(c, k) for c, k in zip(zip(*rows), kinds)], names)


def _filters(batch: pa.RecordBatch) -> Iterator[tuple[int, QuotientFilter]]:
    for block, *rest in zip(*(c.to_pylist() for c in batch.columns)):
        yield block, QuotientFilter(*rest)


def _fingerprints(sha: pa.Array) -> np.ndarray:
    """The first 64 bits of each hash."""
    return np.frombuffer(buffer_of(sha)[0], ">u8")[::4].astype(np.uint64)


def normalised(text: bytes) -> bytes:
    return text.translate(None, WHITE)


def hashed_rows(docs: DataFrame) -> DataFrame:
    """(doc_id, n_chars, sha): code points of the whole text and SHA-256 of the text without white space."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        chars, shas = [], []
        for text in texts_of(batch.column("text")):
            chars.append(len(text.translate(None, LATER)))
            shas.append(hashlib.sha256(normalised(text)).digest())
        columns = [batch.column("doc_id"), pa.array(chars, pa.int64()), pa.array(shas, pa.binary())]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_chars", "sha"])

    return map_arrow(docs, work, ROWS)


def merged_filters(rows: DataFrame, block_bits: int) -> DataFrame:
    """One filter for each block of fingerprints (their first ``block_bits`` bits): built in each task, then merged."""
    width = 64 - block_bits

    def built(parts: list[np.ndarray]) -> pa.RecordBatch:
        every = np.concatenate(parts)
        values, counts = folded(every, np.ones(len(every), np.int64))
        block = (values >> np.uint64(width)).astype(np.int64) if block_bits else np.zeros(len(values), np.int64)
        own = values & np.uint64((1 << width) - 1)
        cuts = np.flatnonzero(np.append(True, block[1:] != block[:-1]))
        ends = np.append(cuts[1:], len(block))
        return _batch([_row(int(block[a]), QuotientFilter.of(own[a:b], counts[a:b], width)) for a, b in zip(cuts, ends)])

    def build(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[np.ndarray] = []
        for batch in batches:
            if batch.num_rows:
                held.append(_fingerprints(batch.column("sha")))
            if sum(map(len, held)) >= GATHERED:
                yield built(held)
                held = []
        if held:
            yield built(held)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        block, run = None, []
        for batch in batches:
            for name, one in _filters(batch):
                if name != block and run:
                    yield _batch([_row(block, QuotientFilter.merged(iter(run)))])
                    run = []
                block = name
                run.append(one)
                if len(run) >= 64:
                    run = [QuotientFilter.merged(iter(run))]
        if run:
            yield _batch([_row(block, QuotientFilter.merged(iter(run)))])

    parts = rows.select("sha").mapInArrow(build, FILTER)
    return parts.repartition("block").sortWithinPartitions("block").mapInArrow(merge, FILTER)


def _route(filters: DataFrame, block_bits: int) -> tuple[np.ndarray, int]:
    """(packed table, bits): a bit for each first ``bits`` of a fingerprint whose count is above one.

    Each block gives its own stretch of the table, so the driver gets the table and no more: 32 MB at most.
    """

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            found = [int((f.read()[1] > 1).sum()) for _, f in _filters(batch)]
            yield pa.RecordBatch.from_arrays([pa.array(found, pa.int64())], ["n"])

    repeated = filters.mapInArrow(count, "n long").agg(F.sum("n")).first()[0] or 0
    bits = max(block_bits + 3, min(ROUTE_BITS, repeated.bit_length() + ROUTE_SPARSE))
    inner = bits - block_bits

    def stretch(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            names, tables = [], []
            for block, f in _filters(batch):
                values, counts = f.read()
                names.append(block)
                tables.append(_packed(1 << inner, (values[counts > 1] >> np.uint64(f.width - inner)).astype(np.int64)))
            yield pa.RecordBatch.from_arrays([pa.array(names, pa.int32()), pa.array(tables, pa.binary())], ["block", "bits"])

    table = np.zeros(1 << (bits - 3), np.uint8)
    each = 1 << (inner - 3)
    for row in filters.mapInArrow(stretch, "block int, bits binary").toLocalIterator():
        table[row["block"] * each : (row["block"] + 1) * each] = np.frombuffer(row["bits"], np.uint8)
    return table, bits


def verified_classes(docs: DataFrame, table: np.ndarray, bits: int) -> DataFrame:
    """(sha, group_size, keep_id, keep_chars) of the texts that occur twice or more, compared as bytes.

    Texts that the table lets through are grouped by themselves; Spark folds copies in each task before the shuffle.
    """
    shared = docs.sparkSession.sparkContext.broadcast(table.tobytes())

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        route = np.frombuffer(shared.value, np.uint8)
        texts = list(texts_of(batch.column("text")))
        bodies = [normalised(t) for t in texts]
        shas = [hashlib.sha256(b).digest() for b in bodies]
        at = _fingerprints(pa.array(shas, pa.binary())) >> np.uint64(64 - bits)
        hit = np.flatnonzero((route[at >> np.uint64(3)] >> (at & np.uint64(7)).astype(np.uint8)) & 1)
        if not len(hit):
            return None
        columns = [
            batch.column("doc_id").take(pa.array(hit)),
            pa.array([len(texts[k].translate(None, LATER)) for k in hit], pa.int64()),
            pa.array([shas[k] for k in hit], pa.binary()),
            pa.array([bodies[k] for k in hit], pa.binary()),
        ]
        return pa.RecordBatch.from_arrays(columns, ["doc_id", "n_chars", "sha", "body"])

    routed = map_arrow(docs, work, f"{ROWS}, body binary")
    # The largest of these is the longest original, then the smallest id; a null id comes last.
    best = F.max(F.struct("n_chars", F.col("doc_id").isNotNull().alias("known"), F.bitwise_not("doc_id").alias("other")))
    classes = routed.groupBy("sha", "body").agg(F.count("*").alias("group_size"), best.alias("best"))
    return classes.where(F.col("group_size") > 1).select(
        "sha", "group_size", F.bitwise_not("best.other").alias("keep_id"), F.col("best.n_chars").alias("keep_chars")
    )


def exact_dedup(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """Every row with the row that stays of its group of equal texts: doc_id, keep_id, group_size, kept, text_sha256.

    Texts are equal if they are so without ASCII white space; null counts as empty. The longest original stays, of
    equally long ones that with the smallest id, null ids last; of rows that repeat id and text one stays. An empty table
    gives no rows. Rows are tied to their class, which was compared as bytes, by the SHA-256 of the text. Other columns
    are not looked at.
    """
    docs = doc_texts(docs, id_col, text_col)
    spark = docs.sparkSession
    rows = kept(hashed_rows(docs), "hashed")
    total = rows.count()
    partitions = int(spark.conf.get("spark.sql.shuffle.partitions"))
    block_bits = max(partitions - 1, total // FILTER_ROWS).bit_length()
    filters = kept(merged_filters(rows, block_bits), "filters")
    table, bits = _route(filters, block_bits)
    classes = kept(verified_classes(docs, table, bits), "classes")
    hot = classes.where(F.col("group_size") * HOT_KEYS > total).select("sha")
    joined = hot_key_join(numbered_copies(rows), classes, "sha", "left", hot=hot)
    alone = F.col("group_size").isNull()
    stays = F.col("doc_id").eqNullSafe(F.col("keep_id")) & (F.col("n_chars") == F.col("keep_chars")) & (F.col("_copy") == 1)
    return joined.select(
        "doc_id",
        F.when(alone, F.col("doc_id")).otherwise(F.col("keep_id")).alias("keep_id"),
        F.coalesce("group_size", F.lit(1).cast("long")).alias("group_size"),
        (alone | stays).alias("kept"),
        F.lower(F.hex("sha")).alias("text_sha256"),
    )
