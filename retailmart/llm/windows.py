"""Where windows recur: the search that both substring operators share.

A window is ``length`` units (bytes, or words) in a row of one text. Its key is the least hash of the grams in it, so
equal windows have equal keys. A stretch of neighbouring windows with one key is a *passage*: every window of a text
lies in exactly one passage, and there are far fewer passages than windows. Equal windows lie in passages with the
same key, so all further work goes on inside groups of passages with one key. Where a passage holds its least gram
more than once (``again``), windows may also recur inside it.

Texts are known by id and a hash of the text, so rows that share an id but not a text stay apart. Rows that repeat both
are folded to one with a count first, and its result is written out as often at the end.
"""

from __future__ import annotations

from collections.abc import Callable, Iterator
from typing import NamedTuple

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailmart.llm.texts import COPIES, buffer_of, doc_texts, kept, map_arrow, mixed, sliding_min

DOC = ("doc_id", "th")
PASSAGES = "key long, body_hash long, doc_id long, th int, lo int, n int, again boolean, copies long"
#: Different passages with one key that one task compares; larger groups are settled window by window.
GROUP = 4000
#: Bytes of passages that a task indexes at once. A group of one key is never cut.
BLOCK_BYTES = 1_000_000
#: Bytes of text hashed at once; a byte takes about a hundred bytes of memory meanwhile.
SLICE = 300_000


class Read(NamedTuple):
    """Texts as one run of units: text i has the units firsts[i] to firsts[i + 1], unit j the bytes starts[j] to ends[j]."""

    data: bytes
    starts: np.ndarray
    ends: np.ndarray
    firsts: np.ndarray
    words: list[bytes]


class ByteUnits:
    """Texts as bytes."""

    def __init__(self, length: int, gram: int = 48):
        self.length, self.gram = length, gram

    def read(self, column: pa.Array) -> Read:
        data, offsets = buffer_of(column)
        at = np.arange(len(data) + 1)
        return Read(data.tobytes(), at, at[1:], offsets, [])

    def grams(self, read: Read) -> np.ndarray:
        """A hash per ``gram`` units in a row."""
        n = len(read.data)
        if n < self.gram:
            return np.zeros(0, np.uint64)
        padded = read.data + bytes(16)
        hashes = np.empty(n + 8, np.uint64)
        for shift in range(8):
            hashes[shift::8] = np.frombuffer(padded, "<u8", len(hashes[shift::8]), shift)
        # Doubling: hashes of 8, 16, 32, ... bytes; a gram is the sum of its powers of two.
        width, total, done = 8, None, 0
        while True:
            if self.gram & width:
                total = hashes if total is None else _joined(total, hashes, done)
                done += width
            if done == self.gram:
                return mixed(total[: n - self.gram + 1])
            hashes = _joined(hashes, hashes, width)
            width *= 2


def _joined(left: np.ndarray, right: np.ndarray, shift: int) -> np.ndarray:
    """Hashes of strings made of one of ``left`` and, ``shift`` bytes on, one of ``right``."""
    out = left[: len(right) - shift] * np.uint64(0x9E3779B97F4A7C15)
    out += right[shift : shift + len(out)]
    out ^= out >> np.uint64(32)
    out *= np.uint64(0xD6E8FEB86659FD93)
    return out


def _powers(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers of an odd number and of its inverse, modulo 2**64."""
    base = 0x9E3779B97F4A7C15
    found = []
    for factor in (base, pow(base, -1, 1 << 64)):
        factors = np.full(max(n, 1), factor, np.uint64)
        factors[0] = 1
        found.append(np.cumprod(factors)[:n])
    return tuple(found)


class WordUnits:
    """Texts as words (runs of bytes other than ASCII white space), joined by one space."""

    def __init__(self, length: int, gram: int = 6):
        self.length, self.gram = length, gram

    def read(self, column: pa.Array) -> Read:
        data, offsets = buffer_of(column)
        whole = data.tobytes()
        words = [whole[a:b].split() for a, b in zip(offsets[:-1].tolist(), offsets[1:].tolist())]
        flat = [w for own in words for w in own]
        sizes = np.fromiter(map(len, flat), np.int64, len(flat))
        ends = np.cumsum(sizes + 1) - 1
        firsts = np.concatenate([[0], np.cumsum(np.fromiter(map(len, words), np.int64, len(words)))]).astype(np.int64)
        return Read(b" ".join(flat), ends - sizes, ends, firsts, flat)

    def grams(self, read: Read) -> np.ndarray:
        if len(read.words) < self.gram:
            return np.zeros(0, np.uint64)
        # A word's hash is a difference of running sums of byte times power, shifted back by the inverse power.
        powers, inverses = _powers(len(read.data))
        sums = np.concatenate([np.zeros(1, np.uint64), np.cumsum(np.frombuffer(read.data, np.uint8) * powers)])
        words = mixed((sums[read.ends] - sums[read.starts]) * inverses[read.starts])
        total = np.zeros(len(words) - self.gram + 1, np.uint64)
        for i in range(self.gram):
            total = mixed(total + words[i : i + len(total)])
        return total


Units = ByteUnits | WordUnits


def doc_rows(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(doc_id, th, text), null texts empty."""
    texts = doc_texts(docs, id_col, text_col)
    text = F.coalesce("text", F.lit(""))
    return texts.select("doc_id", F.hash(text).alias("th"), text.alias("text"))


def folded_rows(rows: DataFrame, counted: bool = True) -> tuple[DataFrame, bool]:
    """(doc_id, th, text, copies), one row for all that repeat id and text, and whether there are any such.

    ``copies`` is the number of occurrences that a row stands for, ``rows`` how often it was found; the first is 1 unless
    ``counted``. Only texts of repeated rows are shuffled, folded before that; they are written once.
    """
    often = kept(rows.groupBy(*DOC).agg(F.count("*").alias("c")).where("c > 1").select(*DOC), "repeated-rows")
    one = F.lit(1).cast("long")
    if often.isEmpty():
        return rows.withColumns({"copies": one, "rows": one}), False
    named = often.withColumnsRenamed({c: f"_{c}" for c in DOC})
    same = rows["doc_id"].eqNullSafe(named["_doc_id"]) & (rows["th"] == named["_th"])
    single = rows.join(named, same, "left_anti").withColumns({"copies": one, "rows": one})
    times = rows.join(named, same, "left_semi").groupBy(*DOC, "text").agg(F.count("*").alias("rows"))
    more = kept(times.select(*DOC, "text", (F.col("rows") if counted else one).alias("copies"), "rows"), "folded-rows")
    return single.unionByName(more), True


def found_passages(rows: DataFrame, units: Units, keys_only: bool = False) -> DataFrame:
    """Every passage of every text: key, hash of its units, document, first window, number of windows, again, copies.

    ``keys_only`` gives key, again and copies alone.
    """
    length = units.length
    width = length - units.gram + 1

    def work(batch: pa.RecordBatch) -> pa.RecordBatch | None:
        read = units.read(batch.column("text"))
        data, starts, ends, firsts, _ = read
        grams = units.grams(read)
        least = sliding_min(grams, width)
        if not len(least):
            return None
        sizes = np.diff(firsts)
        own = np.flatnonzero(sizes >= length)  # texts that hold a window
        if not len(own):
            return None
        cut = np.zeros(len(least) + 1, bool)
        cut[1:-1] = least[1:] != least[:-1]
        cut[firsts[own]] = True
        cut[firsts[own + 1] - length + 1] = True  # past the text's last window
        begin = np.flatnonzero(cut[:-1])
        n = np.diff(np.append(begin, len(least)))
        doc = np.searchsorted(firsts, begin, "right") - 1
        inside = begin <= firsts[doc + 1] - length
        begin, n, doc = begin[inside], n[inside], doc[inside]
        key, again = pa.array(least[begin].view(np.int64)), pa.array(_again(grams, least[begin], begin, n, width))
        copies = batch.column("copies").take(pa.array(doc))
        if keys_only:
            return pa.RecordBatch.from_arrays([key, again, copies], ["key", "again", "copies"])
        digest = xxhash.xxh3_64_intdigest
        spans = zip(starts[begin].tolist(), ends[begin + n + length - 2].tolist())
        bodies = np.array([digest(data[a:b]) for a, b in spans], np.uint64)
        take = pa.array(doc)
        columns = [
            key,
            pa.array(bodies.view(np.int64)),
            batch.column("doc_id").take(take),
            batch.column("th").take(take),
            pa.array((begin - firsts[doc]).astype(np.int32)),
            pa.array(n.astype(np.int32)),
            again,
            copies,
        ]
        return pa.RecordBatch.from_arrays(columns, ["key", "body_hash", "doc_id", "th", "lo", "n", "again", "copies"])

    return map_arrow(rows, work, "key long, again boolean, copies long" if keys_only else PASSAGES, SLICE)


def _again(grams: np.ndarray, key: np.ndarray, begin: np.ndarray, n: np.ndarray, width: int) -> np.ndarray:
    """Whether the key's gram stands at more than one place in the windows of a passage."""
    out = n > width
    if not len(n):
        return out
    views = np.lib.stride_tricks.sliding_window_view(grams, width)
    for a in range(0, len(n), 4096):
        b = slice(a, a + 4096)
        first, last = views[begin[b]] == key[b, None], views[begin[b] + n[b] - 1] == key[b, None]
        moved = begin[b] + first.argmax(axis=1) != begin[b] + n[b] - 1 + last.argmax(axis=1)
        out[b] |= moved | (first.sum(axis=1) > 1) | (last.sum(axis=1) > 1)
    return out


def recurring(rows: DataFrame, units: Units) -> DataFrame:
    """The passages whose key occurs twice or more, in one text or several: two scans, the first for a count of keys."""
    passages = found_passages(rows, units)
    twice = found_passages(rows, units, keys_only=True).groupBy("key").agg(F.sum("copies").alias("c"), F.max("again").alias("again")).where("c > 1 or again").select("key")
    return kept(passages.join(twice, "key", "left_semi"), "passages")


def folded(passages: DataFrame) -> DataFrame:
    """One row per different passage: times, first occurrence (by id, text, place), and ``kinds``, the number of different
    passages of its key, where one that repeats its gram counts as two."""
    each = passages.groupBy("key", "body_hash").agg(
        F.sum("copies").alias("times"), F.min(F.struct("doc_id", "th", "lo", "n")).alias("first"), F.max("again").alias("again")
    )
    each = kept(each.select("key", "body_hash", "times", "first.*", "again"), "folded")
    kinds = each.groupBy("key").agg(F.sum(F.when(F.col("again"), 2).otherwise(1)).alias("kinds"))
    return kept(each.join(kinds, "key"), "kinds")


def with_bodies(rows: DataFrame, wanted: DataFrame, units: Units) -> DataFrame:
    """The passages ``wanted`` with their units as ``body``: requests are gathered per document, which bounds them."""
    length = units.length
    requests = wanted.groupBy(*DOC).agg(F.collect_list(F.struct("key", "body_hash", "times", "lo", "n", "kinds")).alias("asked"))
    joined = _by_doc(rows, requests, "left_semi_rows")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, starts, ends, firsts, _ = units.read(batch.column("text"))
        asked = batch.column("asked")
        flat = asked.flatten()
        doc = np.repeat(np.arange(batch.num_rows), np.diff(asked.offsets.to_numpy()))
        lo, n = flat.field("lo").to_numpy(), flat.field("n").to_numpy()
        begin = firsts[doc] + lo
        spans = zip(starts[begin].tolist(), ends[begin + n + length - 2].tolist())
        names = ["key", "body_hash", "times", "lo", "n", "kinds"]
        columns = [flat.field(c) for c in names] + [batch.column(c).take(pa.array(doc)) for c in DOC]
        columns.append(pa.array([data[a:b] for a, b in spans], pa.binary()))
        return pa.RecordBatch.from_arrays(columns, [*names, *DOC, "body"])

    schema = "key long, body_hash long, times long, lo int, n int, kinds long, doc_id long, th int, body binary"
    return map_arrow(joined, work, schema, SLICE)


def _by_doc(rows: DataFrame, per_doc: DataFrame, how: str) -> DataFrame:
    named = per_doc.withColumnsRenamed({c: f"_{c}" for c in DOC})
    same = rows["doc_id"].eqNullSafe(named["_doc_id"]) & (rows["th"] == named["_th"])
    return rows.join(named, same, "left" if how == "left" else "inner").drop("_doc_id", "_th")


def map_groups(frame: DataFrame, work: Callable[[pa.Table], pa.RecordBatch | None], schema: str, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """Apply ``work`` to blocks of whole key groups, of about ``block_bytes`` of bodies each."""
    dealt = frame.repartition("key").sortWithinPartitions("key", "doc_id", "th", "lo")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[pa.RecordBatch] = []
        size = 0
        for batch in batches:
            keys = batch.column("key").to_numpy()
            sizes = np.diff(buffer_of(batch.column("body"))[1])
            begin = 0
            if not len(keys):
                continue
            for end in [*(np.flatnonzero(np.diff(keys)) + 1).tolist(), len(keys)]:
                if size >= block_bytes and held and (begin or held[-1].column("key")[-1].as_py() != keys[begin]):
                    out = work(pa.Table.from_batches(held).combine_chunks())
                    if out is not None and out.num_rows:
                        yield out
                    held, size = [], 0
                held.append(batch.slice(begin, end - begin))
                size += int(sizes[begin:end].sum())
                begin = end
        if held:
            out = work(pa.Table.from_batches(held).combine_chunks())
            if out is not None and out.num_rows:
                yield out

    return dealt.mapInArrow(run, schema)


def removed(rows: DataFrame, spans: DataFrame, units: Units, finish: Callable, schema: str, repeats: bool) -> DataFrame:
    """``finish`` for each text with a mask of its units that ``spans`` (doc_id, th, lo, n windows) cover; with ``repeats``,
    written out as often as the row was found, in parts dealt to all tasks."""
    length = units.length
    per_doc = spans.groupBy(*DOC).agg(F.collect_list(F.struct("lo", "n")).alias("spans"))
    joined = _by_doc(rows, per_doc, "left")

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        data, starts, ends, firsts, _ = units.read(batch.column("text"))
        found = batch.column("spans")
        flat = found.flatten()
        sizes = np.nan_to_num(pa.compute.list_value_length(found).to_numpy(zero_copy_only=False)).astype(np.int64)
        doc = np.repeat(np.arange(batch.num_rows), sizes)
        begin = firsts[doc] + flat.field("lo").to_numpy()
        depth = np.zeros(firsts[-1] + 1, np.int64)
        np.add.at(depth, begin, 1)
        np.add.at(depth, begin + flat.field("n").to_numpy() + length - 1, -1)
        gone = np.cumsum(depth[:-1]) > 0
        columns = finish(data, starts, ends, firsts, gone)
        return pa.RecordBatch.from_arrays([batch.column("doc_id"), *columns, batch.column("rows")], [*names, "rows"])

    names = [f.split()[0] for f in schema.split(", ")]
    done = map_arrow(joined, work, f"{schema}, rows long", SLICE)
    if not repeats:
        return done.drop("rows")
    parts = done.withColumn("_part", F.explode(F.expr(f"sequence(0L, (rows - 1) div {COPIES})")))
    dealt = parts.repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")), *parts.columns)
    return dealt.select(*names, F.explode(F.expr(f"sequence(1L, least({COPIES}L, rows - _part * {COPIES}))")).alias("_copy")).drop("_copy")
