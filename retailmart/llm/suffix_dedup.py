"""Suffix-array dedup with a run-length index.

Within a block of passages, the suffixes are sorted, the Burrows-Wheeler transform is cut into runs, and only the
suffixes at the ends of runs are kept: position, neighbour in sorted order, and common prefix with it. That is all the
index holds, and it is small where the text repeats itself. Matching statistics are then streamed over the text: away
from the sampled positions the common prefix with the sorted neighbour falls by one from each position to the next.
A position whose statistic reaches the length sought starts a string that also starts elsewhere.

A passage that occurs many times is indexed once, with its count: its copies would stand side by side in sorted order as
one run, which the index keeps as the two ends of the passage. What the index finds in a passage holds for all its copies.
"""

from __future__ import annotations

import hashlib

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailmart.llm.texts import buffer_of, kept, map_arrow, texts_of
from retailmart.llm.windows import BLOCK_BYTES, DOC, GROUP, SLICE, ByteUnits, doc_rows, folded, folded_rows, map_groups, recurring, removed, with_bodies

#: Stretches of ``n`` starts, from the window ``at`` of a passage on.
MARKS = "key long, body_hash long, at int, n int"


class RunLengthIndex:
    """A run-compressed Burrows-Wheeler transform with the suffixes at run ends."""

    def __init__(self, text: np.ndarray, copied: tuple[np.ndarray, np.ndarray] | None = None, ends: int | None = None):
        """``text``: whole numbers that end in a number found once; those from ``ends`` on are found once each. ``copied``:
        the beginnings and ends of stretches that stand for several copies, each followed by such a number."""
        order = SuffixOrder(text, ends)
        positions = order.positions
        before = text[positions - 1]
        change = before[1:] != before[:-1]
        #: For each sampled position: its neighbour in sorted order, above and below.
        self.size = len(text)
        self.heads = np.concatenate([before[:1], before[1:][change]])
        self.above = positions[1:][change], positions[:-1][change]
        self.below = positions[:-1][change], positions[1:][change]
        self._common = order.common_prefix(*self.above)
        #: Runs that a stretch forms with its copies: they agree from its beginning to its end.
        self.copied = copied if copied is not None else (np.zeros(0, np.int64),) * 2

    def matching_statistics(self) -> np.ndarray:
        """For each position, the length of the longest string there that also starts elsewhere."""
        best = np.zeros(self.size, np.int64)
        sampled = [(positions, positions + self._common) for positions, _ in (self.above, self.below)]
        for positions, ends in [*sampled, self.copied]:
            reach = np.zeros(self.size, np.int64)
            reach[positions] = ends
            np.maximum(best, np.maximum.accumulate(reach) - np.arange(self.size), out=best)
        return best


class SuffixOrder:
    """The positions of a text in sorted order of their suffixes, by prefix doubling; only what is still tied is sorted again.

    The first keys hold as many symbols as fit into a machine word. Numbers from ``ends`` on take one symbol there, as a
    prefix that holds one is like no other; prefixes that agree up to such a number stand in any order.
    """

    def __init__(self, text: np.ndarray, ends: int | None = None):
        ends = int(text.max()) + 1 if ends is None else ends
        n = len(text)
        self.bits = max(ends.bit_length(), 1)
        self.symbols = 63 // self.bits
        symbols = np.concatenate([np.minimum(text, ends), np.zeros(self.symbols - 1, np.int64)])
        self.keys = np.zeros(n, np.int64)
        for i in range(self.symbols):
            self.keys <<= self.bits
            self.keys |= symbols[i : i + n]
        #: How far on the next number found once is; the last of the text is one.
        stop = np.flatnonzero(text >= ends)
        stop = stop if len(stop) and stop[-1] == n - 1 else np.append(stop, n - 1)
        self.left = np.repeat(stop, np.diff(stop, prepend=-1)) - np.arange(n)
        self.positions = np.argsort(self.keys)
        #: (width, ranks by prefixes of that width); a rank is the place of the first of all equal prefixes.
        self.levels: list[tuple[int, np.ndarray]] = []
        self._refine()

    def _refine(self) -> None:
        order, n, width = self.positions, len(self.positions), self.symbols
        rank, places, tied = np.empty(n, np.int32), np.arange(n), order
        keys = self.keys[order]
        single = self.left[order] < width
        while True:
            fresh = np.ones(len(places), bool)
            np.not_equal(keys[1:], keys[:-1], out=fresh[1:])
            fresh |= single
            rank[tied] = places[np.maximum.accumulate(np.where(fresh, np.arange(len(places)), 0))]
            again = ~(fresh & np.append(fresh[1:], True))
            if not again.any():
                return
            self.levels.append((width, rank.copy()))
            # Tied suffixes agree so far, so none has met its number found once: all go on within the text.
            places, tied = places[again], tied[again]
            keys = (rank[tied].astype(np.int64) << 32) | rank[tied + width]
            by = np.argsort(keys)
            tied, keys = tied[by], keys[by]
            order[places] = tied
            single = np.zeros(len(places), bool)
            width *= 2

    def common_prefix(self, a: np.ndarray, b: np.ndarray) -> np.ndarray:
        """The length of the common prefix of the suffixes at ``a`` and ``b``, different positions: the ranks of the widest
        level left out are all different, so every width matches once at most on the way down; the keys tell the rest."""
        at, to = a.copy(), b.copy()
        for width, rank in reversed(self.levels):
            step = width * (rank[at] == rank[to])
            at += step
            to += step
        differ = self.keys[at] ^ self.keys[to]
        more = np.zeros(len(a), np.int64)
        for i in range(1, self.symbols + 1):
            more += (differ >> (self.bits * (self.symbols - i))) == 0
        return at - a + np.minimum(more, np.minimum(self.left[at], self.left[to]))


def dedup_spans(rows: DataFrame, length: int, gram: int, group: int, block_bytes: int) -> DataFrame:
    """(doc_id, th, lo, n): stretches of ``n`` starts of strings of ``length`` bytes that also start elsewhere."""
    units = ByteUnits(length, gram)
    passages = recurring(rows, units)
    kinds = folded(passages)
    small = with_bodies(rows, kinds.where(F.col("kinds") <= group), units)
    marks = map_groups(small, lambda table: _index_block(table, length), MARKS, block_bytes)
    large = kinds.where(F.col("kinds") > group)
    if not large.isEmpty():
        copied = large.where("times > 1").select("key", "body_hash", F.lit(0).alias("at"), "n")
        marks = marks.unionByName(copied).unionByName(_by_window(kept(with_bodies(rows, large, units), "large-groups"), length))
    found = marks.withColumnRenamed("n", "_n")
    return passages.join(found, ["key", "body_hash"]).select(*DOC, (F.col("lo") + F.col("at")).alias("lo"), F.col("_n").alias("n"))


def _index_block(table: pa.Table, length: int) -> pa.RecordBatch | None:
    """What the index of all the block's passages finds in each."""
    column = table.column("body").combine_chunks()
    data, offsets = buffer_of(column.chunk(0) if isinstance(column, pa.ChunkedArray) else column)
    count = len(offsets) - 1
    # Each passage ends in a number of its own, so no match runs past its end.
    at = offsets + np.arange(count + 1)
    text = np.empty(len(data) + count, np.int64)
    text[at[1:] - 1] = 257 + np.arange(count)
    body = np.ones(len(text), bool)
    body[at[1:] - 1] = False
    text[body] = data.astype(np.int64) + 1
    often = np.flatnonzero(table.column("times").to_numpy() > 1)
    found = RunLengthIndex(text, (at[often], at[often + 1] - 1), ends=257).matching_statistics() >= length
    found[at[1:] - 1] = False
    edge = np.diff(np.concatenate([[0], found.astype(np.int8), [0]]))
    begin, end = np.flatnonzero(edge == 1), np.flatnonzero(edge == -1)
    doc = np.searchsorted(at, begin, "right") - 1
    take = pa.array(doc)
    columns = [table.column(c).combine_chunks().take(take) for c in ("key", "body_hash")]
    columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]
    return pa.RecordBatch.from_arrays([*columns, pa.array((begin - at[doc]).astype(np.int32)), pa.array((end - begin).astype(np.int32))], ["key", "body_hash", "at", "n"])


def _by_window(bodies: DataFrame, length: int) -> DataFrame:
    """The same for passages without a copy in groups too large for one task: a count of every string's 128-bit hash,
    folded before the shuffle."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        n = batch.column("n").to_numpy()
        hashes = bytearray()
        for size, body in zip(n.tolist(), texts_of(batch.column("text"))):
            for i in range(size):
                hashes += xxhash.xxh128_digest(body[i : i + length])
        row = np.repeat(np.arange(batch.num_rows), n)
        at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        h = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(row), [None, pa.py_buffer(bytes(hashes))]).cast(pa.binary())
        same = [batch.column(c).take(pa.array(row)) for c in ("times", "key", "body_hash")]
        return pa.RecordBatch.from_arrays([h, *same, pa.array(at.astype(np.int32))], ["h", "times", "key", "body_hash", "at"])

    strings = map_arrow(bodies.withColumnRenamed("body", "text"), work, "h binary, times long, key long, body_hash long, at int", SLICE)
    often = strings.groupBy("h").agg(F.sum("times").alias("c")).where("c > 1").select("h")
    return strings.where("times = 1").join(often, "h", "left_semi").select("key", "body_hash", "at", F.lit(1).alias("n"))


def _finish(data, starts, ends, firsts, gone) -> list[pa.Array]:
    whole = np.frombuffer(data, np.uint8)
    counts = np.concatenate([[0], np.cumsum(gone)])
    begins = np.concatenate([[0], np.cumsum(np.diff(np.concatenate([[0], gone.astype(np.int8)])) == 1)])
    sizes, n_removed, n_spans, digests = np.diff(firsts), [], [], []
    for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist()):
        dropped = int(counts[b] - counts[a])
        n_removed.append(dropped)
        n_spans.append(int(begins[b] - begins[a]) + int(bool(a < b and a and gone[a] and gone[a - 1])))
        left = data[a:b] if not dropped else whole[a:b][~gone[a:b]].tobytes() if dropped < b - a else b""
        digests.append(hashlib.sha256(left).hexdigest())
    return [pa.array(sizes, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(n_spans, pa.int64()), pa.array(digests)]


def suffix_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 200,
    gram: int = 48,
    group: int = GROUP,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(doc_id, n_bytes, n_removed, n_spans, kept_sha256), one row per input row.

    Every byte covered by a string of ``length`` bytes that also starts anywhere else, in the same text or another, is
    removed; strings are judged on the input. Null texts are empty. Texts shorter than ``length`` stay whole. Rows that
    repeat id and text count as different occurrences, so long ones are removed. An empty table gives no rows. Columns
    other than the two named are not read.
    """
    if length < gram or gram % 8:
        raise ValueError("grams are a multiple of 8 bytes, and no longer than the strings")
    rows, repeats = folded_rows(doc_rows(docs, id_col, text_col))
    spans = dedup_spans(rows, length, gram, group, block_bytes)
    schema = "doc_id long, n_bytes long, n_removed long, n_spans long, kept_sha256 string"
    return removed(rows, spans, ByteUnits(length, gram), _finish, schema, repeats)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 200, gram: int = 48, group: int = GROUP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, kept as binary): the bytes that stay. Cuts may fall inside a character, hence binary."""
    rows, repeats = folded_rows(doc_rows(docs, id_col, text_col))

    def finish(data, starts, ends, firsts, gone) -> list[pa.Array]:
        whole = np.frombuffer(data, np.uint8)
        left = [whole[a:b][~gone[a:b]].tobytes() for a, b in zip(firsts[:-1].tolist(), firsts[1:].tolist())]
        return [pa.array(left, pa.binary())]

    spans = dedup_spans(rows, length, gram, group, block_bytes)
    return removed(rows, spans, ByteUnits(length, gram), finish, "doc_id long, kept binary", repeats)
