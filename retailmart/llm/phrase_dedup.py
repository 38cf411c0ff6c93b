"""Substring dedup with repeated-phrase automata.

Passages that recur are found by their keys (``windows``) and dealt to shards by key. Within a block of a shard, the
phrases of ``length`` words that are confirmed to recur are compiled into an Aho-Corasick automaton, each with the place
where it stands first; the block's passages are streamed through it, and every occurrence at a later place is removed.
A passage that occurs many times is compiled and streamed once, with its count: the automaton's hits in it hold for all its
copies, those at the place where a phrase stands first for all copies but the first.
"""

from __future__ import annotations

import hashlib
from collections import Counter

import ahocorasick
import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailmart.llm.texts import kept, map_arrow, texts_of
from retailmart.llm.windows import BLOCK_BYTES, DOC, GROUP, SLICE, WordUnits, doc_rows, folded, folded_rows, map_groups, recurring, removed, with_bodies

#: Stretches of ``n`` starts, from the window ``at`` of a passage on: for its first occurrence, or for all later ones.
MARKS = "key long, body_hash long, _doc_id long, _th int, _lo int, later boolean, at int, n int"


def phrase_spans(rows: DataFrame, length: int, gram: int, group: int, block_bytes: int) -> DataFrame:
    """(doc_id, th, lo, n): stretches of ``n`` starts of phrases that also start earlier."""
    units = WordUnits(length, gram)
    passages = recurring(rows, units)
    kinds = folded(passages)
    # Written, so that groups of either size cost one join with the texts.
    bodies = kept(with_bodies(rows, kinds, units), "bodies")
    small = bodies.where(F.col("kinds") <= group)
    marks = map_groups(small, lambda table: _automaton_block(table, length), MARKS, block_bytes)
    marks = marks.unionByName(_by_window(bodies.where(F.col("kinds") > group), length)).withColumnRenamed("n", "_n")
    first = F.col("doc_id").eqNullSafe(F.col("_doc_id")) & (F.col("th") == F.col("_th")) & (F.col("lo") == F.col("_lo"))
    found = passages.join(marks, ["key", "body_hash"]).where(first != F.col("later"))
    return found.select(*DOC, (F.col("lo") + F.col("at")).alias("lo"), F.col("_n").alias("n"))


def _automaton_block(table: pa.Table, length: int) -> pa.RecordBatch | None:
    """What the automaton of the block's phrases finds in each passage; they come in the order of their first places within
    each key."""
    # Rows equal in id and text are one text: their passages stand together, and the first is enough.
    place = list(zip(*[table.column(c).to_pylist() for c in ("key", *DOC, "lo")]))
    table = table.filter(pa.array([k == 0 or p != place[k - 1] for k, p in enumerate(place)], pa.bool_())).combine_chunks()
    bodies = table.column("body").combine_chunks()
    number: dict[bytes, int] = {}
    passages = []
    for body in texts_of(bodies.chunk(0) if isinstance(bodies, pa.ChunkedArray) else bodies):
        passages.append(tuple([number.setdefault(w, len(number)) for w in body.split()]))
    copies, kinds = table.column("times").to_pylist(), table.column("kinds").to_pylist()
    # Phrases of a passage alone with its key stand in its copies only.
    times: Counter = Counter()
    for words, kind in zip(passages, kinds):
        if kind > 1:
            times.update(words[i : i + length] for i in range(len(words) - length + 1))
    # A phrase that stands in several passages, or twice in one, is a pattern of its own (an even number: its first place);
    # a passage with copies is one pattern as a whole (an odd number).
    automaton = ahocorasick.Automaton(ahocorasick.STORE_INTS, ahocorasick.KEY_SEQUENCE)
    place, confirmed = 0, set()
    for words, kind in zip(passages, kinds):
        for i in range(len(words) - length + 1) if kind > 1 else ():
            phrase = words[i : i + length]
            if times[phrase] > 1 and phrase not in confirmed:
                confirmed.add(phrase)
                automaton.add_word(phrase, 2 * (place + i))
        place += len(words)
    place = 0
    for words, often in zip(passages, copies):
        if often > 1 and words not in confirmed:
            automaton.add_word(words, 2 * place + 1)
        place += len(words)
    if not len(automaton):
        return None
    automaton.make_automaton()
    rows, later, at, n, place = [], [], [], [], 0
    for k, words in enumerate(passages):
        hits, whole = [], False
        for end, value in automaton.iter(words):
            if value % 2:
                whole |= value // 2 == place  # the passage itself
            else:
                hits.append((end - length + 1, value // 2))
        wanted = [(False, [start for start, first in hits if first != place + start])]
        if whole:
            wanted.append((True, range(len(words) - length + 1)))
        elif copies[k] > 1:
            wanted.append((True, [start for start, _ in hits]))
        for of_later, starts in wanted:
            last = -2
            for start in starts:
                if start == last + 1:
                    n[-1] += 1
                else:
                    rows.append(k)
                    later.append(of_later)
                    at.append(start)
                    n.append(1)
                last = start
        place += len(words)
    take = pa.array(rows, pa.int64())
    columns = [table.column(c).combine_chunks().take(take) for c in ("key", "body_hash", *DOC, "lo")]
    columns = [c.combine_chunks() if isinstance(c, pa.ChunkedArray) else c for c in columns]
    found = [pa.array(later, pa.bool_()), pa.array(at, pa.int32()), pa.array(n, pa.int32())]
    return pa.RecordBatch.from_arrays([*columns, *found], ["key", "body_hash", "_doc_id", "_th", "_lo", "later", "at", "n"])


def _by_window(bodies: DataFrame, length: int) -> DataFrame:
    """The same for groups too large for one task: the first place of every phrase's 128-bit hash; all phrases of a passage
    with copies start earlier than in its later ones."""

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        hashes, n = bytearray(), []
        for body in texts_of(batch.column("text")):
            words = body.split()
            n.append(max(0, len(words) - length + 1))
            for i in range(n[-1]):
                hashes += xxhash.xxh128_digest(b" ".join(words[i : i + length]))
        row = np.repeat(np.arange(batch.num_rows), n)
        at = np.arange(len(row)) - np.repeat(np.cumsum(n) - n, n)
        h = pa.FixedSizeBinaryArray.from_buffers(pa.binary(16), len(row), [None, pa.py_buffer(bytes(hashes))]).cast(pa.binary())
        same = [batch.column(c).take(pa.array(row)) for c in ("key", "body_hash", *DOC, "lo")]
        return pa.RecordBatch.from_arrays([h, *same, pa.array(at.astype(np.int32))], ["h", "key", "body_hash", "_doc_id", "_th", "_lo", "at"])

    schema = "h binary, key long, body_hash long, _doc_id long, _th int, _lo int, at int"
    phrases = map_arrow(bodies.withColumnRenamed("body", "text"), work, schema, SLICE)
    place = F.struct("_doc_id", "_th", (F.col("_lo") + F.col("at")).alias("start"))
    firsts = phrases.groupBy("h").agg(F.min(place).alias("first"), F.count("*").alias("c")).where("c > 1")
    passage = ["key", "body_hash", "_doc_id", "_th", "_lo"]
    joined = phrases.join(firsts, "h").where(~place.eqNullSafe(F.col("first")))
    found = joined.select(*passage, F.lit(False).alias("later"), "at", F.lit(1).alias("n"))
    named = bodies.withColumnsRenamed({c: f"_{c}" for c in (*DOC, "lo")}).where("times > 1")
    return found.unionByName(named.select(*passage, F.lit(True).alias("later"), F.lit(0).alias("at"), "n"))


def _left(data: bytes, starts: np.ndarray, ends: np.ndarray, a: int, b: int, gone: np.ndarray) -> bytes:
    stay = np.flatnonzero(~gone[a:b]) + a
    if len(stay) == b - a:
        return data[starts[a] : ends[b - 1]] if a < b else b""
    return b" ".join([data[x:y] for x, y in zip(starts[stay].tolist(), ends[stay].tolist())])


def _finish(data, starts, ends, firsts, gone) -> list[pa.Array]:
    spans = list(zip(firsts[:-1].tolist(), firsts[1:].tolist()))
    counts = np.concatenate([[0], np.cumsum(gone)])
    digests = [hashlib.sha256(_left(data, starts, ends, a, b, gone)).hexdigest() for a, b in spans]
    return [pa.array(np.diff(firsts), pa.int64()), pa.array(np.diff(counts[firsts]), pa.int64()), pa.array(digests)]


def phrase_dedup(
    docs: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    length: int = 20,
    gram: int = 6,
    group: int = GROUP,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(doc_id, n_words, n_removed, kept_sha256), one row per input row.

    Words are runs of bytes other than ASCII white space. A word is removed if a phrase of ``length`` words covers it
    that also starts earlier: in a text with a smaller id, or before in the same text; phrases are judged on the input.
    Null ids come first; texts that share an id are ordered by a hash of the text, and rows equal in id and text count
    as one text and have one result. Null texts are empty. An empty table gives no rows. Columns other than the two
    named are not read.
    """
    rows, repeats = folded_rows(doc_rows(docs, id_col, text_col), counted=False)
    spans = phrase_spans(rows, length, gram, group, block_bytes)
    schema = "doc_id long, n_words long, n_removed long, kept_sha256 string"
    return removed(rows, spans, WordUnits(length, gram), _finish, schema, repeats)


def deduplicated(docs: DataFrame, id_col: str = "doc_id", text_col: str = "text", length: int = 20, gram: int = 6, group: int = GROUP, block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """(doc_id, kept): the words that stay, joined by one space."""
    rows, repeats = folded_rows(doc_rows(docs, id_col, text_col), counted=False)

    def finish(data, starts, ends, firsts, gone) -> list[pa.Array]:
        spans = zip(firsts[:-1].tolist(), firsts[1:].tolist())
        return [pa.array([_left(data, starts, ends, a, b, gone).decode() for a, b in spans])]

    spans = phrase_spans(rows, length, gram, group, block_bytes)
    return removed(rows, spans, WordUnits(length, gram), finish, "doc_id long, kept string", repeats)
