"""Benchmark decontamination: MinHash containment search over size classes, then exact containment.

An item's signature is its k least shingle hashes. Items are put into size classes by powers of two, and k is chosen
for the largest size u of a class: k = floor((1 - threshold) * u) + 1. A text that holds ``threshold`` of an item's
shingles misses fewer than k of them, so it holds at least one of the signature: the search loses nothing. Candidates
are then counted shingle by shingle.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from functools import lru_cache
from itertools import repeat

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from retailmart.llm.texts import doc_texts, kept, map_arrow, mixed, texts_of

WORD = re.compile(r"\w+")
#: Text bytes of the items that are searched for in one pass; more items take more passes over the documents. The index
#: of a block takes about five times as much memory, on the driver and in each Python worker.
BLOCK_BYTES = 16_000_000


def words_of(text: str) -> list[str]:
    """Lower-cased runs of letters, digits and underscores."""
    return WORD.findall(text.lower())


def shingles_of(words: list[str], width: int) -> set[tuple[str, ...]]:
    return set(zip(*[words[i:] for i in range(width)]))


#: Items whose shingles a task keeps at hand.
SHINGLED = 2_000


class ItemIndex:
    """Signatures of a block of items, and their texts; shingles are cut from these when an item is a candidate."""

    def __init__(self, items: list[tuple[int | None, str]], shingle_words: int, threshold: float):
        self.threshold = threshold
        self.ids: list[int | None] = []
        self.texts: list[str] = []
        self.widths: list[int] = []
        self.hash_of: dict[str, int] = {}
        signatures: dict[int, list[tuple[np.ndarray, np.ndarray]]] = {}
        for item_id, text in items:
            words = words_of(text)
            width = min(shingle_words, len(words))
            if not width:
                continue
            for w in words:
                self.hash_of.setdefault(w, xxhash.xxh64_intdigest(w.encode(), 1) | 1)
            hashes = np.unique(self.hashes(np.array([self.hash_of[w] for w in words], np.uint64), width))
            largest = (1 << int(len(hashes)).bit_length()) - 1
            least = hashes[: int((1 - threshold) * largest + 1e-9) + 1]
            signatures.setdefault(width, []).append((least.copy(), np.full(len(least), len(self.ids), np.int32)))
            self.ids.append(item_id)
            self.texts.append(text)
            self.widths.append(width)
        self.signatures = {}
        for width, parts in signatures.items():
            least, owner = (np.concatenate([p[k] for p in parts]) for k in (0, 1))
            order = np.argsort(least, kind="stable")
            self.signatures[width] = least[order], owner[order]
        self.ready()

    def ready(self) -> ItemIndex:
        """Shingles of the candidates met last; not sent with the index."""
        self.shingles = lru_cache(SHINGLED)(lambda k: shingles_of(words_of(self.texts[k]), self.widths[k]))
        return self

    def sent(self) -> dict:
        """The index as plain data, which any worker can read."""
        return {name: value for name, value in vars(self).items() if name != "shingles"}

    @classmethod
    def received(cls, data: dict) -> ItemIndex:
        index = cls.__new__(cls)
        vars(index).update(data)
        return index.ready()

    @staticmethod
    def hashes(words: np.ndarray, width: int) -> np.ndarray:
        """A hash per window of ``width`` word hashes."""
        total = np.zeros(len(words) - width + 1, np.uint64)
        for i in range(width):
            total = mixed(total + words[i : len(words) - width + 1 + i])
        return total

    def found_in(self, text: str) -> Iterator[tuple[int | None, int, int]]:
        """(item id, shingles shared, shingles) of each item that the text holds."""
        words = words_of(text)
        known = np.array(list(map(self.hash_of.get, words, repeat(0))), np.uint64)
        for width, (least, owner) in self.signatures.items():
            if len(words) < width:
                continue
            hashes = self.hashes(known, width)
            strange = np.concatenate([[0], np.cumsum(known == 0)])
            hashes = hashes[strange[width:] == strange[:-width]]
            first = np.searchsorted(least, hashes, "left")
            last = np.searchsorted(least, hashes, "right")
            candidates = {int(k) for a, b in zip(first[first < last], last[first < last]) for k in owner[a:b]}
            if candidates:
                own = shingles_of(words, width)
                for k in sorted(candidates):
                    shared, size = len(self.shingles(k) & own), len(self.shingles(k))
                    if shared >= self.threshold * size - 1e-9:
                        yield self.ids[k], shared, size


def contained_items(
    docs: DataFrame,
    items: DataFrame,
    id_col: str = "doc_id",
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    shingle_words: int = 5,
    threshold: float = 0.8,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """(doc_id, item_id, n_shared, n_shingles, containment): the items of which a text holds ``threshold`` or more.

    Words are lower-cased runs of letters, digits and underscores; shingles are sets of ``shingle_words`` words in
    a row. An item of fewer words is one shingle of all its words; one without words (null, empty) is found
    nowhere. The items are a query set: they are cut into blocks of about ``block_bytes`` by a hash of their row, each block
    is indexed on the driver and searched for in one pass over the documents without a shuffle. With several blocks, the
    rows that one finds are written before the next is indexed, so that one index is held at a time. Equal item rows
    count once; a pair of ids stands once per document row, with the larger containment. Empty tables give no rows.
    """
    texts = doc_texts(docs, id_col, text_col)
    found = texts.sparkSession.createDataFrame([], SCHEMA)
    for index, alone in item_blocks(items, item_col, item_text_col, shingle_words, threshold, block_bytes):
        part = _search(texts, index)
        if alone:
            return part
        found = found.unionByName(kept(part, "contained"))
    return found


def item_blocks(
    items: DataFrame, item_col: str, item_text_col: str, shingle_words: int, threshold: float, block_bytes: int
) -> Iterator[tuple[ItemIndex, bool]]:
    """Indexes of the items, block by block, each made when it is asked for; and whether it is the only one."""
    wanted = items.select(F.col(item_col).cast("long").alias("item_id"), F.col(item_text_col).cast("string").alias("text"))
    wanted = wanted.where(F.length("text") > 0).distinct()
    total = wanted.agg(F.sum(F.octet_length("text"))).first()[0] or 0
    blocks = -(-total // block_bytes)
    for block in range(blocks):
        own = wanted.where(F.pmod(F.xxhash64("item_id", "text"), F.lit(blocks)) == block)
        rows = sorted(((r["item_id"], r["text"]) for r in own.collect()), key=lambda x: (x[0] is not None, *x))
        yield ItemIndex(rows, shingle_words, threshold), blocks == 1


SCHEMA = "doc_id long, item_id long, n_shared long, n_shingles long, containment double"


def _search(texts: DataFrame, index: ItemIndex) -> DataFrame:
    sent = texts.sparkSession.sparkContext.broadcast(index.sent())

    task: list[ItemIndex] = []  # this task's copy

    def work(batch: pa.RecordBatch) -> pa.RecordBatch:
        if not task:
            task.append(ItemIndex.received(sent.value))
        rows, index = [], task[0]
        for doc_id, text in zip(batch.column("doc_id").to_pylist(), texts_of(batch.column("text"))):
            best: dict[int | None, tuple] = {}
            for item_id, shared, size in index.found_in(text.decode()):
                row = (doc_id, item_id, shared, size, shared / size)
                best[item_id] = max(best.get(item_id, row), row, key=lambda r: (r[4], r[3]))
            rows += best.values()
        columns = list(zip(*rows)) if rows else [[]] * 5
        kinds = [pa.int64()] * 4 + [pa.float64()]
        return pa.RecordBatch.from_arrays([pa.array(x, k) for x, k in zip(columns, kinds)], ["doc_id", "item_id", "n_shared", "n_shingles", "containment"])

    return map_arrow(texts, work, SCHEMA)


def decontaminate(
    docs: DataFrame,
    items: DataFrame,
    text_col: str = "text",
    item_col: str = "item_id",
    item_text_col: str = "text",
    shingle_words: int = 5,
    threshold: float = 0.8,
    block_bytes: int = BLOCK_BYTES,
) -> DataFrame:
    """The rows of ``docs``, all columns, whose text holds none of the items: one pass for each block of items, no shuffle.

    With several blocks, the rows that one leaves are written before the next is indexed."""
    for index, alone in item_blocks(items, item_col, item_text_col, shingle_words, threshold, block_bytes):
        docs = _without(docs, index, text_col)
        if not alone:
            docs = kept(docs, "decontaminated")
    return docs


def _without(docs: DataFrame, index: ItemIndex, text_col: str) -> DataFrame:
    sent = docs.sparkSession.sparkContext.broadcast(index.sent())

    def run(batches):
        own = ItemIndex.received(sent.value)
        for batch in batches:
            texts = texts_of(batch.column(batch.schema.get_field_index(text_col)))
            clean = [next(own.found_in(t.decode()), None) is None for t in texts]
            yield batch.filter(pa.array(clean, pa.bool_()))

    return docs.mapInArrow(run, docs.schema)
