"""Spelling variants: words one edit apart, found by scanning sorted lists with a banded edit matrix.

Two words one edit apart share all code points before and behind a short hole that holds the edit. Words are dealt by
what surrounds the hole, so that near words meet in one list. Each list is sorted; the rows of the edit matrix that a
shared prefix has already filled are kept for all words of that prefix, and a range whose prefix costs more than one
edit is skipped whole.
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator
from math import ceil, log, log2

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from retailmart.llm.texts import doc_texts, kept, slices, texts_of

#: One run's code point in so many is dropped before words are counted (by a hash of document and run).
DROP = 199
#: Words of a list beyond which its hole is cut in two. A hole of one code point bounds a list by the alphabet.
LIST_WORDS = 50_000
#: Words that a task scans lists for at once, and words of all lists it holds for them.
QUERIES, CHUNK = 2_000, 20_000
#: Different words that a task counts before it passes them on.
COUNTED = 200_000

#: Latin-1 letters to themselves, A-Z to lower case, all else to a blank.
_LETTERS = bytes(c | 32 if 65 <= c <= 90 else c if 97 <= c <= 122 or c >= 0xC0 else 32 for c in range(256))


def counted_words(docs: DataFrame, min_length: int, drop: int = DROP, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """(word, n): how often each word of ``min_length`` code points or more occurs.

    Counts are folded in each task before the shuffle. Of a run whose hash is divisible by ``drop``, one code point is
    left out. A null text holds no word; a null id stands for no digits in the hash.
    """

    def passed(counts: Counter) -> pa.RecordBatch:
        found = [(w.decode("latin-1"), n) for w, n in counts.items() if n and len(w) >= min_length]
        return pa.RecordBatch.from_arrays(
            [pa.array([w for w, _ in found], pa.string()), pa.array([n for _, n in found], pa.int64())], ["word", "n"]
        )

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        counts: Counter = Counter()
        for batch in batches:
            for piece in slices(batch):
                for doc, text in zip(piece.column("doc_id").to_pylist(), texts_of(piece.column("text"))):
                    # One byte a code point: what Latin-1 lacks is no letter here.
                    plain = text.decode("utf-8", "replace").encode("latin-1", "replace").translate(_LETTERS)
                    words = [w for w in plain.split() if len(w) >= min_length]
                    counts.update(words)
                    seed = zlib.crc32(b"%s:" % (b"" if doc is None else b"%d" % doc))
                    hashed = ((w, zlib.crc32(w if w.isascii() else w.decode("latin-1").encode(), seed)) for w in set(words))
                    for w, h in [(w, h) for w, h in hashed if h % drop == 0]:
                        times, at = words.count(w), h % len(w)
                        counts[w] -= times
                        counts[w[:at] + w[at + 1 :]] += times
                if len(counts) >= COUNTED:
                    yield passed(counts)
                    counts = Counter()
        if counts:
            yield passed(counts)

    found = doc_texts(docs, id_col, text_col).mapInArrow(run, "word string, n long")
    return found.groupBy("word").agg(F.sum("n").alias("n"))


def _placed(entries: DataFrame) -> DataFrame:
    """Add ``key``, what stands around the hole, and ``middle``, what stands in it; the longer word's hole is one wider."""
    width = F.col("hole") + F.length("word") - F.col("short")
    around = [F.substr("word", F.lit(1), F.col("at")), F.substr("word", F.col("at") + width + 1)]
    return entries.withColumns(
        {
            "key": F.concat_ws("|", F.col("short").cast("string"), F.col("at").cast("string"), *around),
            "middle": F.substr("word", F.col("at") + 1, width),
        }
    )


def _halves(at: Column, hole: Column) -> Column:
    half = F.floor(hole / 2).cast("int")
    first = F.struct(at.alias("at"), half.alias("hole"))
    return F.array(first, F.struct((at + half).alias("at"), (hole - half).alias("hole")))


def _lists(words: DataFrame, min_length: int, list_words: int) -> DataFrame:
    """Each word under the keys of the lists in which it meets its near words.

    ``short`` is the length of the shorter word of a pair: a word stands for itself and as the longer one. The hole is
    either half of the shorter word; lists of over ``list_words`` words are cut by halving their hole again.
    """
    size = F.length("word").cast("int")
    roles = words.withColumn("short", F.explode(F.array(size, size - 1))).where(F.col("short") >= min_length)
    entries = roles.withColumn("_piece", F.explode(_halves(F.lit(0), F.col("short"))))
    placed = _placed(entries.select("word", "n", "short", "_piece.*"))
    while True:
        sizes = placed.where("hole > 1").groupBy("key").agg(F.count("*").alias("_rows"))
        large = kept(sizes.where(F.col("_rows") > list_words).select("key"), "large-lists")
        if large.isEmpty():
            return placed
        cut = placed.join(large, "key", "left_semi").withColumn("_piece", F.explode(_halves(F.col("at"), F.col("hole"))))
        fine = _placed(cut.select("word", "n", "short", "_piece.*"))
        placed = kept(placed.join(large, "key", "left_anti").unionByName(fine), "lists")


class SortedLists:
    """Several sorted lists of different words one behind the other, as bytes; ``begins`` marks the first word of each."""

    def __init__(self, data: np.ndarray, offsets: np.ndarray, begins: np.ndarray):
        self.data = np.append(data, np.zeros(1, np.uint8))
        self.at, self.size = offsets[:-1], np.diff(offsets)
        starts = np.flatnonzero(begins)
        which = np.cumsum(begins) - 1
        self.lo, self.hi = starts[which], np.append(starts[1:], len(begins))[which]
        self.shared = np.where(begins, -1, 0)
        left, depth = np.flatnonzero(~begins), 0
        while len(left):
            same = self.char(left, depth) == self.char(left - 1, depth)
            left = left[same & (self.size[left] > depth) & (self.size[left - 1] > depth)]
            depth += 1
            self.shared[left] = depth
        #: By depth, where each range of words starts that share so many code points.
        self.ranges = [np.flatnonzero((self.size > d) & (self.shared <= d)) for d in range(int(self.size.max(initial=0)))]

    def char(self, word: np.ndarray, place: int) -> np.ndarray:
        """The byte at a place; 0 before the word and behind it."""
        inside = (self.size[word] > place) & (place >= 0)
        return np.where(inside, self.data[np.where(inside, self.at[word] + place, -1)], 0)

    def one_edit(self, first: int, last: int) -> tuple[np.ndarray, np.ndarray]:
        """Pairs (a, b) of words exactly one edit apart in one list, with a from ``first`` to ``last`` and b behind a."""
        q = np.arange(first, last)
        lo, hi = self.lo[q], self.hi[q]
        # Three cells of the matrix row: as many code points of a as of b, one less, one more.
        less, even, more = np.full(len(q), 9, np.int8), np.zeros(len(q), np.int8), np.ones(len(q), np.int8)
        found = []
        for depth, ranges in enumerate(self.ranges):
            begin, end = np.searchsorted(ranges, lo), np.searchsorted(ranges, hi)
            n = end - begin
            pair = np.repeat(np.arange(len(q)), n)
            at = np.arange(len(pair)) - np.repeat(np.cumsum(n) - n, n) + begin[pair]
            upto = np.append(ranges, 0)[at + 1]
            upto = np.where(at + 1 < end[pair], upto, hi[pair])
            behind = upto > q[pair] + 1
            pair, at, hi = pair[behind], at[behind], upto[behind]
            q, lo = q[pair], ranges[at]
            letter = self.char(lo, depth)
            old_less, old_even, old_more = less[pair], even[pair], more[pair]
            less = np.minimum(old_even + 1, old_less + (self.char(q, depth - 1) != letter))
            even = np.minimum(np.minimum(old_more, less) + 1, old_even + (self.char(q, depth) != letter))
            more = np.minimum(even + 1, old_more + (self.char(q, depth + 1) != letter))
            whole = np.flatnonzero((self.size[lo] == depth + 1) & (lo > q))
            gap = self.size[q[whole]] - depth - 1
            cost = np.select([gap == -1, gap == 0, gap == 1], [less[whole], even[whole], more[whole]], 9)
            whole = whole[cost == 1]
            found.append((q[whole], lo[whole]))
            # A range whose prefix costs more than one edit is left out with all its words.
            alive = np.minimum(np.minimum(less, even), more) <= 1
            q, lo, hi, less, even, more = (x[alive] for x in (q, lo, hi, less, even, more))
            if not len(q):
                break
        if not found:
            return np.zeros(0, np.int64), np.zeros(0, np.int64)
        return np.concatenate([a for a, _ in found]), np.concatenate([b for _, b in found])


def _scan(table: pa.Table) -> pa.RecordBatch | None:
    """The near words of each word of whole lists: how many, and the most frequent."""
    middles = table.column("middle").to_pylist()
    sizes = np.array([len(m) for m in middles], np.int64)
    data = np.frombuffer("".join(middles).encode("latin-1"), np.uint8)
    keys = table.column("key").combine_chunks()
    begins = np.append([True], pc.not_equal(keys[1:], keys[:-1]).to_numpy(zero_copy_only=False))
    lists = SortedLists(data, np.append([0], np.cumsum(sizes)), begins)
    hole, short, at, n = (table.column(c).to_numpy() for c in ("hole", "short", "at", "n"))
    longer = sizes > hole
    inner = at + hole < short  # something stands behind the hole
    order = pc.sort_indices(table.column("word")).to_numpy()
    rank = np.empty(len(order), np.int64)
    rank[order] = np.arange(len(order))
    parts = []
    for first in range(0, len(sizes), QUERIES):
        a, b = lists.one_edit(first, min(first + QUERIES, len(sizes)))
        fits = ~(longer[a] & longer[b])
        a, b = a[fits], b[fits]
        # An added code point that could stand behind the hole as well counts there, so that no pair counts twice.
        moved = (longer[a] != longer[b]) & inner[a]
        for k in np.flatnonzero(moved):
            x, y = middles[a[k]], middles[b[k]]
            moved[k] = x.startswith(y) or y.startswith(x)
        parts.append((a[~moved], b[~moved]))
    a, b = np.concatenate([p for p, _ in parts]), np.concatenate([p for _, p in parts])
    a, b = np.append(a, b), np.append(b, a)
    if not len(a):
        return None
    by = np.lexsort((rank[b], -n[b], a))
    a, b = a[by], b[by]
    word, first, times = np.unique(a, return_index=True, return_counts=True)
    best = b[first]
    names = table.column("word").combine_chunks()
    columns = [names.take(pa.array(word)), pa.array(times), pa.array(n[best]), names.take(pa.array(best))]
    return pa.RecordBatch.from_arrays(columns, ["word", "n_near", "best_n", "best"])


def _whole_lists(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.Table]:
    """Rows sorted by key as tables of whole lists, of ``CHUNK`` words or a little more."""
    held: list[pa.RecordBatch] = []
    for batch in batches:
        held.append(batch)
        if sum(b.num_rows for b in held) < CHUNK:
            continue
        table = pa.Table.from_batches(held).combine_chunks()
        cut = pc.index(table.column("key"), table.column("key")[-1]).as_py()
        if cut:
            yield table.slice(0, cut)
        held = table.slice(cut).to_batches()
    if held:
        yield pa.Table.from_batches(held).combine_chunks()


def near_words(words: DataFrame, min_length: int, list_words: int = LIST_WORDS) -> DataFrame:
    """(word, n_near, best_n, best) for each word that has near words: their number, and the one of largest ``n``
    (ties: smallest). ``words`` holds (word, n), each word once, of Latin-1 letters."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for table in _whole_lists(b for b in batches if b.num_rows):
            out = _scan(table)
            if out is not None:
                yield out

    lists = _lists(words, min_length, list_words).select("key", "middle", "word", "n", "short", "at", "hole")
    dealt = lists.repartition("key").sortWithinPartitions("key", "middle")
    found = dealt.mapInArrow(run, "word string, n_near long, best_n long, best string")
    best = F.min(F.struct((-F.col("best_n")).alias("less"), F.col("best"))).alias("_best")
    summed = found.groupBy("word").agg(F.sum("n_near").alias("n_near"), best)
    return summed.select("word", "n_near", (-F.col("_best.less")).alias("best_n"), "_best.best")


def rooted(forms: DataFrame, rounds: int) -> DataFrame:
    """(word, root) from (word, form): each round doubles the number of forms that were followed."""
    links = forms.select("word", F.col("form").alias("root"))
    for _ in range(rounds):
        links = kept(links, "forms")
        further = links.select(F.col("word").alias("_via"), F.col("root").alias("_root"))
        links = links.join(further, links["root"] == further["_via"], "left").select("word", F.coalesce("_root", "root").alias("root"))
    return links


def spelling_variants(
    docs: DataFrame,
    min_length: int = 6,
    min_times: int = 5,
    ratio: int = 5,
    drop: int = DROP,
    list_words: int = LIST_WORDS,
    id_col: str = "doc_id",
    text_col: str = "text",
) -> DataFrame:
    """Every word with its more frequent spelling: word, form, root, n, n_near, form_n.

    Words are runs of Latin letters of ``min_length`` code points or more that occur ``min_times`` times or more. A
    word's form is its most frequent near word, if that is ``ratio`` times as frequent at least; the root is the last
    form of the chain. Null and empty texts hold no words; equal frequencies are settled by code-point order; rows that
    repeat count each time; an empty table gives no rows. Other columns are not looked at.
    """
    words = kept(counted_words(docs, min_length, drop, id_col, text_col).where(F.col("n") >= min_times), "words")
    fits = F.col("best_n") >= ratio * F.col("n")
    near = words.join(near_words(words, min_length, list_words), "word", "left").select(
        "word",
        "n",
        F.coalesce("n_near", F.lit(0)).alias("n_near"),
        F.when(fits, F.col("best")).alias("form"),
        F.when(fits, F.col("best_n")).alias("form_n"),
    )
    near = kept(near, "near-words")
    # Each form is ``ratio`` times as frequent as its word, which bounds the chain.
    most = max(near.agg(F.max("n")).first()[0] or 1, min_times)
    longest = max(1.0, log(most / min_times, ratio))
    links = rooted(near.where(F.col("form").isNotNull()), ceil(log2(longest)) + 1)
    joined = near.join(links, "word", "left")
    return joined.select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
