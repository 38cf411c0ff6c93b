"""Spelling variants against brute force over all pairs of words."""

from __future__ import annotations

import random
import re
import zlib
from collections import Counter

import numpy as np
import pytest

from retailmart.llm.spelling import SortedLists, near_words, spelling_variants

LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


def one_edit(a: str, b: str) -> bool:
    if len(a) > len(b):
        a, b = b, a
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    return len(b) - len(a) == 1 and any(b[:i] + b[i + 1 :] == a for i in range(len(b)))


def brute_counts(docs, least, drop):
    counts = Counter()
    for doc, text in docs:
        for run in re.findall("[A-Za-zÀ-ÿ]+", text or ""):
            run = run.translate(LOWER)
            h = zlib.crc32(f"{'' if doc is None else doc}:{run}".encode())
            if h % drop == 0:
                run = run[: h % len(run)] + run[h % len(run) + 1 :]
            if len(run) >= least:
                counts[run] += 1
    return counts


def brute(docs, least=6, times=5, ratio=5, drop=199):
    counts = {w: n for w, n in brute_counts(docs, least, drop).items() if n >= times}
    near = {w: [v for v in counts if one_edit(v, w)] for w in counts}
    form = {}
    for w, others in near.items():
        best = min(others, key=lambda v: (-counts[v], v), default=None)
        form[w] = best if best and counts[best] >= ratio * counts[w] else None
    out = []
    for w, n in counts.items():
        root = w
        while form[root]:
            root = form[root]
        out.append((w, form[w], root, n, len(near[w]), counts[form[w]] if form[w] else None))
    return sorted(out)


def found(df):
    return sorted(tuple(r[c] for c in ("word", "form", "root", "n", "n_near", "form_n")) for r in df.collect())


def misspelled(seed: int, n_docs: int = 60):
    """Documents over few words, with one or two edits in some."""
    rng = random.Random(seed)
    letters = "abcdeé×ÿ"
    base = ["".join(rng.choice(letters) for _ in range(rng.randrange(5, 14))) for _ in range(40)]
    docs = []
    for i in range(n_docs):
        words = []
        for _ in range(120):
            w = base[min(int(rng.expovariate(0.2)), 39)]
            while rng.random() < 0.3:
                at, kind = rng.randrange(len(w) + 1), rng.randrange(3)
                w = w[:at] + (rng.choice(letters) if kind else "") + w[at + (kind != 2) :]
            words.append(w.upper() if rng.random() < 0.1 else w)
        docs.append((i, rng.choice(" ,-1漢").join(words)))
    return docs


@pytest.mark.parametrize(("seed", "drop", "list_words"), [(1, 199, 50_000), (2, 7, 50_000), (3, 199, 20), (4, 3, 4)])
def test_equals_brute_force(spark, seed, drop, list_words):
    docs = misspelled(seed)
    df = spark.createDataFrame(docs, "doc_id long, text string").repartition(3)
    wanted = brute(docs, drop=drop)
    assert found(spelling_variants(df, drop=drop, list_words=list_words)) == wanted
    assert any(r[1] for r in wanted) and any(r[4] > 3 for r in wanted)


def test_given_documents_equal_brute_force(spark):
    """All documents of the smallest table; pairs by their deletion variants, which no list or matrix has a part in."""
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    got = found(spelling_variants(docs))
    counts = {w: n for w, n in brute_counts([(r.doc_id, r.text) for r in docs.collect()], 6, 199).items() if n >= 5}
    shared: dict[str, set[str]] = {}
    for w in counts:
        for v in {w, *(w[:i] + w[i + 1 :] for i in range(len(w)))}:
            shared.setdefault(v, set()).add(w)
    near = {w: set() for w in counts}
    for group in shared.values():
        for w in group:
            near[w] |= {v for v in group if one_edit(v, w)}
    assert len(got) == len(counts) > 500
    assert {r[0]: (r[3], r[4]) for r in got} == {w: (counts[w], len(near[w])) for w in counts}


def test_chains_of_forms_end_at_the_root(spark):
    chain = [("abcdef", 5), ("abcdeg", 25), ("abcdhg", 125), ("abcihg", 625), ("abjihg", 3125), ("akjihg", 15625)]
    docs = [(k, " ".join([w] * n)) for k, (w, n) in enumerate(chain)]
    rows = found(spelling_variants(spark.createDataFrame(docs, "doc_id long, text string"), drop=10**9 + 7))
    assert {r[2] for r in rows} == {"akjihg"}
    assert sorted((r[0], r[1]) for r in rows if r[1]) == [(a[0], b[0]) for a, b in zip(chain, chain[1:])]


@pytest.mark.parametrize("list_words", [2, 50, 10_000])
def test_lists_of_one_prefix(spark, list_words):
    """A third of all words in one list; runs of one letter, and one letter more at either end."""
    rng = random.Random(9)
    words = {"prefix" + "".join(rng.choice("xyz") for _ in range(rng.randrange(1, 7))) for _ in range(300)}
    words |= {"a" * k for k in range(6, 20)} | {"a" * 3000, "a" * 3001, "b" + "a" * 3000}
    words = sorted(words)
    rows = near_words(spark.createDataFrame([(w, 7) for w in words], "word string, n long"), 6, list_words)
    wanted = {w: sum(one_edit(v, w) for v in words if abs(len(v) - len(w)) < 2) for w in words}
    got = {r.word: r.n_near for r in rows.collect()}
    assert got == {w: n for w, n in wanted.items() if n}


def test_odd_documents(messy, no_docs):
    rows = found(spelling_variants(messy))
    assert rows == brute([(r.doc_id, r.text) for r in messy.collect()])
    assert spelling_variants(no_docs).collect() == []


def test_matrix_rows_are_those_of_the_whole_matrix():
    rng = random.Random(4)
    words = sorted({"".join(rng.choice("ab") for _ in range(rng.randrange(1, 6))) for _ in range(60)})
    data = np.frombuffer("".join(words).encode(), np.uint8)
    offsets = np.append(0, np.cumsum([len(w) for w in words]))
    begins = np.zeros(len(words), bool)
    begins[[0, len(words) // 2]] = True
    lists = SortedLists(data, offsets, begins)
    a, b = lists.one_edit(0, len(words))
    half = len(words) // 2
    wanted = {(i, j) for i in range(len(words)) for j in range(i + 1, len(words)) if (i < half) == (j < half) and one_edit(words[i], words[j])}
    assert sorted(zip(a.tolist(), b.tolist())) == sorted(wanted)
