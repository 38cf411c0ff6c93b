"""Exact dedup against brute force, and the filters on their own."""

from __future__ import annotations

import hashlib

import numpy as np
import pytest
from hypothesis import given, settings
from hypothesis import strategies as st

from retailmart.llm import exact_dedup as ed
from retailmart.llm.exact_dedup import QuotientFilter, exact_dedup

WHITE = " \t\n\x0b\x0c\r"


def brute(docs):
    groups: dict[str, list] = {}
    for k, (doc, text) in enumerate(docs):
        body = "".join(c for c in text or "" if c not in WHITE)
        groups.setdefault(body, []).append((-len(text or ""), doc is None, doc or 0, k))
    out = []
    for body, rows in groups.items():
        best = min(rows)
        sha = hashlib.sha256(body.encode()).hexdigest()
        keep = None if best[1] else best[2]
        out += [(docs[r[3]][0], keep, len(rows), r == best, sha) for r in rows]
    return sorted(out, key=str)


def found(df):
    return sorted((tuple(r[c] for c in ("doc_id", "keep_id", "group_size", "kept", "text_sha256")) for r in df.collect()), key=str)


@settings(max_examples=60, deadline=None)
@given(st.lists(st.tuples(st.integers(0, 2**20 - 1), st.integers(1, 2**40)), max_size=60), st.sampled_from([20, 41, 64]))
def test_a_filter_gives_back_what_it_holds(items, width):
    values = np.array([v << (width - 20) for v, _ in items], np.uint64)
    values, counts = ed.folded(values, np.array([n for _, n in items], np.int64))
    back = QuotientFilter.of(values, counts, width).read()
    assert back[0].tolist() == values.tolist() and back[1].tolist() == counts.tolist()


@settings(max_examples=40, deadline=None)
@given(st.lists(st.lists(st.integers(0, 500), max_size=40), max_size=8))
def test_merging_adds_counts(parts):
    def one(part):
        return QuotientFilter.of(*ed.folded(np.array(part, np.uint64), np.ones(len(part), np.int64)), 12)

    merged = QuotientFilter.merged(one(p) for p in parts)
    whole = one([v for p in parts for v in p])
    assert [x.tolist() for x in merged.read()] == [x.tolist() for x in whole.read()]


def test_odd_documents(messy, no_docs):
    assert found(exact_dedup(messy)) == brute([(r.doc_id, r.text) for r in messy.collect()])
    assert exact_dedup(no_docs).collect() == []


def test_white_space_length_and_ties(spark):
    docs = [(5, "a b c"), (3, "abc"), (4, "a  bc"), (2, "abc"), (9, " abc"), (None, "a\tb c"), (None, "a\tb c"), (7, "A b c")]
    docs += [(20 + k, None if k % 2 else " \n") for k in range(6)]
    rows = found(exact_dedup(spark.createDataFrame(docs, "doc_id long, text string").repartition(4)))
    assert rows == brute(docs)
    assert sum(r[3] for r in rows) == len({r[4] for r in rows})


@pytest.mark.parametrize("bits", [8, 28])
def test_a_full_route_loses_nothing(spark, monkeypatch, bits):
    """With a table that lets nearly all texts through, the comparison settles the rest; filters of many tasks and flushes."""
    monkeypatch.setattr(ed, "ROUTE_BITS", bits)
    monkeypatch.setattr(ed, "GATHERED", 50)
    docs = [(k, f"text {k * k % 700} {'  ' * (k % 3)}") for k in range(1000)] + [(2000 + k, "hot") for k in range(500)]
    assert found(exact_dedup(spark.createDataFrame(docs, "doc_id long, text string").repartition(7))) == brute(docs)


def test_fingerprints_that_collide_are_told_apart(spark, monkeypatch):
    monkeypatch.setattr(ed, "_fingerprints", lambda sha: np.full(len(sha), 5 << 60, np.uint64))
    docs = [(k, f"text {k // 2}") for k in range(40)]
    rows = found(exact_dedup(spark.createDataFrame(docs, "doc_id long, text string").repartition(2)))
    assert rows == brute(docs)


def test_hot_group_stays_in_no_single_task(spark, largest_task):
    docs = spark.range(0, 30_000, 1, 8).selectExpr("id as doc_id", "if(id % 3 = 0, 'hot', concat('text ', id)) as text")
    total, largest = largest_task(lambda: exact_dedup(docs))
    assert total == 30_000
    assert largest < 9_000


def test_result_does_not_depend_on_partitions(sample):
    assert found(exact_dedup(sample.repartition(1))) == found(exact_dedup(sample.repartition(9)))
