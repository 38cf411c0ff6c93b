"""Both substring operators against brute force."""

from __future__ import annotations

import hashlib
from collections import Counter

import numpy as np
import pytest

from retailmart.llm import phrase_dedup, suffix_dedup
from retailmart.llm.suffix_dedup import RunLengthIndex
from retailmart.llm.windows import ByteUnits, WordUnits


def sha(b: bytes) -> str:
    return hashlib.sha256(b).hexdigest()


def brute_bytes(texts: list[bytes], length: int) -> list[tuple]:
    count = Counter(t[i : i + length] for t in texts for i in range(len(t) - length + 1))
    out = []
    for t in texts:
        gone, reach = bytearray(len(t)), 0
        for i in range(len(t) - length + 1):
            if count[t[i : i + length]] > 1:
                a = max(i, reach)
                gone[a : i + length] = b"\1" * (i + length - a)
                reach = i + length
        spans = sum(1 for i, g in enumerate(gone) if g and not (i and gone[i - 1]))
        out.append((len(t), sum(gone), spans, sha(bytes(b for b, g in zip(t, gone) if not g))))
    return out


def brute_words(docs: list[tuple], length: int) -> dict:
    """By document; rows equal in id and text are one document."""
    seen, out = set(), {}
    for doc in sorted(set(docs), key=lambda d: (d[0] is not None, d)):
        words = doc[1].split()
        gone = bytearray(len(words))
        for i in range(len(words) - length + 1):
            phrase = tuple(words[i : i + length])
            if phrase in seen:
                gone[i : i + length] = b"\1" * length
            seen.add(phrase)
        out[doc] = (len(words), sum(gone), sha(b" ".join(w for w, g in zip(words, gone) if not g)))
    return out


def collected(df, columns):
    order = lambda r: [(v is None, str(v)) for v in r]
    return sorted((tuple(r[c] for c in ("doc_id", *columns)) for r in df.collect()), key=order)


def ordered(rows):
    return sorted(rows, key=lambda r: [(v is None, str(v)) for v in r])


BYTES = ("n_bytes", "n_removed", "n_spans", "kept_sha256")
WORDS = ("n_words", "n_removed", "kept_sha256")


@pytest.mark.parametrize(("group", "block"), [(4000, 1_000_000), (1, 1_000), (4000, 500)])
def test_bytes_equal_brute_force(sample, messy, group, block):
    for docs in (messy, sample):
        rows = [(r["doc_id"], (r["text"] or "").encode()) for r in docs.select("doc_id", "text").collect()]
        want = [(i, *x) for (i, _), x in zip(rows, brute_bytes([t for _, t in rows], 200))]
        got = suffix_dedup.suffix_dedup(docs, group=group, block_bytes=block)
        assert collected(got, BYTES) == ordered(want)


@pytest.mark.parametrize(("group", "block"), [(4000, 1_000_000), (1, 1_000)])
def test_words_equal_brute_force(sample, messy, group, block):
    for docs in (messy, sample):
        rows = [(r["doc_id"], (r["text"] or "").encode()) for r in docs.select("doc_id", "text").collect()]
        by_doc = brute_words(rows, 20)
        got = phrase_dedup.phrase_dedup(docs, group=group, block_bytes=block)
        assert collected(got, WORDS) == ordered([(d[0], *by_doc[d]) for d in rows])


def test_kept_text_hashes_alike(messy):
    kept = {(r["doc_id"], sha(r["kept"])) for r in suffix_dedup.deduplicated(messy).collect()}
    assert kept == {(r["doc_id"], r["kept_sha256"]) for r in suffix_dedup.suffix_dedup(messy).collect()}
    kept = {(r["doc_id"], sha(r["kept"].encode())) for r in phrase_dedup.deduplicated(messy).collect()}
    assert kept == {(r["doc_id"], r["kept_sha256"]) for r in phrase_dedup.phrase_dedup(messy).collect()}


def test_empty_table(no_docs):
    assert suffix_dedup.suffix_dedup(no_docs).collect() == []
    assert phrase_dedup.phrase_dedup(no_docs).collect() == []


def test_matching_statistics_equal_brute_force():
    rng = np.random.default_rng(3)
    parts = [np.append(rng.integers(1, 4, 60), 300 + k) for k in range(5)]
    text = np.concatenate([*parts, parts[0][:50], [400]]).astype(np.int64)
    symbols = text.tolist()

    def common(a: int, b: int) -> int:
        n = 0
        while max(a, b) + n < len(symbols) and symbols[a + n] == symbols[b + n]:
            n += 1
        return n

    want = [max(common(i, j) for j in range(len(symbols)) if j != i) for i in range(len(symbols))]
    for ends in (None, 300):
        index = RunLengthIndex(text, ends=ends)
        assert index.matching_statistics().tolist() == want
        assert len(index.heads) < len(text)


def test_matching_statistics_of_short_and_empty_passages():
    rng = np.random.default_rng(1)
    for _ in range(60):
        parts = [np.append(rng.integers(1, rng.integers(2, 5), rng.integers(0, 30)), 257 + k) for k in range(rng.integers(1, 6))]
        symbols = [int(x) for part in parts for x in part]
        text = np.array(symbols, np.int64)
        ahead = [[0] * (len(symbols) + 1) for _ in range(len(symbols) + 1)]
        for i in reversed(range(len(symbols))):
            for j in reversed(range(len(symbols))):
                ahead[i][j] = 1 + ahead[i + 1][j + 1] if symbols[i] == symbols[j] and i != j else 0
        want = [max(ahead[i]) for i in range(len(symbols))]
        for ends in (None, 257):
            assert RunLengthIndex(text, ends=ends).matching_statistics().tolist() == want


def test_a_run_of_copies_answers_as_its_copies_would():
    """A text with its count in the index: the statistics of the text beside its copies, all written out."""
    rng = np.random.default_rng(5)
    parts = [rng.integers(1, 4, size) for size in (40, 25, 33, 12)]
    times = [3, 1, 2, 1]
    once = np.concatenate([np.append(p, 300 + k) for k, p in enumerate(parts)]).astype(np.int64)
    spread = [p for p, t in zip(parts, times) for _ in range(t)]
    whole = np.concatenate([np.append(p, 300 + k) for k, p in enumerate(spread)]).astype(np.int64)
    ends = np.flatnonzero(once >= 300)
    begins = np.append(0, ends[:-1] + 1)
    often = np.array(times) > 1
    got = RunLengthIndex(once, (begins[often], ends[often])).matching_statistics()
    want = RunLengthIndex(whole).matching_statistics()
    at = 0
    for k, t in enumerate(times):
        size = len(parts[k])
        for _ in range(t):
            assert got[begins[k] : begins[k] + size].tolist() == want[at : at + size].tolist()
            at += size + 1


def test_the_index_and_the_automaton_decide_copies(sample, monkeypatch):
    """With what they find left out, nothing is removed: no other path settles copies."""
    assert any(r["n_removed"] for r in suffix_dedup.suffix_dedup(sample).collect())
    assert any(r["n_removed"] for r in phrase_dedup.phrase_dedup(sample).collect())
    monkeypatch.setattr(suffix_dedup, "_index_block", lambda table, length: None)
    monkeypatch.setattr(phrase_dedup, "_automaton_block", lambda table, length: None)
    assert not any(r["n_removed"] for r in suffix_dedup.suffix_dedup(sample).collect())
    assert not any(r["n_removed"] for r in phrase_dedup.phrase_dedup(sample).collect())


def test_grams_depend_on_their_units_only():
    import pyarrow as pa

    for units, text in ((ByteUnits(200), "abcdefghij" * 30), (WordUnits(20), "a bb ccc dddd eeeee " * 30)):
        alone = units.grams(units.read(pa.array([text])))
        moved = units.grams(units.read(pa.array(["zz zz ", text])))
        assert (moved[-len(alone) :] == alone).all()
        assert len(np.unique(alone)) > 1


def test_repeated_rows_are_folded(spark, monkeypatch):
    """Rows without an id and with one text: one row of work, the result as often as the row was found."""
    from retailmart.llm import windows

    monkeypatch.setattr(windows, "COPIES", 7)
    text = " ".join(f"word{i * 7919 % 10007}" for i in range(300))
    rows = [(None, text)] * 60 + [(1, "short")] * 3 + [(2, text + " end"), (3, "alone " * 3)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    folded, repeats = windows.folded_rows(windows.doc_rows(docs))
    assert repeats and sorted(r["rows"] for r in folded.collect()) == [1, 1, 3, 60]
    units = windows.ByteUnits(200, 48)
    passages = windows.found_passages(folded, units).collect()
    assert len({(r["doc_id"], r["th"], r["lo"]) for r in passages}) == len(passages)
    got = suffix_dedup.suffix_dedup(docs).collect()
    assert sorted(str(r["doc_id"]) for r in got) == sorted(str(d) for d, _ in rows)
    assert {(r["doc_id"], r["n_removed"]) for r in got} == {(None, len(text)), (1, 0), (2, len(text)), (3, 0)}
    words = phrase_dedup.phrase_dedup(docs).collect()
    assert sorted(str(r["doc_id"]) for r in words) == sorted(str(d) for d, _ in rows)
    assert {(r["doc_id"], r["n_removed"]) for r in words} == {(None, 0), (1, 0), (2, 300), (3, 0)}
    only = spark.createDataFrame([(None, text)] * 20, "doc_id long, text string")
    assert {r["n_removed"] for r in suffix_dedup.suffix_dedup(only).collect()} == {len(text)}
    assert {r["n_removed"] for r in phrase_dedup.phrase_dedup(only).collect()} == {0}
