from __future__ import annotations

import numpy as np
import pytest
import xxhash

from retailmart.llm.components import connected_components
from retailmart.llm.simhash import fingerprint, links, near_dedup, simhash_classes


def brute_print(text: str | None) -> int:
    words = (text or "").encode().lower().split()
    if not words:
        return 0
    shingles = [b" ".join(words[i : i + 3]) for i in range(len(words) - 2)] or [b" ".join(words)]
    hashes = [xxhash.xxh64_intdigest(s, 42) for s in shingles]
    return sum(1 << b for b in range(64) if 2 * sum(h >> b & 1 for h in hashes) > len(hashes))


def roots(prints: list[int], distance: int = 3) -> list[int]:
    """The number of the first member of each one's component, over all pairs."""
    x = np.array(prints, np.uint64)
    near = np.bitwise_count(x[:, None] ^ x[None, :]) <= distance
    label = np.arange(len(x))
    while True:
        least = np.where(near, label[None, :], len(x)).min(axis=1)
        if (least == label).all():
            return label.tolist()
        label = least


def test_classes_equal_brute_force(sample, messy):
    for docs in (sample, messy):
        rows = sorted(docs.select("doc_id", "text").collect(), key=lambda r: (r["doc_id"] is None, r["doc_id"]))
        prints = [brute_print(r["text"]) for r in rows]
        first = roots(prints)
        want = sorted((r["doc_id"] or -1, f"{p:016x}", rows[k]["doc_id"] or -1) for r, p, k in zip(rows, prints, first))
        found = [(r["doc_id"] or -1, r["fingerprint"], r["component_id"] or -1) for r in simhash_classes(docs).collect()]
        if any(r["doc_id"] == 0 for r in rows):
            found = [(a if a != -1 else 0, b, c if c != -1 else 0) for a, b, c in found]
            want = [(a if a != -1 else 0, b, c if c != -1 else 0) for a, b, c in want]
        assert sorted(found) == sorted(want)


@pytest.mark.parametrize("group", [2, 5, 512])
def test_links_connect_all_that_is_near_at_any_group_size(spark, group):
    rng = np.random.default_rng(5)
    prints = set()
    for centre in rng.integers(0, 1 << 62, 6):
        for _ in range(60):
            x = int(centre)
            for b in rng.integers(0, 64, rng.integers(0, 5)):
                x ^= 1 << int(b)
            prints.add(x)
    prints = sorted(prints)
    signed = [p - (1 << 64) if p >> 63 else p for p in prints]
    frame = spark.createDataFrame([(p,) for p in signed], "fp long")
    label = {r["node"]: r["root"] for r in connected_components(links(frame, 3, group)).collect()}
    got = [label.get(p, p) for p in signed]
    want = roots(prints)
    assert len(set(zip(got, want))) == len(set(got)) == len(set(want))


def test_one_of_each_class_stays(messy, no_docs):
    kept = near_dedup(messy)
    assert kept.columns == messy.columns
    ids = sorted(r["doc_id"] for r in kept.where("doc_id is not null").collect())
    assert 1 in ids and 2 not in ids and 4 in ids and 5 not in ids and 6 not in ids
    assert 8 in ids and 12 in ids and ids.count(13) == 1 and len(ids) == len(set(ids))
    classes = {r["fingerprint"] for r in simhash_classes(messy).collect()}
    assert kept.count() <= len(classes) and kept.where("doc_id is null").count() == 0
    assert near_dedup(no_docs).collect() == []
    assert simhash_classes(no_docs).collect() == []


def test_rows_without_an_id_or_with_one_id(spark):
    a, b = "one text of its own kind here", "quite another one that shares no words"
    rows = [(None, a), (None, a), (5, b), (5, a), (5, b), (9, "third text unlike the rest"), (0, None), (None, "")]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    got = sorted((r["doc_id"], r["text"] or "") for r in near_dedup(docs).collect())
    assert got == [(0, ""), (5, a), (5, b), (9, "third text unlike the rest")]
    alone = near_dedup(docs.where("doc_id is null")).collect()
    assert sorted((r["doc_id"], r["text"]) for r in alone) == [(None, ""), (None, a)]


def test_fingerprint_counts_repeats():
    assert fingerprint(b"a b c a b c a b c x") == fingerprint(b"A B  C\na b c a b c x")
    assert fingerprint(b"") == 0
