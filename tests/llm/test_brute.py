"""Queries without SQL against plain versions, and the pipeline on odd tables."""

from __future__ import annotations

import math
from bisect import bisect_right
from collections import Counter, defaultdict

import pytest
import xxhash

import corpus_pipeline
from retailmart.llm import toxicity
from retailmart.llm.labelled import held_out
from retailmart.llm.mixing import mix
from retailmart.llm.quality_gam import features, fit_quality, score_quality
from retailmart.llm.sharding import shard_plan
from retailmart.llm.toxicity import fit_toxicity, score_toxicity


def chained(*values: int | None) -> int:
    """Spark's 64-bit hash of an int, a long and an int, signed."""
    h = 42
    for value, size in zip(values, (4, 8, 4)):
        if value is not None:
            h = xxhash.xxh64_intdigest(value.to_bytes(size, "little", signed=True), h)
    return h - (1 << 64) if h >> 63 else h


def shard(doc_id: int | None, shards: int) -> int:
    return max((chained(42, doc_id, k), k) for k in range(shards))[1]


def test_shards_by_brute_force(messy, sample):
    for docs in (messy, sample):
        for r in shard_plan(docs).collect():
            assert (r["shard"], r["grown_shard"]) == (shard(r["doc_id"], 8), shard(r["doc_id"], 9))


def schedule(shares: dict[str, int], slots: int) -> list[str]:
    """Whose block each slot takes: of the blocks released, the one due first."""
    length, done, out = sum(shares.values()), Counter(), []
    for slot in range(slots):
        ready = []
        for name, w in shares.items():
            release, due = done[name] * length // w, math.ceil((done[name] + 1) * length / w)
            if release <= slot:
                ready.append((due, name))
        out.append(min(ready)[1])
        done[out[-1]] += 1
    return out


@pytest.mark.parametrize(("weights", "rest", "block"), [({"src0": 30, "src1": 15, "src2": 10}, 45, 4), ({"src3": 3, "nowhere": 9}, 2, 7), ({}, 1, 5)])
def test_the_whole_mixture_by_brute_force(sample, weights, rest, block):
    rows = mix(sample, weights, rest, block_rows=block).collect()
    held = Counter(r["source"] for r in rows)
    shares = {f"s:{s}": w for s, w in weights.items() if s in held}
    others = sorted((s for s in held if s not in weights), key=lambda s: (s is not None, s))
    if others or not shares:
        shares["rest"] = rest
    order = schedule(shares, 1 + max(r["slot"] for r in rows))
    places = defaultdict(list)
    for slot, name in enumerate(order):
        places[name].append(slot)
    for r in rows:
        if r["source"] in weights:
            want = places[f"s:{r['source']}"][r["block"]]
        else:
            want = places["rest"][r["block"] * len(others) + others.index(r["source"])]
        assert r["slot"] == want
    sizes = Counter((r["source"], r["block"]) for r in rows)
    assert all(n == block or b == (held[s] - 1) // block for (s, b), n in sizes.items())


def plain_score(model, text: str | None) -> float:
    """Bin by bin; an edge belongs to the bin above it."""
    x = features((text or "").encode())
    bins = [bisect_right(list(edges), value) for edges, value in zip(model.edges, x)]
    total = model.base + sum(float(table[b]) for table, b in zip(model.tables, bins))
    total += sum(float(table[bins[i]][bins[j]]) for i, j, table in model.pairs)
    return 1 / (1 + math.exp(-total))


def test_quality_scores_from_the_tables(spark, labels, messy, sample):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = fit_quality(docs, labels)
    for frame in (messy, sample):
        texts = {(r["doc_id"], i): r["text"] for i, r in enumerate(frame.collect())}
        wanted = Counter((d, round(plain_score(model, t), 9)) for (d, _), t in texts.items())
        rows = score_quality(frame, model).collect()
        assert Counter((r["doc_id"], round(r["score"], 9)) for r in rows) == wanted
        assert all(r["predicted"] == int(r["score"] >= 0.3) for r in rows)
    none = [r["score"] for r in score_quality(messy.where("text is null or text = ''"), model).collect()]
    assert len(none) == 3 and len(set(none)) == 1


def test_toxicity_scores_from_the_model(spark, labels, messy, sample):
    docs = spark.read.parquet("/root/testdata/sf0.01/documents.parquet")
    model = fit_toxicity(docs, labels.withColumn("toxic", labels["toxic"]))
    lexicon = toxicity.Lexicon(model.terms, frozenset(model.known))
    for frame in (messy, sample):
        wanted = Counter()
        for r in frame.collect():
            found = toxicity.signals(toxicity.hits(r["text"] or "", lexicon, {}))
            total = model.weights[0] + sum(w * x for w, x in zip(model.weights[1:], found))
            wanted[r["doc_id"], round(1 / (1 + math.exp(-total)), 9)] += 1
        rows = score_toxicity(frame, model).collect()
        assert Counter((r["doc_id"], round(r["score"], 9)) for r in rows) == wanted
        assert all(r["predicted"] == int(r["score"] >= 0.5) for r in rows)
    none = {r["score"] for r in score_toxicity(messy.where("text is null or text = ''"), model).collect()}
    assert none == {1 / (1 + math.exp(-model.weights[0]))}


def test_held_out_rows_by_brute_force(sample):
    import zlib

    got = {r["doc_id"]: r["h"] for r in sample.select("doc_id", held_out(sample["doc_id"]).alias("h")).collect()}
    assert got == {d: zlib.crc32(str(d).encode()) % 5 == 0 for d in got}


def written(spark, folder, docs, items):
    docs.write.parquet(str(folder / "documents.parquet"))
    items.write.parquet(str(folder / "benchmark.parquet"))
    return str(folder)


def test_pipeline_on_odd_tables(spark, messy, no_docs, tmp_path):
    """Nulls, empty, very long and repeated texts, ties, clashing columns, empty tables."""
    items = spark.createDataFrame([(1, "never found in any of these texts at all"), (2, None), (None, "")], "item_id long, text string")
    sf = written(spark, tmp_path / "messy", messy, items)
    rows = corpus_pipeline.run(spark, sf).collect()
    texts = {(r["doc_id"], r["text"]) for r in messy.collect()}
    assert 0 < len(rows) < messy.count()
    assert {(r["doc_id"], r["text"]) for r in rows} <= texts
    assert all(r["text"] for r in rows)
    assert len({(r["shard"], r["slot"]) for r in rows}) == len(rows)
    assert len({r["text"] for r in rows}) == len(rows)
    prose = next(t for d, t in texts if d == 1)
    assert [r["doc_id"] for r in rows if r["text"] == prose] == [1]
    assert corpus_pipeline.run(spark, written(spark, tmp_path / "none", no_docs, items.limit(0))).collect() == []
    left = corpus_pipeline.run(spark, written(spark, tmp_path / "no-items", messy, items.limit(0))).count()
    assert left == len(rows)
