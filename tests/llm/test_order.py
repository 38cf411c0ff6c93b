"""Mixing and sharding."""

from __future__ import annotations

import zlib
from collections import defaultdict

import pytest

import corpus_pipeline
from retailmart.llm.mixing import cycle, lag, mix, mixed_rows
from retailmart.llm.sharding import shard_plan, sharded_rows, write_shards
from retailmart.llm.texts import numbered_copies


@pytest.mark.parametrize("weights", [{"a": 1}, {"a": 1, "b": 1}, {"a": 50, **{f"s{i}": 1 for i in range(50)}}, {"a": 30, "b": 15, "c": 10, "d": 5, "rest": 40}])
def test_the_schedule_keeps_within_a_block(weights):
    plan = cycle(weights)
    length = sum(weights.values())
    assert [slot for _, _, slot in plan] == list(range(length))
    for source, block, slot in plan:
        w = weights[source]
        assert block * length // w <= slot < -(-(block + 1) * length // w)
    assert lag(weights) < 1


def test_mix_places_every_row_once(messy, sample, no_docs):
    weights = {"a": 3, "src0": 3, "src1": 1}
    for docs in (messy, sample):
        rows = mix(docs, weights, rest=2, block_rows=2, bucket_rows=10).collect()
        assert sorted((r["doc_id"] is None, r["doc_id"]) for r in rows) == sorted((r["doc_id"] is None, r["doc_id"]) for r in docs.collect())
        places = [(r["slot"], r["slot_row"]) for r in rows]
        assert len(set(places)) == len(places)
        by_source = defaultdict(list)
        for r in rows:
            assert r["release"] <= r["slot"] < r["deadline"]
            by_source[r["source_group"]].append((r["slot"], r["slot_row"], r["block"]))
        for found in by_source.values():
            found.sort()
            assert [k // 2 for k in range(len(found))] == [b for _, _, b in found]
        again = mix(docs, weights, rest=2, block_rows=2, bucket_rows=10).collect()
        assert sorted(map(str, again)) == sorted(map(str, rows))
    assert mix(no_docs, weights).collect() == []


def test_mixed_rows_keep_columns_and_rows(messy, sample, no_docs):
    assert mixed_rows(no_docs, {"a": 1}).collect() == []
    got = mixed_rows(messy, {"a": 2}, block_rows=1)
    assert got.columns == messy.columns
    assert sorted(map(str, got.collect())) == sorted(map(str, messy.collect()))
    places = {r["doc_id"]: (r["slot"], r["slot_row"]) for r in mix(sample, {"src0": 2}, 3).collect()}
    order = [places[r["doc_id"]] for r in mixed_rows(sample, {"src0": 2}, 3).collect()]
    assert order == sorted(order)


def test_shards(messy, sample, no_docs):
    for docs in (messy, sample):
        texts = {(r["doc_id"], zlib.crc32((r["text"] or "").encode())): len((r["text"] or "").encode()) + 1 for r in docs.collect()}
        rows = shard_plan(docs, bucket_rows=5).collect()
        assert len(rows) == docs.count()
        slots = defaultdict(list)
        for r in rows:
            assert texts[r["doc_id"], r["text_crc32"]] == r["size"]
            assert r["law"] == "key" and r["grown_shard"] in (r["shard"], 8)
            slots[r["shard"]].append(r["slot"])
        assert all(sorted(s) == list(range(len(s))) for s in slots.values())
        assert sorted(map(str, rows)) == sorted(map(str, shard_plan(docs, bucket_rows=5).collect()))
        moved = shard_plan(docs.repartition(2), bucket_rows=5).collect()
        assert sorted((str(r["doc_id"]), r["shard"], r["grown_shard"]) for r in moved) == sorted((str(r["doc_id"]), r["shard"], r["grown_shard"]) for r in rows)
    assert shard_plan(no_docs).collect() == []


def test_sharded_rows_and_files(messy, spark, tmp_path, sample):
    got = sharded_rows(messy, bucket_rows=5)
    assert got.count() == messy.count() and set(got.columns) == set(messy.columns)
    write_shards(sample, str(tmp_path / "out"))
    back = spark.read.parquet(str(tmp_path / "out"))
    assert back.count() == sample.count()
    plan = {r["doc_id"]: (r["shard"], r["slot"]) for r in shard_plan(sample).collect()}
    assert {r["doc_id"]: (r["shard"], r["slot"]) for r in back.collect()} == plan


@pytest.mark.parametrize("part", [1, 2, 3, 100])
def test_equal_rows_are_numbered_in_parts(spark, part):
    rows = [(1, "a")] * 7 + [(None, None)] * 6 + [(2, "b")] * 2 + [(3, None)]
    got = numbered_copies(spark.createDataFrame(rows, "doc_id long, source string").repartition(3), part).collect()
    want = [(*r, k) for r, n in {(1, "a"): 7, (None, None): 6, (2, "b"): 2, (3, None): 1}.items() for k in range(1, n + 1)]
    assert sorted(map(str, map(tuple, got))) == sorted(map(str, want))


def test_plans_hold_no_python(sample):
    for df in (mix(sample, {"src0": 1}), mixed_rows(sample, {"src0": 1}), shard_plan(sample), sharded_rows(sample)):
        plan = df._jdf.queryExecution().executedPlan().toString()
        assert not any(x in plan for x in ("Python", "Pandas", "InArrow", "ExistingRDD"))


def test_every_source_keeps_within_a_block(spark):
    """Named or not: at each slot, no source that has rows left is a whole block off its share."""
    sizes = {"a": 60, "b": 40, **{f"other{i}": 30 + i for i in range(7)}, None: 35}
    docs = spark.createDataFrame([(f"{s}{i}", i, s) for s, n in sizes.items() for i in range(n)], "text string, doc_id long, source string")
    rows = mix(docs, {"a": 4, "b": 3, "not there": 50}, rest=5, block_rows=1).collect()
    assert len(rows) == sum(sizes.values()) == len({(r["slot"], r["slot_row"]) for r in rows})
    share = {s: {"a": 4 / 12, "b": 3 / 12}.get(s, 5 / 8 / 12) for s in sizes}
    for source, n in sizes.items():
        at = sorted(r["slot"] for r in rows if r["source"] == source)
        assert len(at) == n
        for k, slot in enumerate(at):  # before the block's slot k blocks are done, after it k + 1
            assert abs(k - share[source] * slot) < 1 and abs(k + 1 - share[source] * (slot + 1)) < 1
    assert min(r["slot"] for r in rows if r["source"] == "b") < 12


def test_the_mixture_survives_into_the_shards(spark):
    """A hot source holds most rows; still each shard begins with the shares of the mixture, whatever the ids."""
    sizes = {"hot": 9000, "src0": 1600, "src1": 800}
    rows = [(i if s != "hot" or i % 3 else None, f"{s} {i}", s) for s, n in sizes.items() for i in range(n)]
    docs = spark.createDataFrame(rows, "doc_id long, text string, source string")
    mixed = corpus_pipeline.source_mixing(spark, docs, "")
    got = corpus_pipeline.sharding(spark, mixed, "").collect()
    assert sorted(r["text"] for r in got) == sorted(t for _, t, _ in rows)
    assert len({(r["shard"], r["slot"]) for r in got}) == len(got)
    by_shard = defaultdict(list)
    for r in sorted(got, key=lambda r: r["slot"]):
        by_shard[r["shard"]].append(r["source"])
    assert len(by_shard) == 8
    # Slots 30 src0 : 15 src1 : 40 all others; the first 4000 places of the mixture hold all three.
    first = [s for found in by_shard.values() for s in found[: len(found) * 4 // 11]]
    assert abs(first.count("src0") / len(first) - 30 / 85) < 0.06 and abs(first.count("src1") / len(first) - 15 / 85) < 0.05
    for found in by_shard.values():
        if len(found) < 2000:  # the shard of the rows without an id has hot rows only beside its own
            part = found[:200]
            assert part.count("src0") > 0.25 * len(part) and part.count("src1") > 0.1 * len(part)
