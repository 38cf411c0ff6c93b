from __future__ import annotations

import random

import pytest

from retailmart.operators.ranking import top_ranked, top_rows


def frame(spark, seed):
    rng = random.Random(seed)
    data = [
        (i, rng.choice("xyz") if rng.random() < 0.9 else None, rng.choice([None, *range(12)]))
        for i in range(200)
    ]
    return data, spark.createDataFrame(data, "id int, g string, v int")


def brute(data, n, grouped, dense):
    out = []
    for i, g, v in data:
        peers = [w for _, h, w in data if not grouped or h == g]
        ahead = [w for w in peers if w is not None and (v is None or w > v)]
        rank = len(set(ahead) if dense else ahead) + 1
        if rank <= n:
            out.append((i, rank))
    return sorted(out)


@pytest.mark.parametrize("dense", [False, True])
@pytest.mark.parametrize("grouped", [False, True])
@pytest.mark.parametrize("n", [1, 3, 30])
def test_all_ties_up_to_rank_n(spark, n, grouped, dense):
    data, df = frame(spark, n)
    got = top_ranked(df, "v", n, ["g"] if grouped else [], dense=dense)
    assert sorted((r["id"], r["rank"]) for r in got.collect()) == brute(data, n, grouped, dense)


@pytest.mark.parametrize("dense", [False, True])
@pytest.mark.parametrize("grouped", [False, True])
def test_few_rows_give_the_same_from_one_run(spark, grouped, dense):
    _, df = frame(spark, 5)
    by = ["g"] if grouped else []
    plain, few = (top_ranked(df, "v", 3, by, dense=dense, few_rows=x) for x in (False, True))
    assert few._jdf.queryExecution().executedPlan().toString().count("Scan") == 1
    assert sorted(map(str, plain.collect())) == sorted(map(str, few.collect()))


def test_nulls_rank_last(spark):
    df = spark.createDataFrame([(1, 5), (2, None), (3, None)], "id int, v int")
    got = {r["id"]: r["rank"] for r in top_ranked(df, "v", 2).collect()}
    assert got == {1: 1, 2: 2, 3: 2}
    assert {r["id"] for r in top_ranked(df, "v", 1).collect()} == {1}
    nothing = spark.createDataFrame([(1, None)], "id int, v int")
    assert [r["rank"] for r in top_ranked(nothing, "v", 1).collect()] == [1]


def test_ties_are_not_gathered(spark):
    df = spark.range(1000).selectExpr("id", "id div 400 as v")
    got = top_ranked(df, "v", 10)
    assert got.count() == 200
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "Window" not in plan


def test_top_rows_cut_ties_by_key(spark):
    df = spark.createDataFrame([("b", 5), ("a", 5), ("c", 9), ("d", 1)], "k string, v int")
    got = top_rows(df, "v", 2, ["k"], rank="rank").collect()
    assert [(r["k"], r["rank"]) for r in got] == [("c", 1), ("a", 2)]
    dense = top_rows(df, "v", 4, ["k"], rank="rank", dense=True).collect()
    assert [(r["k"], r["rank"]) for r in dense] == [("c", 1), ("a", 2), ("b", 2), ("d", 3)]
    low = top_rows(df, "v", 2, ["k"], descending=False).collect()
    assert [r["k"] for r in low] == ["d", "a"]


@pytest.mark.parametrize("dense", [False, True])
def test_grouped_ties_are_not_gathered(spark, largest_task, dense):
    tied = spark.range(0, 40_000, 1, 8).selectExpr("id", "0 as g", "if(id % 2 = 0, 9999999L, id) as v")
    total, largest = largest_task(lambda: top_ranked(tied, "v", 1, ["g"], dense=dense))
    assert total == 20_000
    assert largest < 5_000
