from __future__ import annotations

import datetime as dt
import random
from decimal import Decimal

import pytest

from retailmart.operators import running
from retailmart.operators.running import pareto, running_total


def brute(data, descending):
    """(key, running, before) with ties together; NULLs first ascending, last descending."""

    def place(v):
        if v is None:
            return (1, 0) if descending else (-1, 0)
        return (0, -v if descending else v)

    out = []
    for key, order, _ in data:
        upto = sum((m or 0) for _, o, m in data if place(o) <= place(order))
        before = sum((m or 0) for _, o, m in data if place(o) < place(order))
        out.append((key, upto, before))
    return sorted(out)


def decimals(seed):
    rng = random.Random(seed)
    spread = [0, 1, 99, 2**21, 2**22 + 5, 2**42, 2**43 + 11, 10**15]
    data = []
    for key in range(300):
        cents = rng.choice(spread) + rng.randrange(-50, 50)
        order = None if rng.random() < 0.05 else Decimal(cents * rng.choice([1, -1])) / 100
        data.append((key, order, Decimal(rng.randrange(-500, 1000)) / 100))
    return data


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("seed", [1, 2])
def test_against_brute_force(spark, seed, descending):
    data = decimals(seed)
    df = spark.createDataFrame(data, "k int, o decimal(18,2), m decimal(18,2)")
    got = running_total(df, "o", "m", "r", descending=descending, before="b")
    assert sorted((r.k, r.r, r.b) for r in got.collect()) == brute(data, descending)


def test_plain_window_and_levels_agree(spark, rows):
    data = [(dt.date(2020 + i // 12, i % 12 + 1, 1), Decimal(i * 37 % 11)) for i in range(40)]
    df = spark.createDataFrame(data, "month date, m decimal(18,2)")
    plain = running_total(df, "month", "m", "r", calendar_order=True, before="b")
    levels = running_total(df, "month", "m", "r", before="b")
    assert rows(plain, "month", "r", "b") == rows(levels, "month", "r", "b")


def any_order(kind, seed):
    rng = random.Random(seed)
    pools = {
        "timestamp_ntz": [dt.datetime(2023, 1, 1, i % 24, i % 60, 0, i) for i in range(60)],
        "timestamp": [dt.datetime(1901, 1, 1) + dt.timedelta(days=400 * i, microseconds=i) for i in range(60)],
        "string": ["", " ", "a", "A", "a ", "Zürich", "zebra", "漢字", *(f"name {i}" for i in range(40))],
        "double": [0.0, -0.0, 1.5, -1.5, 1e300, -1e300, float("inf"), float("-inf"), *(i / 7 for i in range(40))],
        "boolean": [True, False],
    }
    return [
        (k, None if rng.random() < 0.05 else rng.choice(pools[kind]), Decimal(rng.randrange(-500, 1000)) / 100)
        for k in range(400)
    ]


@pytest.mark.parametrize("descending", [False, True])
@pytest.mark.parametrize("kind", ["timestamp_ntz", "timestamp", "string", "double", "boolean"])
def test_any_order_against_brute_force(spark, monkeypatch, kind, descending):
    monkeypatch.setattr(running, "RANGE_VALUES", 5)
    data = any_order(kind, 3)
    df = spark.createDataFrame(data, f"k int, o {kind}, m decimal(18,2)")
    got = running_total(df, "o", "m", "r", descending=descending, before="b")
    assert got.columns == ["k", "o", "m", "r", "b"]
    values = sorted({o for _, o, _ in data if o is not None})
    numbered = [(k, None if o is None else values.index(o), m) for k, o, m in data]
    assert sorted((r.k, r.r, r.b) for r in got.collect()) == brute(numbered, descending)


def test_not_a_number_sorts_last(spark):
    df = spark.createDataFrame([(1, 2.0, 1), (2, float("nan"), 2), (3, None, 4), (4, float("nan"), 8)], "k int, o double, m int")
    assert {r.k: r.r for r in running_total(df, "o", "m", "r").collect()} == {3: 4, 1: 5, 2: 15, 4: 15}


def test_any_order_of_nothing(spark):
    df = spark.createDataFrame([], "k int, o string, m decimal(18,2)")
    assert running_total(df, "o", "m", "r").collect() == []
    nulls = spark.createDataFrame([(1, None, None), (2, "a", None)], "k int, o string, m decimal(18,2)")
    assert [r.r for r in running_total(nulls, "o", "m", "r").collect()] == [0, 0]


def test_ranges_bound_the_windows(spark, monkeypatch):
    """A third of the rows tied; no range holds much more than its share of the different values."""
    seen = []
    real = running.stored
    monkeypatch.setattr(running, "RANGE_VALUES", 500)
    monkeypatch.setattr(running, "stored", lambda df, name: seen.append(real(df, name)) or seen[-1])
    df = spark.range(0, 60_000, 1, 8).selectExpr("if(id % 3 = 0, 'tie', concat('v', id)) as o", "1 as m")
    got = running_total(df, "o", "m", "r")
    assert got.agg({"r": "max"}).first()[0] == 60_000
    sizes = [r["count"] for r in seen[-1].groupBy("_range").count().collect()]
    assert len(sizes) > 60 and max(sizes) < 2500
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastExchange" in plan


def test_any_order_half_of_the_rows_tied(spark, largest_task):
    tied = spark.range(0, 40_000, 1, 8).selectExpr("if(id % 2 = 0, 'x', concat('v', id)) as o", "1 as m")
    total, largest = largest_task(lambda: running_total(tied, "o", "m", "r"))
    assert total == 40_000
    assert largest < 10_000


def items(spark):
    data = [("a", 50), ("b", 20), ("c", 10), ("d", 10), ("e", 6), ("f", 4), ("f", 0), (None, 0)]
    return spark.createDataFrame(
        [(k, Decimal(v)) for k, v in data], "item string, revenue decimal(18,2)"
    )


def test_pareto_ties_share_a_value(spark):
    got = pareto(items(spark), "item", "revenue").collect()
    cumulative = {r["item"]: float(r["cumulative_pct"]) for r in got}
    assert cumulative == {"a": 50, "b": 70, "c": 90, "d": 90, "e": 96, "f": 100, None: 100}


@pytest.mark.parametrize(
    ("threshold", "kept"), [(50, {"a"}), (70, {"a", "b"}), (80, {"a", "b", "c", "d"})]
)
def test_pareto_threshold_keeps_whole_ties(spark, threshold, kept):
    got = pareto(items(spark), "item", "revenue", threshold=threshold).collect()
    assert {r["item"] for r in got} == kept


def test_few_keys_give_the_same(spark, rows):
    rng = random.Random(8)
    data = [(i % 40, Decimal(rng.randrange(-2, 4))) for i in range(80)]
    df = spark.createDataFrame(data, "item int, revenue decimal(18,2)")
    assert rows(pareto(df, "item", "revenue", few_keys=True)) == rows(pareto(df, "item", "revenue"))


def test_cumulative_share_never_falls(spark):
    rng = random.Random(5)
    data = [(i % 60, Decimal(rng.randrange(1, 10**6)) / 100) for i in range(900)]
    df = spark.createDataFrame(data, "item int, revenue decimal(18,2)")
    got = sorted(pareto(df, "item", "revenue").collect(), key=lambda r: -r["total"])
    shares = [r["cumulative_pct"] for r in got]
    assert shares == sorted(shares)
    assert shares[-1] == 100


def test_half_of_the_rows_tied(spark, largest_task):
    tied = spark.range(0, 40_000, 1, 8).selectExpr("if(id % 2 = 0, 7L, id) as o", "1 as m")
    total, largest = largest_task(lambda: running_total(tied, "o", "m", "r"))
    assert total == 40_000
    assert largest < 10_000


def test_pareto_with_equal_totals(spark, largest_task):
    keys = spark.range(0, 40_000, 1, 8).selectExpr("id as k", "if(id % 2 = 0, 0L, id) as m")
    total, largest = largest_task(lambda: pareto(keys, "k", "m"))
    assert total == 40_000
    assert largest < 10_000
