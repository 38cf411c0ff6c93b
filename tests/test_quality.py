from __future__ import annotations

from decimal import Decimal

import pytest
from pyspark.sql import functions as F

from retailmart.functions import parse_dmy_date
from retailmart.operators import quality as dq


@pytest.fixture(scope="module")
def df(spark):
    return spark.createDataFrame(
        [
            (1, "a", Decimal("1.50"), "TXN_1"),
            (1, "b", None, "TXN_1234567"),
            (2, "a", Decimal("2.50"), "TXN_12345678"),
            (None, None, None, "ABC_1"),
            (None, "ERROR", None, None),
            (3, "UNKNOWN", Decimal("-1.00"), "TXN_1    "),
        ],
        "k int, c string, m decimal(18,2), t string",
    )


def test_row_count(df):
    assert dq.row_count(df).first()[0] == 6


def test_range_profile(spark, df):
    got = dq.range_profile(
        df,
        {"lo": ("min", "m"), "hi": ("max", "m"), "mean": ("avg", "m"), "kmean": ("avg", "k")},
        scale={"hi": 2},
        digits={"mean": 1},
    ).first()
    # Mean 1.0; integer mean of 1, 1, 2, 3 is 1.75, truncated.
    assert tuple(got) == (Decimal("-1.00"), 1.25, Decimal("1.0"), 1)
    negative = spark.createDataFrame([(-1,), (-2,)], "x int")
    assert dq.range_profile(negative, {"m": ("avg", "x")}).first()[0] == -1


def test_duplicate_keys_tell_null_keys_apart(df, rows):
    assert rows(dq.duplicate_keys(df, ["k"])) == [(1, 2, False), (None, 2, True)]
    assert rows(dq.duplicate_keys(df, ["k", "c"])) == []


def test_duplicate_rows_return_every_row(df, rows):
    assert rows(dq.duplicate_rows(df, ["k"], ["k", "c"])) == [
        (1, "a", 2),
        (1, "b", 2),
        (None, "ERROR", 2),
        (None, None, 2),
    ]


def test_duplicate_rows_with_a_hot_key(spark):
    df = spark.range(3000).select(
        F.when(F.col("id") % 3 == 0, -1).otherwise(F.col("id")).alias("k"), "id"
    )
    got = dq.duplicate_rows(df, ["k"], ["k", "id"])
    assert got.count() == 1000
    assert got.select("duplicate_count").distinct().collect()[0][0] == 1000


def test_completeness(df):
    assert tuple(dq.completeness(df, ["k", "m"]).first()) == (6, 4, 3)
    assert tuple(dq.completeness(df, ["k", "m"], "missing").first()) == (6, 2, 3)
    with pytest.raises(ValueError):
        dq.completeness(df, ["k"], "both")


def test_sentinel_count(df):
    assert dq.sentinel_count(df, "c", ["ERROR", "UNKNOWN"]).first()[0] == 3
    assert dq.sentinel_count(df, "c", ["error "], case_insensitive=True).first()[0] == 2


def test_conformance(spark, df):
    # Nine digits are too long, ABC is no prefix; blanks behind and NULL are fine.
    assert dq.conformance(df, dq.breaks_prefix_or_length("t", "TXN", 11)).first()[0] == 2
    dates = spark.createDataFrame([("31/12/2023",), ("2023-12-31",), ("",), (None,)], "d string")
    broken = dq.breaks_parse("d", parse_dmy_date(F.col("d")))
    assert dq.conformance(dates, broken).first()[0] == 2


def test_category_frequency_order(df):
    got = dq.category_frequency(df, "c").collect()
    assert [(r[0], r[1]) for r in got] == [
        ("a", 2),
        (None, 1),
        ("ERROR", 1),
        ("UNKNOWN", 1),
        ("b", 1),
    ]
    some = dq.category_frequency(df, "c", where=F.col("k") == 1, descending=False).collect()
    assert [(r[0], r[1]) for r in some] == [("a", 1), ("b", 1)]


def test_distinct(df, rows):
    assert len(rows(dq.distinct_values(df, ["k"]))) == 4
    assert tuple(dq.distinct_count(df, ["k", "m"]).first()) == (3, 3)
    assert dq.distinct_count(df, ["k"], exact=False).first()[0] == 3


def test_orphans_are_never_null(spark, df, rows):
    dim = spark.createDataFrame([(1,), (3,)], "id int")
    assert rows(dq.orphan_keys(df, dim, "k", "id")) == [(2, 1)]


def test_co_missing(df, rows):
    assert rows(dq.co_missing(df, ["k", "m"])) == [(0, 0, 3), (0, 1, 1), (1, 1, 2)]


def test_row_with_global_stats(df, rows):
    got = dq.row_with_global_stats(df.select("k"), "k", "avg", "lo", "hi")
    assert set(rows(got, "avg", "lo", "hi")) == {(1, 1, 3)}
    assert got.count() == 6


def test_group_count_extremes(df, rows):
    assert rows(dq.group_count_extremes(df, "k")) == [(1, 2, 2, 1), (2, 1, 2, 1), (3, 1, 2, 1)]


def profiled(spark):
    data = [(1, "a", 2.5), (2, "b", None), (3, "a", 2.5), (4, None, 1.0), (5, "b", None)]
    return spark.createDataFrame(data, "k int, t string, v double")


def test_frequencies_of_all_columns_equal_those_of_each(spark, rows):
    df = profiled(spark)
    got = dq.profile_frequencies(df, ["k", "t", "v"])
    for column in df.columns:
        one = dq.category_frequency(df, column).select(F.col(column).cast("string"), "n_rows")
        assert rows(got.filter(F.col("column_name") == column), "value", "n_rows") == rows(one)
    some = dq.profile_frequencies(df, {"x": ("t", F.col("v") > 1), "y": ("t", None)})
    assert rows(some) == [("x", "a", 2), ("y", "a", 2), ("y", "b", 2), ("y", None, 1)]


def test_a_profile_is_one_scan(spark, rows, tmp_path):
    profiled(spark).write.parquet(str(tmp_path / "t"))
    df = spark.read.parquet(str(tmp_path / "t"))
    got = dq.profile(df, df.columns)
    plan = got._jdf.queryExecution().executedPlan().toString()
    assert plan.count("FileScan") == 1
    assert rows(got) == [
        ("k", 5, 0, 5, "1", 1),
        ("t", 5, 1, 2, "a", 2),
        ("v", 5, 2, 2, "2.5", 2),
    ]
    assert dq.profile(df.limit(0), ["k"]).collect() == []
    nothing = dq.profile(df.select(F.lit(None).cast("string").alias("n")), ["n"])
    assert rows(nothing) == [("n", 5, 5, 0, None, None)]


def test_a_hot_value_is_folded_where_it_is(spark, largest_task):
    df = spark.range(0, 40_000, 1, 8).selectExpr("if(id % 3 = 0, id, 7) as k", "'x' as t")
    counted = dq.profile_frequencies(df, ["k", "t"])
    assert counted.filter("value = 'x'").first()["n_rows"] == 40_000
    assert "partial_count" in counted._jdf.queryExecution().executedPlan().toString()


def test_united_sketches_come_near_the_whole(spark, tmp_path):
    df = spark.range(0, 60_000, 1, 8).selectExpr("id % 12 as month", "id % 20000 as k", "if(id % 5 = 0, null, concat('t', id)) as t")
    sketches = dq.distinct_sketches(df, ["month"], ["k", "t"])
    sketches.write.parquet(str(tmp_path / "s"))
    stored = spark.read.parquet(str(tmp_path / "s"))
    assert stored.count() == 12
    got = dq.united_distinct_count(stored, ["k", "t"]).first()
    bound = 5 * dq.sketch_error()
    assert abs(got["k"] - 20_000) <= bound * 20_000 and abs(got["t"] - 48_000) <= bound * 48_000
    half = dq.united_distinct_count(stored.filter("month < 3"), ["k"], ["month"]).count()
    assert half == 3
