from __future__ import annotations

import pytest
from pyspark.sql import functions as F

from retailmart.operators.joins import hot_key_join, join_dimension


@pytest.fixture(scope="module")
def fact(spark):
    """6000 rows: a third under key 1, a tenth without key, a hot orphan, a long tail."""
    i = F.col("id")
    key = (
        F.when(i % 3 == 0, 1)
        .when(i % 10 == 1, None)
        .when(i % 10 == 2, 9999)
        .otherwise(2 + i % 700)
        .cast("int")
    )
    return spark.range(6000).select(F.col("id").alias("row"), key.alias("k"))


@pytest.fixture(scope="module")
def dim(spark):
    return spark.range(1, 500).select(
        F.col("id").cast("int").alias("k"),
        F.concat(F.lit("name"), "id").alias("name"),
        F.when(F.col("id") % 2 == 0, F.col("id")).alias("even"),
    )


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
def test_both_ways_agree(fact, dim, rows, how):
    small = join_dimension(fact, dim, "k", how)
    large = hot_key_join(fact, dim, "k", how)
    assert small.columns == large.columns
    assert rows(small) == rows(large)


@pytest.mark.parametrize("how", ["left", "inner", "left_semi"])
def test_both_ways_agree_on_repeated_keys(fact, dim, rows, how):
    twice = dim.unionByName(dim.filter("k < 20"))
    assert rows(join_dimension(fact, twice, "k", how)) == rows(hot_key_join(fact, twice, "k", how))


def test_a_semi_join_never_multiplies(spark, dim):
    keys = spark.range(10).selectExpr("cast(1 as int) as k")
    twice = dim.unionByName(dim)
    assert join_dimension(keys, twice, "k", "left_semi").count() == 10
    assert hot_key_join(keys, twice, "k", "left_semi").count() == 10


def test_no_job_runs_while_a_join_is_built(spark, fact, dim):
    spark.sparkContext.setJobGroup("build", "")
    try:
        join_dimension(fact, dim, "k")
    finally:
        spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    assert not spark.sparkContext.statusTracker().getJobIdsForGroup("build")


def test_left_join_keeps_every_row_once(fact, dim):
    got = hot_key_join(fact, dim, "k")
    assert got.count() == 6000
    assert got.select("row").distinct().count() == 6000


def test_two_keys(fact, dim, rows):
    f = fact.withColumn("part", F.col("row") % 2)
    d = dim.withColumn("part", F.col("k").cast("bigint") % 2)
    assert rows(join_dimension(f, d, ["k", "part"])) == rows(hot_key_join(f, d, ["k", "part"]))


def test_null_safe(spark, rows):
    f = spark.createDataFrame([(None, 1), (None, 2), (1, 3), (2, 4)], "k int, v int")
    d = spark.createDataFrame([(None, "none"), (1, "one")], "k int, name string")
    got = hot_key_join(f, d, "k", "inner", null_safe=True)
    assert rows(got) == [(1, 3, "one"), (None, 1, "none"), (None, 2, "none")]


def test_a_hot_key_stays_out_of_the_shuffle(spark, dim):
    """A fact of keys alone, half of it under one key, has no task above twice the even share."""
    saved = {
        k: spark.conf.get(k)
        for k in ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")
    }
    fact = spark.range(0, 40_000, 1, 8).selectExpr(
        "cast(if(id % 2 = 0, 1, 2 + id % 400) as int) as k"
    )
    spark.conf.set("spark.sql.adaptive.enabled", "false")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")
    try:
        joined = hot_key_join(fact, dim, "k").groupBy(F.spark_partition_id()).count().collect()
        plain = fact.join(dim, "k", "left").groupBy(F.spark_partition_id()).count().collect()
    finally:
        for k, v in saved.items():
            spark.conf.set(k, v)
    assert sum(r["count"] for r in joined) == 40_000
    assert max(r["count"] for r in plain) > 20_000
    assert max(r["count"] for r in joined) < 10_000
