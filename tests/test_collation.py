"""Text that compares as on the database server."""

from __future__ import annotations

from decimal import Decimal

from pyspark.sql import functions as F
from pyspark.sql import types as T

from retailmart.operators import cleaning as cl
from retailmart.operators import quality as dq
from retailmart.operators.funnels import funnel
from retailmart.operators.joins import hot_key_join, join_dimension
from retailmart.sources.schemas import SERVER_COLLATION, collated_schema, plain_text, server_collated

SPELLED = [(1, "Email"), (2, "EMAIL  "), (3, "unknown "), (4, None), (5, " Email"), (6, "email")]


def spelled(spark):
    return server_collated(spark.createDataFrame(SPELLED, "k int, c string"))


def test_schema_option(spark):
    schema = collated_schema("a string, b int, c string", ["c"])
    assert schema["a"].dataType == T.StringType()
    assert schema["c"].dataType == T.StringType(SERVER_COLLATION)
    assert collated_schema(schema)["a"].dataType == T.StringType(SERVER_COLLATION)


def test_comparison_and_groups(spark, rows):
    df = spelled(spark)
    assert rows(df.filter(F.col("c") != "Unknown"), "k") == [(1,), (2,), (5,), (6,)]
    assert rows(plain_text(dq.category_frequency(df, "c"))) == [(" email", 1), ("email", 3), ("unknown", 1), (None, 1)]
    assert dq.distinct_count(df, ["c"]).first()[0] == 3
    assert [r.c for r in df.orderBy("k").collect()] == [c for _, c in SPELLED]


def test_placeholders_and_lookups(spark, rows):
    df = spelled(spark)
    labelled = cl.sentinels_to_label(df, ["c"], ["UNKNOWN"])
    assert rows(labelled.filter(F.col("c") == "na"), "k") == [(3,), (4,)]
    priced = df.withColumn("p", F.lit(None).cast("decimal(5,2)"))
    filled = cl.fill_from_lookup(priced, "p", "c", {"eMail": Decimal(2)}, F.col("p").isNull())
    assert rows(filled.filter("p is not null"), "k") == [(1,), (2,), (6,)]


def test_joins(spark, rows):
    dim = server_collated(spark.createDataFrame([("EMAIL", 7)], "c string, v int"))
    assert rows(join_dimension(spelled(spark), dim, "c", "inner"), "k", "v") == [(1, 7), (2, 7), (6, 7)]
    hot = server_collated(spark.createDataFrame([("email ",)], "c string"))
    joined = hot_key_join(spelled(spark), dim, "c", "left", hot=hot)
    assert rows(joined, "k", "v") == [(1, 7), (2, 7), (3, None), (4, None), (5, None), (6, 7)]


def test_funnel_steps(spark):
    events = server_collated(spark.createDataFrame([("View",), ("view ",), ("CART",)], "e string"))
    assert tuple(funnel(events, "e", [("view", "views"), ("cart", "carts")], ["rate"]).first()) == (2, 1, Decimal("50.00"))


def test_no_rows(spark):
    none = spark.createDataFrame([], "k int, c string")
    assert plain_text(server_collated(none)).collect() == []
