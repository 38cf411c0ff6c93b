"""Bindings at larger scales than the test tables."""

from __future__ import annotations

from pyspark.sql import functions as F

from retailmart.sources.bindings import _padded


def test_long_keys_stay_whole(spark):
    ids = spark.range(10_000_000, 10_001_500).select(_padded(F.col("id").cast("string"), 7).alias("k"))
    assert ids.distinct().count() == 1500
    assert spark.range(5, 6).select(_padded(F.col("id").cast("string"), 7).alias("k")).first()["k"] == "0000005"
