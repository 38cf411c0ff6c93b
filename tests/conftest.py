from __future__ import annotations

import sys
from pathlib import Path

import pytest
from pyspark.sql import functions as F

sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from retailmart.session import local_session  # noqa: E402


@pytest.fixture(scope="session")
def spark():
    session = local_session("8")
    yield session
    session.stop()


@pytest.fixture
def rows(spark):
    """Sorted tuples of a frame, NULLs last."""

    def collect(df, *columns):
        df = df.select(*columns) if columns else df
        found = [tuple(r) for r in df.collect()]
        return sorted(found, key=lambda r: [(v is None, str(v)) for v in r])

    return collect


@pytest.fixture
def largest_task(spark):
    """Rows of the largest task that puts out a frame, without adaptive execution or broadcasts by size."""

    def measure(build):
        names = ("spark.sql.adaptive.enabled", "spark.sql.autoBroadcastJoinThreshold")
        saved = {k: spark.conf.get(k) for k in names}
        spark.conf.set(names[0], "false")
        spark.conf.set(names[1], "-1")
        try:
            counts = build().groupBy(F.spark_partition_id()).count().collect()
        finally:
            for k, v in saved.items():
                spark.conf.set(k, v)
        return sum(r["count"] for r in counts), max(r["count"] for r in counts)

    return measure
