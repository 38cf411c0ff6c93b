from __future__ import annotations

import pytest

#: Columns whose names clash with those that the operators use inside.
CLASHING = "key string, fp long, shard int, slot int, spans string, n int, th int, _id long, _slot long, label int"
SCHEMA = f"doc_id long, text string, source string, {CLASHING}"


def messy_rows() -> list[tuple]:
    """Nulls, empty and very long texts, copies, repeated rows."""
    prose = " ".join(f"word{i % 97} thing{i % 89}, other{i % 83}." for i in range(40))
    long_text = " ".join(f"w{i * 7919 % 10007}" for i in range(30_000))
    again = "the same few words come round again " * 60
    texts = [
        (1, prose),
        (2, prose),
        (3, prose.replace("word5 ", "changed ")),
        (4, None),
        (5, ""),
        (6, " \n\t "),
        (7, "one two"),
        (8, long_text),
        (9, "prefix " + long_text[:2000] + " suffix"),
        (10, again),
        (11, "Größe — naïve ☃ " * 40),
        (12, "x" * 5000),
        (None, prose),
        (None, None),
        (13, "repeated row " * 30),
        (13, "repeated row " * 30),
    ]
    sources = ["a", "a", "b", None]
    return [(i, t, sources[k % 4], "k", 1, 2, 3, "s", 4, 5, 6, 7, 0) for k, (i, t) in enumerate(texts)]


@pytest.fixture(scope="session")
def messy(spark):
    return spark.createDataFrame(messy_rows(), SCHEMA).repartition(3)


@pytest.fixture(scope="session")
def no_docs(spark):
    return spark.createDataFrame([], SCHEMA)


@pytest.fixture(scope="session")
def sample(spark):
    return spark.read.parquet("/root/testdata/sf0.001/documents.parquet")


@pytest.fixture(scope="session")
def labels(spark):
    return spark.read.parquet("/root/testdata/sf0.01/labels.parquet")
