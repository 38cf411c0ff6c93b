"""Every registered query against DuckDB, and what its plan may contain."""

from __future__ import annotations

import datetime as dt
import re

import pytest

import __spark_entry__ as entry
from retailmart import catalog, oracle
from tests.compare import duck, mismatch

SF = "/root/testdata/sf0.001"
QUERIES, ORACLE = catalog.queries(), oracle.oracle_sql()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


def test_every_query_has_its_sql():
    assert set(QUERIES) == set(ORACLE)


def test_refunds_change_the_sql():
    for name in ORACLE:
        if name.endswith("_no_refunds") and not name.startswith("gv_"):
            assert ORACLE[name] != ORACLE[name.removesuffix("_no_refunds")]


def test_entry(spark):
    assert entry.entry(spark).count() == 1


def gathered(plan: str) -> list[str]:
    """The operators whose rows are gathered into one partition."""
    lines = plan.splitlines()
    found = []
    for i, line in enumerate(lines):
        if "Exchange SinglePartition" in line:
            operators = (x.lstrip(" :+-|*()0123456789") for x in lines[i + 1 :])
            found.append(next(x for x in operators if not x.startswith(("Project", "Sort ", "Filter"))))
    return found


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_equals_sql(spark, con, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert not re.search("EvalPython|InPandas|CartesianProduct|BroadcastNestedLoopJoin", plan)
    # Nothing is gathered but the results of aggregates.
    assert all("Aggregate" in x.split("(")[0] for x in gathered(plan)), gathered(plan)
    assert mismatch(df, con, ORACLE[name]) is None


def test_repeated_loads_read_their_source_once(spark, rows, monkeypatch):
    """The fact behind the four loads is joined and cleaned by one run."""
    seen = spark.sparkContext.accumulator(0)

    def counted(batches):
        for b in batches:
            seen.add(b.num_rows)
            yield b

    days = [dt.datetime(y, m, 5) for y, m in ((1995, 12), (1996, 3), (1996, 4), (1997, 3), (1997, 3))] + [None]
    facts = [(10 * k + refund, day, 1, refund) for k, day in enumerate(days) for refund in (0, 1)]
    source = spark.createDataFrame(
        facts, "transaction_id bigint, transaction_timestamp timestamp, product_id bigint, refund_flag int"
    ).selectExpr("*", "cast(1 as decimal(18,2)) as gross_revenue", "cast(null as bigint) as campaign_id")
    monkeypatch.setattr(catalog.bindings, "transactions", lambda *_: source.mapInArrow(counted, source.schema))
    got = QUERIES["in_write_table_again"](spark, SF)
    loaded = [f[:2] for f in facts if f[1] and not (f[3] and f[1] == days[1])]
    assert rows(got, "transaction_id", "transaction_timestamp") == sorted(loaded, key=lambda f: str(f[0]))
    assert seen.value == len(facts)
