"""The text operators against their SQL, over whole tables."""

from __future__ import annotations

import pytest

from retailmart.llm import queries
from tests.compare import duck

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.oracle_sql()))
def test_equals_sql(spark, name):
    found = queries.queries()[name](spark, SF)
    wanted = duck(SF).sql(queries.oracle_sql()[name])
    columns = sorted(found.columns)
    assert columns == sorted(wanted.columns)
    rows = sorted(tuple(r) for r in found.select(columns).collect())
    assert rows == sorted(wanted.select(*columns).fetchall())
    assert len(rows) > 0
