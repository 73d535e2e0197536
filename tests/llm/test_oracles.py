"""The queries that SQL can express give the same rows as DuckDB does."""

from __future__ import annotations

import pytest

from studygraph.llm.queries import ORACLES, QUERIES
from tests.test_queries import same


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_as_sql(spark, name):
    assert same(spark, QUERIES[name], ORACLES[name]) > 0
