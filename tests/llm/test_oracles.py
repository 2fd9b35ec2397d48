"""Queries with SQL give what the SQL gives."""

import pytest

from quire.llm import queries


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query(name, same_as_sql):
    same_as_sql(queries.QUERIES[name], queries.ORACLES[name])
