"""Each query with SQL gives what the SQL gives; the others run."""

import pytest

from quire.plans import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLES))
def test_query(name, same_as_sql):
    same_as_sql(registry.QUERIES[name], registry.ORACLES[name])


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLES)))
def test_runs(name, spark, same_as_sql):
    assert registry.QUERIES[name](spark, "/root/testdata/sf0.001").count() > 0
