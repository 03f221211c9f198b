"""Every registered query against its SQL on the smallest tables."""

import pytest
from oracle import same

from tideline.plans import registry

SF = "/root/testdata/sf0.001"
QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_query_equals_sql(spark, name):
    same(spark, SF, QUERIES[name], SQL[name])


def test_entry_runs(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert set(entry.oracle_sql()) <= set(entry.queries())
