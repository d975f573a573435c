import pytest
from oracle import compare

from talweg.plans import registry


@pytest.mark.parametrize("name", sorted(registry.ORACLE_SQL))
def test_query_equals_sql(spark, sf, name):
    compare(registry.QUERIES[name], registry.ORACLE_SQL[name], spark, sf)


@pytest.mark.parametrize("name", sorted(set(registry.QUERIES) - set(registry.ORACLE_SQL)))
def test_query_without_sql_has_rows(spark, sf, name):
    assert registry.QUERIES[name](spark, sf).count() > 0


def test_entry_and_registry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() > 0
    assert entry.oracle_sql().keys() <= entry.queries().keys()
    assert set(registry.QUERIES) <= set(entry.queries())
