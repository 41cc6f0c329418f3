"""Every registered query of the document engine against DuckDB."""

import pytest
from conftest import rows_of

from meetloom.plans import registry

QUERIES, SQL = registry.queries(), registry.oracle_sql()


@pytest.mark.parametrize("name", sorted(SQL))
def test_equals_sql(spark, sf, duck, name):
    mine, theirs = rows_of(QUERIES[name](spark, sf).toPandas()), rows_of(duck.execute(SQL[name]).df())
    assert mine == theirs


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(SQL)))
def test_has_rows(spark, sf, name):
    assert QUERIES[name](spark, sf).count() > 0


def test_entry(spark):
    import __spark_entry__ as entry

    assert entry.entry(spark).count() >= 0
    assert set(registry.queries()) <= set(entry.queries())
