import pytest

import __spark_entry__ as entry
from cohortflow.plans import registry


@pytest.mark.parametrize("name", sorted(registry.QUERIES))
def test_same_as_sql(spark, sf_dir, duck, check_same, name):
    check_same(registry.QUERIES[name](spark, sf_dir), duck.execute(registry.SQL[name]).df())


def test_every_query_has_sql():
    assert set(registry.QUERIES) == set(registry.SQL)


def test_entry_is_the_flagship(spark):
    assert "path" in entry.entry(spark).columns


def test_registered(spark):
    assert set(registry.QUERIES) <= set(entry.queries())
    assert set(entry.oracle_sql()) <= set(entry.queries())
