import pytest
from check_oracles import compare, connect

import __spark_entry__ as entry
from workload import oracles, queries


@pytest.fixture(scope="module")
def db(sf_dir):
    return connect(sf_dir)


def test_every_query_has_sql():
    assert set(queries.queries()) == set(oracles.oracle_sql())
    assert set(queries.queries()) <= set(entry.queries())


def test_entry(spark):
    index = entry.entry(spark)
    assert {r.status for r in index.select("status").distinct().collect()} == {"cached", "failed", "processed"}


@pytest.mark.parametrize("name", sorted(queries.queries()))
def test_query_equals_sql(spark, db, sf_dir, name):
    assert compare(spark, db, sf_dir, name) is None
