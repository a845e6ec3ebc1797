"""Every registered query against its SQL oracle, on the small tables."""

import pytest

import __spark_entry__ as entry

from compare import oracle_connection, run_oracle, run_spark

ORACLE = entry.oracle_sql()


@pytest.fixture(scope="module")
def con(sf):
    return oracle_connection(sf)


def test_every_query_has_an_oracle():
    """But for those of the optional parts, which have tests of their own."""
    assert set(ORACLE) <= set(entry.queries())
    assert {q.__name__ for q in entry.QUERIES} <= set(ORACLE)


@pytest.mark.parametrize("name", ORACLE)
def test_query(spark, sf, con, name):
    assert run_spark(spark, entry.queries()[name], sf) == run_oracle(con, ORACLE[name])


def test_entry(spark):
    assert entry.entry(spark).columns == ["shard", "name", "tokens_md5"]
