"""Every registered query equals its SQL counterpart."""

import parity
import pytest
from conftest import SMALL

import __spark_entry__ as entry_points
from catalog import oracles
from catalog.queries import QUERIES

SQL = oracles.statements()

# xxhash64 exists in Spark only; its md5 twin is compared instead.
WITHOUT_SQL = {"fingerprint_fast"}


@pytest.fixture(scope="module")
def con():
    return parity.connect(SMALL)


def test_every_query_has_sql():
    assert set(QUERIES) - set(SQL) == WITHOUT_SQL
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(SQL))
def test_equal_rows(spark, con, name):
    assert parity.difference(QUERIES[name](spark, SMALL), con, SQL[name]) is None


def test_fast_fingerprint_has_the_same_partitions(spark):
    fast = QUERIES["fingerprint_fast"](spark, SMALL)
    slow = QUERIES["fingerprint"](spark, SMALL)
    keys = ["ingest_date", "region", "rows"]
    assert fast.select(keys).exceptAll(slow.select(keys)).count() == 0
    assert fast.count() == slow.count()


def test_entry(spark):
    result = entry_points.entry(spark)
    assert result.columns == [
        "content_id", "title", "watch_hours", "view_count", "avg_completion",
    ]
    assert result.count() == 20


def test_all_queries_are_registered():
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(SQL) <= set(entry_points.oracle_sql())
