"""Every named query of the library against its SQL, over whole tables of the smallest scale."""

import os
import sys

import pytest

sys.path.insert(0, os.path.dirname(__file__))
import oracle  # noqa: E402

from lectern.plans.catalogue import ORACLE_SQL, QUERIES  # noqa: E402


@pytest.fixture(scope="module")
def con(sf_dir):
    return oracle.connect(sf_dir)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, sf_dir, con, name):
    got = QUERIES[name](spark, sf_dir).toPandas()
    if name in ORACLE_SQL:
        oracle.assert_same(got, con.sql(ORACLE_SQL[name]).df())
    else:
        assert len(got)


def test_sql_belongs_to_queries():
    assert set(ORACLE_SQL) <= set(QUERIES)


def test_entry_points(spark):
    import __spark_entry__ as e

    assert e.entry(spark).limit(1).count() == 1
    assert set(QUERIES) <= set(e.queries()) and set(e.oracle_sql()) <= set(e.queries())
