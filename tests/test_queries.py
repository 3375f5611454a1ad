"""Every registered query against its SQL, over the smallest tables."""

import os

import pytest

import check
from __spark_entry__ import entry, oracle_sql, queries
from sedimenta.plans import load_queries

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="the tables are not here")


@pytest.fixture(scope="module")
def con():
    return check.connect(SF)


@pytest.mark.parametrize("name", sorted(load_queries().QUERIES))
def test_query(spark, con, name):
    verdict, _, _ = check.compare(spark, con, SF, name, queries()[name], oracle_sql().get(name))
    assert verdict in ("ok", "rows only"), verdict


def test_entry(spark):
    assert entry(spark).columns


def test_every_query_of_the_library_has_sql():
    own = load_queries()
    assert set(own.QUERIES) == set(own.ORACLES)
