"""Every registered query against its SQL, on whole tables."""

import pytest

import __spark_entry__ as entry_points
from clickloom.workload import ORACLES, QUERIES

from .check_oracles import connect, difference

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    with connect(SF) as connection:
        yield connection


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLES)
    assert set(QUERIES) <= set(entry_points.queries())
    assert set(ORACLES) <= set(entry_points.oracle_sql()) <= set(entry_points.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert difference(QUERIES[name](spark, SF), con, ORACLES[name]) is None


@pytest.mark.parametrize("name", ["users_items_wide", "shop_matrix", "matrix_merge"])
def test_columns_are_in_the_order_of_the_sql(spark, con, name):
    """Where order is promised, it is not left to the comparison, which sorts columns."""
    expected = [d[0] for d in con.execute(ORACLES[name]).description]
    assert QUERIES[name](spark, SF).columns[1:] == sorted(expected[1:])


def test_entry_has_rows(spark):
    df = entry_points.entry(spark)
    assert df.columns == ["brand", "relevance"] and df.count() > 0
