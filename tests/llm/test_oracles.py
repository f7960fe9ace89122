"""Corpus queries that SQL can express, on whole tables."""

import pytest

from clickloom.llm.oracles import ORACLES
from clickloom.llm.queries import QUERIES

from ..check_oracles import connect, difference

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_matches_sql(spark, name):
    with connect(SF) as con:
        assert difference(QUERIES[name](spark, SF), con, ORACLES[name]) is None
