import pytest
from oracle import compare, connect

from cityviews.llm import queries

SF = "/root/testdata/sf0.001"


@pytest.mark.parametrize("name", sorted(queries.ORACLES))
def test_query_equals_sql(spark, name):
    assert compare(queries.QUERIES[name](spark, SF), connect(SF), queries.ORACLES[name]) is None
