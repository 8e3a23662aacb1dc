import pytest
from oracle import connect, difference

from tidemark.llm.queries import ORACLES, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_same_rows_as_sql(spark, testdata, name):
    assert difference(QUERIES[name](spark, testdata), connect(testdata), ORACLES[name]) is None
