"""The queries that have SQL beside it, on the smallest tables."""

import pytest
from compare import connect, differences

from matchlake.llm.oracles import ORACLES
from matchlake.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_against_sql(spark, small, name):
    assert not differences(QUERIES[name](spark, small), connect(small), ORACLES[name])
