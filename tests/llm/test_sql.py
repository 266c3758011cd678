"""Queries that SQL can express, against it."""

import pytest
from compare import differences, duck

from farelake.llm import queries


@pytest.mark.parametrize("name", queries.ORACLE)
def test_query_equals_its_sql(spark, small, name):
    assert differences(queries.QUERIES[name](spark, small), queries.ORACLE[name], duck(small)) == []
