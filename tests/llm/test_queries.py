import pytest

from matchloom.llm.queries import ORACLE_SQL, QUERIES

from ..oracle import DATA, same


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    same(QUERIES[name](spark, DATA), ORACLE_SQL[name])
