import pytest

from matchloom.queries import ORACLE_SQL, QUERIES

from .oracle import DATA, same


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    same(QUERIES[name](spark, DATA), ORACLE_SQL[name])


@pytest.mark.parametrize("name", sorted(set(QUERIES) - set(ORACLE_SQL)))
def test_query_gives_rows(spark, name):
    assert QUERIES[name](spark, DATA).count() > 0


def test_index_is_held_once(spark):
    """Both questions read the held index: no plan builds it again."""
    from matchloom import queries
    from matchloom.operators.blocking import Blocker

    s1, s23 = queries.sides(spark, DATA)
    blocker = Blocker().fit(s23).keep()
    plan = blocker.candidates(s1)._jdf.queryExecution().optimizedPlan().toString()
    blocker.release()
    assert "InMemoryRelation" in plan and "LeftAnti" not in plan.split("InMemoryRelation")[0]


def test_entry_gives_rows(spark):
    import __spark_entry__

    assert __spark_entry__.entry(spark).count() > 0
    assert set(__spark_entry__.oracle_sql()) <= set(__spark_entry__.queries())
