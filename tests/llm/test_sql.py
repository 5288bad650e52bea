import pytest
from compare import compare, connect

from wardline.llm import queries

SMALL = "/root/testdata/sf0.001"


def test_sql_belongs_to_queries():
    assert set(queries.ORACLE_SQL) <= set(queries.QUERIES)
    assert sorted(queries.QUERIES, key=lambda q: int(q[2:].split("_")[0])) == list(queries.QUERIES)


@pytest.mark.parametrize("name", sorted(queries.ORACLE_SQL))
def test_rows_agree_with_sql(spark, name):
    same, note = compare(spark, connect(SMALL), name, SMALL)
    assert same, note
