import pytest

from docket.llm.queries import ORACLE, QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query_equals_sql(spark, folder, sql, name):
    got = QUERIES[name](spark, folder)
    names = sorted(got.columns)
    left = [tuple(r) for r in got.select(*names).collect()]
    right = sql.execute(f"select {', '.join(names)} from ({ORACLE[name]})").fetchall()
    assert len(left) > 0
    assert sorted(map(repr, left)) == sorted(map(repr, right))
