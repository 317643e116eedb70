import pytest

from blockflow.llm import queries as Q
from tests.oracle import compare, connection


@pytest.mark.parametrize("sf_dir", ["/root/testdata/sf0.001", "/root/testdata/sf0.01", "/root/testdata/sf0.1"])
@pytest.mark.parametrize("name", sorted(Q.oracle_sql()))
def test_equals_sql(spark, name, sf_dir):
    assert compare(Q.queries()[name](spark, sf_dir), connection(sf_dir), Q.oracle_sql()[name]) > 0


def test_names():
    assert set(Q.oracle_sql()) <= set(Q.queries())
    assert {f"op{n}" for n in range(1, 11)} == {q.split("_")[0] for q in Q.queries() if q.startswith("op")}
