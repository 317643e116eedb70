import pytest

from blockflow.plans import queries as plans
from tests.oracle import compare, connection

SF = "/root/testdata/sf0.01"


@pytest.fixture(scope="module")
def con():
    return connection(SF)


@pytest.mark.parametrize("name", sorted(plans.queries()))
def test_equals_sql(spark, con, name):
    n = compare(plans.queries()[name](spark, SF), con, plans.oracle_sql()[name])
    assert n > 0


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() == 10
    assert set(e.oracle_sql()) <= set(e.queries())
