"""Every lake query against its SQL, on the smallest tables."""
import pytest

from lakeforge.plans.queries import ORACLES, QUERIES
from tests.oracle import connect, spark_rows, sql_rows

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_matches_sql(spark, con, name):
    assert spark_rows(QUERIES[name](spark, SF)) == sql_rows(con, ORACLES[name])


def test_entry(spark):
    import __spark_entry__ as e

    assert e.entry(spark).count() > 0
    assert set(e.oracle_sql()) <= set(e.queries())
