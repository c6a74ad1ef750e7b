"""Every registered query equals its check SQL on the smallest tables."""
import pytest

from lanestride.plans.registry import CHECK_SQL, QUERIES
from tests.check import compare, connect

SF = "sf0.001"
ROWS_ONLY: set[str] = set()


@pytest.fixture(scope="module")
def con():
    return connect(SF)


def test_every_query_has_a_check():
    assert set(QUERIES) - set(CHECK_SQL) == ROWS_ONLY


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    assert compare(spark, con, SF, name, QUERIES[name], CHECK_SQL.get(name)) == ""
