"""Every registered query with SQL gives the rows of its SQL on the smallest tables."""

import pytest

from issueloom.plans import catalog
from oracle import compare, duck

SF = "/root/testdata/sf0.001"
catalog.load_all()


@pytest.fixture(scope="module")
def con():
    return duck(SF)


@pytest.mark.parametrize("name", sorted(catalog.SQL))
def test_query_equals_sql(spark, con, name):
    said = compare(spark, con, name, SF)
    assert said.startswith("ok"), said


@pytest.mark.parametrize("name", sorted(set(catalog.QUERIES) - set(catalog.SQL) - {"full_cycle"}))
def test_other_queries_run(spark, con, name):
    assert compare(spark, con, name, SF).startswith("rows")
