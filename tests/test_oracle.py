"""Every registered query against its SQL."""

import os

import compare
import pytest

SF = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="driver tables not here")

from voltatlas.queries import QUERIES, SQL  # noqa: E402


@pytest.fixture(scope="module")
def con():
    return compare.connect(SF)


def test_every_sql_has_a_query():
    assert set(SQL) <= set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    plan = df._jdf.queryExecution().executedPlan().toString()
    assert "Python" not in plan and "Pandas" not in plan
    if name in SQL:
        assert compare.difference(df, con, SQL[name]) is None
    else:
        assert df.count() > 0


def test_entry(spark):
    from __spark_entry__ import entry

    assert entry(spark).count() > 0
