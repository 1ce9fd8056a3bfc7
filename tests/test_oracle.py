"""Every registered query against its SQL."""

import pytest
from compare import SF_DIR, duck, duck_table, spark_table

from stalewatch.suite.oracle import ORACLE
from stalewatch.suite.queries import QUERIES


@pytest.fixture(scope="module")
def con():
    return duck()


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    result = QUERIES[name](spark, SF_DIR)
    assert spark_table(result) == duck_table(con, ORACLE[name])
    plan = result._jdf.queryExecution().executedPlan().toString()
    assert "NestedLoopJoin" not in plan and "CartesianProduct" not in plan
