"""The registered queries that have SQL, over the whole tables of the smallest scale."""

import pytest
from compare import SF_DIR, duck, duck_table, spark_table

from stalewatch.llm.oracle import ORACLE
from stalewatch.llm.queries import QUERIES


@pytest.mark.parametrize("name", sorted(ORACLE))
def test_query(spark, name):
    columns, rows = spark_table(QUERIES[name](spark, SF_DIR))
    expected_columns, expected = duck_table(duck(), ORACLE[name])
    assert columns == expected_columns
    assert rows == expected
