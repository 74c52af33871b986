"""The registered queries over whole small tables."""

import os

import pytest
from compare import connect, spark_rows, sql_rows

from qa_analytics.llm.queries import ORACLE_SQL, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.mark.parametrize("name", sorted(ORACLE_SQL))
def test_query_equals_sql(spark, name):
    columns, got = spark_rows(QUERIES[name](spark, SF_DIR))
    sql_columns, expected = sql_rows(connect(SF_DIR), ORACLE_SQL[name])
    assert columns == sql_columns
    assert [x for x in zip(got, expected) if x[0] != x[1]] == [] and len(got) == len(expected)


def test_every_operator_has_its_query():
    assert sorted(int(n[2:].split("_")[0]) for n in QUERIES) == list(range(1, 14))
