"""Every catalogue query against its SQL twin, over whole tables."""

import os

import pytest

from compare import connect, spark_rows, sql_rows
from qa_analytics.plans.catalog import QUERIES
from qa_analytics.plans.oracle import ORACLE_SQL

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.01")


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


def test_every_query_has_a_twin():
    assert set(ORACLE_SQL) == set(QUERIES)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_equals_sql(spark, con, name):
    columns, got = spark_rows(QUERIES[name](spark, SF_DIR))
    sql_columns, expected = sql_rows(con, ORACLE_SQL[name])
    assert columns == sql_columns
    assert len(got) == len(expected)
    different = [(g, e) for g, e in zip(got, expected) if g != e]
    assert not different, different[:3]
