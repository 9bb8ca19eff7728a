"""Every registered query against its SQL oracle on the given tables."""

import pytest

from __spark_entry__ import PLANS, STREAMS, entry, oracle_sql, queries
from tests.compare import duck, oracle_rows, spark_rows

FOLDER = "/root/testdata/sf0.001"
QUERIES = queries()


@pytest.fixture(scope="module")
def oracle():
    return duck(FOLDER), oracle_sql()


def test_every_report_has_an_oracle():
    assert {*PLANS, *STREAMS} <= set(oracle_sql()) <= set(QUERIES)


@pytest.mark.parametrize("name", oracle_sql())
def test_matches_oracle(spark, oracle, name):
    connection, sql = oracle
    assert spark_rows(QUERIES[name](spark, FOLDER)) == oracle_rows(connection, sql[name])


def test_entry_has_rows(spark):
    assert entry(spark).count() > 0
