"""Every registered query against its SQL on the smallest tables."""

import os

import pytest

import __spark_entry__ as spark_entry
from check import compare, connect
from cohortmill.oracles import ORACLES as REFERENCE_ORACLES
from cohortmill.registry import REGISTRY

SF = "/root/testdata/sf0.001"
QUERIES = spark_entry.queries()
ORACLES = spark_entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables not mounted")


@pytest.fixture(scope="module")
def con():
    return connect(SF)


@pytest.mark.parametrize("name", sorted(ORACLES))
def test_query_equals_sql(spark, con, name):
    assert compare(con, QUERIES[name](spark, SF), ORACLES[name]) is None


def test_every_query_has_sql():
    assert set(REGISTRY) == set(REFERENCE_ORACLES)


def test_entry_has_rows(spark):
    df = spark_entry.entry(spark)
    assert df.columns == ["subject", "session", "reference_session", "func_sessions", "task_name"]
    assert df.count() > 0
