"""Every registered query against its SQL, on the smallest given tables."""

import pytest

import __spark_entry__ as entry
import workload
from oracle_check import compare, connect

SF = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def tables():
    return connect(SF)


def test_every_query_has_sql():
    assert set(workload.all_queries()) == set(workload.all_sql())


def test_entry(spark):
    assert entry.entry(spark).count() > 0


@pytest.mark.parametrize("name", sorted(workload.all_queries()))
def test_query(spark, tables, name):
    got = workload.all_queries()[name](spark, SF).toArrow()
    want = tables.sql(workload.all_sql()[name]).to_arrow_table()
    assert compare(got, want).startswith("ok")
