"""Every registered query against its SQL on the smallest tables."""

import os

import oracle
import pytest

import __spark_entry__ as contract
from labtrail.catalog import QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")


@pytest.fixture(scope="module")
def database():
    return oracle.connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query_agrees_with_its_sql(spark, database, name):
    df = contract.queries()[name](spark, SF_DIR)
    assert oracle.compare(df, database, contract.oracle_sql()[name]) is None


def test_entry_returns_rows(spark):
    assert contract.entry(spark).count() > 0


def test_no_python_on_the_data_path(spark):
    for name in ("qc_summary", "sample_summary", "layout_canonical", "station_mapping", "nested_results_flat"):
        plan = contract.queries()[name](spark, SF_DIR)._jdf.queryExecution().toString()
        assert "Python" not in plan and "CartesianProduct" not in plan and "NestedLoop" not in plan
