"""Every query of the catalog against DuckDB on the same files."""

import os

import pytest

import __spark_entry__ as entry
from oracle import compare, connect
from tabprep.catalog.registry import ORACLES, QUERIES

SF_DIR = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")

if not os.path.isdir(SF_DIR):
    pytest.skip("no test data", allow_module_level=True)


@pytest.fixture(scope="module")
def con():
    return connect(SF_DIR)


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    sql = ORACLES.get(name)
    status, note = compare(spark, con, name, QUERIES[name], sql, SF_DIR)
    assert status == "ok", f"{status} {note}"


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["feature", "threshold", "gain", "n", "n_left"]
    assert df.count() == 1
