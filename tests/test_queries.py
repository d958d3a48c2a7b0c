"""Every registered query against its SQL twin on the smallest tables."""

import os

import pytest

import __spark_entry__ as entry
import check
from jobsluice.queries import REGISTRY

SF = os.environ.get("TEST_SF_DIR", "/root/testdata/sf0.001")
QUERIES, SQL = {name: run for name, run in entry.queries().items() if name in REGISTRY}, entry.oracle_sql()

pytestmark = pytest.mark.skipif(not os.path.isdir(SF), reason="test tables are not there")


@pytest.fixture(scope="module")
def con():
    return check.connect(SF)


@pytest.mark.parametrize("name", QUERIES)
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF)
    assert name in SQL
    same, note = check.compare(df, SQL[name], con)
    assert same, note


def test_entry(spark):
    df = entry.entry(spark)
    assert df.columns == ["url", "page_id", "pos"] and df.count() > 0
