"""Every registered query against its SQL, on tables large enough for every sensor to have rows."""

from pathlib import Path

import pytest

import __spark_entry__ as contract
from spanwatch.checks.oracle import ORACLE
from spanwatch.checks.queries import QUERIES
from tests.compare import difference, tables

SF_DIR = "/root/testdata/sf0.01"

pytestmark = pytest.mark.skipif(not Path(SF_DIR).exists(), reason="no test tables")


@pytest.fixture(scope="module")
def con():
    return tables(SF_DIR)


def test_every_query_has_sql():
    assert set(QUERIES) == set(ORACLE)
    assert set(QUERIES) <= set(contract.queries())


@pytest.mark.parametrize("name", sorted(QUERIES))
def test_query(spark, con, name):
    df = QUERIES[name](spark, SF_DIR)
    found = difference(df, con, ORACLE[name])
    assert found is None


def test_entry(spark):
    rows = contract.entry(spark).collect()
    assert {r["sensor_id"] for r in rows} == {"ICD01_x", "ICD01_y", "POT01_s", "EST01_e"}
