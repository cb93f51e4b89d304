"""The driver's contract: registered queries against their SQL."""

from __future__ import annotations

import os

import pytest

import __spark_entry__ as contract
from tools.check_oracle import difference, open_tables
from wayfleet.catalog import oracle
from wayfleet.catalog import queries as catalog

FOLDER = "/root/testdata/sf0.001"
pytestmark = pytest.mark.skipif(
    not os.path.isdir(FOLDER), reason="driver tables are not here"
)


@pytest.fixture(scope="module")
def db():
    return open_tables(FOLDER)


def test_every_query_of_the_catalog_has_sql():
    assert catalog.queries().keys() == oracle.oracle_sql().keys()
    assert catalog.queries().keys() <= contract.queries().keys()
    assert contract.oracle_sql().keys() <= contract.queries().keys()


def test_entry(spark):
    rows = contract.entry(spark)
    assert rows.columns == [
        "taxi_id", "ts", "longitude", "latitude", "seq", "speed", "is_speeding",
    ]
    assert rows.count() > 0


@pytest.mark.parametrize("name", sorted(contract.oracle_sql()))
def test_query_equals_sql(spark, db, name):
    got = contract.queries()[name](spark, FOLDER).toPandas()
    assert difference(got, db.sql(contract.oracle_sql()[name]).df()) is None
