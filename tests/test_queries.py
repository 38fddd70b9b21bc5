"""Each registered query against its SQL, on whole tables."""

import pytest

import __spark_entry__ as contract
from oracle import compare, connect
from tidemark.registry.oracle import sql
from tidemark.registry.queries import registered

FOLDER = "/root/testdata/sf0.001"


@pytest.fixture(scope="module")
def connection():
    with connect(FOLDER) as connection:
        yield connection


def test_every_query_has_sql():
    assert set(registered()) == set(sql())
    assert set(registered()) <= set(contract.queries())


def test_flagship(spark):
    assert contract.entry(spark).columns == ["activity_month", "region", "mau"]
    assert contract.entry(spark).count() == 6


@pytest.mark.parametrize("name", sorted(registered()))
def test_query(spark, connection, name):
    rows = compare(
        spark, connection, FOLDER, contract.queries()[name], contract.oracle_sql()[name]
    )
    assert rows > 0
