"""The queries that have SQL, against it."""

import pytest
from conftest import FOLDER
from oracle import compare, connect

from tidemark.llm.queries import registered, sql


@pytest.fixture(scope="module")
def connection():
    with connect(FOLDER) as connection:
        for name in ("documents", "embeddings"):
            connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{FOLDER}/{name}.parquet'")
        yield connection


@pytest.mark.parametrize("name", sorted(sql()))
def test_query(spark, connection, name):
    assert compare(spark, connection, FOLDER, registered()[name], sql()[name]) > 0
