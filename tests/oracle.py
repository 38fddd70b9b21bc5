"""Runs a registered query and its SQL on the same tables and compares all rows."""

from __future__ import annotations

import duckdb

TABLES = "region nation customer supplier part orders lineitem events".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _rows(columns: list[str], rows) -> tuple[list[str], list[tuple]]:
    order = sorted(range(len(columns)), key=columns.__getitem__)
    picked = [tuple(row[i] for i in order) for row in rows]
    return sorted(columns), sorted(picked, key=repr)


# Types that mean the same in both engines.
SAME = {"BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double", "BOOLEAN": "boolean"}


def compare(spark, connection, folder: str, query, sql: str) -> int:
    result = query(spark, folder)
    expected = connection.execute(sql)
    kinds = {d[0]: SAME.get(str(d[1]), str(d[1])) for d in expected.description}
    assert dict(result.dtypes) == kinds
    ours = _rows(result.columns, result.collect())
    theirs = _rows(list(kinds), expected.fetchall())
    assert ours[0] == theirs[0]
    assert len(ours[1]) == len(theirs[1])
    different = [pair for pair in zip(ours[1], theirs[1]) if pair[0] != pair[1]]
    assert not different, different[:5]
    return len(ours[1])
