"""Data tests as DataFrame operators; each returns failures and changes nothing."""

from __future__ import annotations

from dataclasses import dataclass, field
from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class TableTests:
    """Declared tests of one table.

    ``accepted`` maps a column to its allowed values, ``references`` a foreign key
    to ``(parent table, parent key)``.
    """

    not_null: tuple[str, ...] = ()
    unique: tuple[str, ...] = ()
    accepted: dict[str, tuple] = field(default_factory=dict)
    references: dict[str, tuple[str, str]] = field(default_factory=dict)

    def __len__(self) -> int:
        return sum(map(len, (self.not_null, self.unique, self.accepted, self.references)))


def _literal(value: object) -> str:
    if isinstance(value, str):
        escaped = value.replace("\\", "\\\\").replace("'", "\\'")
        return f"'{escaped}'"
    return str(value)


def _failures(counted: DataFrame, tests: list[tuple[str, ...]], names: str) -> DataFrame:
    """One row per test; each is its names and last the aggregate that counts its failures.

    As text: a suite has many tests, and each is one expression less to put together.
    """
    counts = counted.selectExpr(*[f"{test[-1]} AS f{i}" for i, test in enumerate(tests)])
    cells = [", ".join([*map(_literal, test[:-1]), f"f{i}"]) for i, test in enumerate(tests)]
    return counts.selectExpr(f"stack({len(tests)}, {', '.join(cells)}) AS ({names}, failures)")


def row_test_failures(
    df: DataFrame, not_null: tuple[str, ...] = (), accepted: dict[str, tuple] | None = None
) -> DataFrame:
    """Failing rows of all NULL and value-list tests of a table, in one pass over it."""
    tests = [("not_null", name, f"count_if(`{name}` IS NULL)") for name in not_null]
    # A NULL passes the value list; not_null is the test for that.
    for name, values in (accepted or {}).items():
        allowed = ", ".join(map(_literal, values))
        tests.append(("accepted_values", name, f"count_if(`{name}` NOT IN ({allowed}))"))
    return _failures(df, tests, "test, column_name")


def not_null(df: DataFrame, *columns: str) -> DataFrame:
    return row_test_failures(df, columns)


def accepted_values(df: DataFrame, column: str, values: tuple) -> DataFrame:
    return row_test_failures(df, (), {column: values})


def duplicate_keys(df: DataFrame, key: str) -> DataFrame:
    """Values that occur more than once, with their row count; NULL is no value."""
    counted = df.where(F.col(key).isNotNull()).groupBy(key).agg(F.count("*").alias("n_rows"))
    return counted.where("n_rows > 1")


def orphan_keys(child: DataFrame, foreign_key: str, parent: DataFrame, key: str) -> DataFrame:
    """Foreign keys without a parent row, with their row count; NULL has no parent to miss.

    The child is reduced to its distinct keys before the join, so a parent with a
    large share of the child rows costs one row per task.
    """
    used = (
        child.where(F.col(foreign_key).isNotNull())
        .groupBy(foreign_key)
        .agg(F.count("*").alias("n_rows"))
    )
    parents = parent.select(F.col(key).alias(foreign_key))
    return used.join(parents, foreign_key, "left_anti")


def _key_columns(suite: dict[str, TableTests]) -> list[list[tuple[str, str]]]:
    """The (table, column) pairs under key tests, those that are compared or of one name together."""
    groups: list[set[tuple[str, str]]] = []

    def join(*columns: tuple[str, str]) -> None:
        touched = [g for g in groups if g & set(columns) or {c for _, c in g} & {c for _, c in columns}]
        for group in touched:
            groups.remove(group)
        groups.append(set(columns).union(*touched))

    for name, tests in suite.items():
        for key in tests.unique:
            join((name, key))
        for key, parent in tests.references.items():
            join((name, key), parent)
    return [sorted(group) for group in groups]


def key_test_failures(tables: dict[str, DataFrame], suite: dict[str, TableTests]) -> list[DataFrame]:
    """Failures of all ``unique`` and ``relationships`` tests, a table of them per kind of key.

    The keys of all tables are counted together, each row marked with the column it is
    from: one shuffle tells how often a key is in every column, and so both whether it is
    repeated and whether it has a parent. Tasks combine their rows first, so a key with a
    large share of the rows costs one row per task. NULL is no key.
    """
    found = []
    for columns in _key_columns(suite):
        number = {column: i for i, column in enumerate(columns)}
        marked = [
            tables[name].selectExpr(f"`{key}` AS key", f"{i} AS of")
            for (name, key), i in number.items()
        ]
        keys = reduce(DataFrame.unionByName, marked).where("key is not null")
        counts = keys.groupBy("key").agg(
            *[F.expr(f"count_if(of = {i}) AS n{i}") for i in number.values()]
        )
        tests = []
        for (name, key), i in number.items():
            declared = suite.get(name, TableTests())
            if key in declared.unique:
                tests.append((name, "unique", key, f"count_if(n{i} > 1)"))
            parent = declared.references.get(key)
            if parent:
                orphans = f"sum(CASE WHEN n{number[parent]} = 0 THEN n{i} ELSE 0 END)"
                tests.append((name, "relationships", key, f"coalesce({orphans}, 0)"))
        found.append(_failures(counts, tests, "table_name, test, column_name"))
    return found


def run_tests(tables: dict[str, DataFrame], suite: dict[str, TableTests]) -> DataFrame:
    """``(table_name, test, column_name, failures)`` for every declared test.

    Failures are rows, or for ``unique`` the keys that occur more than once. Each table
    is read once for the tests of its rows, and its keys once per kind of key.
    """
    parts = [
        row_test_failures(tables[name], tests.not_null, tests.accepted).select(
            F.lit(name).alias("table_name"), "*"
        )
        for name, tests in suite.items()
        if tests.not_null or tests.accepted
    ]
    return reduce(DataFrame.unionByName, parts + key_test_failures(tables, suite))


# The declared tests of the raw tables, the staged events and the analytics layer.
# The analytics tables have no relationship tests: soft-deleted rows are gone there.
SUITE = {
    "user": TableTests(
        not_null=("user_id", "first_name", "last_name", "created_at", "country_code"),
        unique=("user_id",),
    ),
    "post": TableTests(
        not_null=("post_id", "user_id", "post_text", "created_at"),
        unique=("post_id",),
        references={"user_id": ("user", "user_id")},
    ),
    "event": TableTests(
        not_null=("event_id", "user_id", "post_id", "created_at", "event_type"),
        unique=("event_id",),
        accepted={"event_type": ("view", "like")},
        references={"user_id": ("user", "user_id"), "post_id": ("post", "post_id")},
    ),
    "stg_events": TableTests(not_null=("event_id",), unique=("event_id",)),
    "dim_users": TableTests(
        not_null=("user_id", "country_code", "country", "region", "created_at", "updated_at"),
        unique=("user_id",),
    ),
    "dim_posts": TableTests(
        not_null=(
            "post_id",
            "creator_id",
            "creator_country_code",
            "creator_country",
            "creator_region",
            "created_at",
            "updated_at",
        ),
        unique=("post_id",),
    ),
    "fct_events": TableTests(
        not_null=(
            "event_id",
            "user_id",
            "post_id",
            "created_at",
            "event_type",
            "is_like",
            "partition_date",
        ),
        unique=("event_id",),
        accepted={"event_type": ("like", "view")},
    ),
}
