"""Run a query on Spark and its SQL counterpart on DuckDB, and list the rows that differ."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _cell(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.9g}")
    return value


def rows_of(names, rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [tuple(_cell(row[i]) for i in order) for row in rows]


def compare(df, con, sql: str, ordered: bool = False) -> tuple[list, list, int]:
    """Rows only Spark has, rows only the SQL has, number of Spark rows. Column names must agree.

    With ``ordered`` the rows must come in the same order too.
    """
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(names) == sorted(df.columns), (sorted(names), sorted(df.columns))
    expected = rows_of(names, cursor.fetchall())
    actual = rows_of(df.columns, df.collect())
    if ordered:
        assert actual == expected
    only, missing = Counter(actual) - Counter(expected), Counter(expected) - Counter(actual)
    return list(only.items()), list(missing.items()), len(actual)
