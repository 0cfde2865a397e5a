"""Compare a query's rows with those of its SQL, in any order."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    connection = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return connection


def _plain(value):
    if isinstance(value, float):
        return None if math.isnan(value) else round(value, 9)
    return value


def rows_of(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda n: columns[n])
    return Counter(tuple(_plain(row[n]) for n in order) for row in rows)


def assert_equal(df, sql: str, connection) -> int:
    cursor = connection.execute(sql)
    names = [d[0] for d in cursor.description]
    expected = rows_of(names, cursor.fetchall())
    assert sorted(df.columns) == sorted(names)
    found = rows_of(df.columns, df.collect())
    missing, extra = expected - found, found - expected
    assert not missing and not extra, (
        f"{sum(missing.values())} rows missing, e.g. {list(missing)[:3]}; "
        f"{sum(extra.values())} rows too many, e.g. {list(extra)[:3]}"
    )
    return sum(found.values())
