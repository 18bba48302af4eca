"""Run a query and its SQL on the same tables and compare the rows."""

from __future__ import annotations

import math
import time
from decimal import Decimal

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(folder):
    connection = duckdb.connect()
    for name in TABLES:
        connection.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return connection


def _plain(value):
    if isinstance(value, Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else f"{value:.6f}"
    return repr(value)


def sorted_rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(row[i]) for i in order) for row in rows)


def difference(df, connection, sql, times=None):
    """An empty string, or what is different."""
    start = time.time()
    ours = [tuple(row) for row in df.collect()]
    middle = time.time()
    result = connection.execute(sql)
    names = [column[0] for column in result.description]
    theirs = result.fetchall()
    if times is not None:
        times.extend([middle - start, time.time() - middle])
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} and {sorted(names)}"
    left, right = sorted_rows(df.columns, ours), sorted_rows(names, theirs)
    if left == right:
        return ""
    only_left = [row for row in left if row not in set(right)]
    only_right = [row for row in right if row not in set(left)]
    return (
        f"{len(left)} and {len(right)} rows, {len(only_left)} and {len(only_right)} unmatched;"
        f" columns {sorted(names)}; ours {str(only_left[:2])[:900]}; oracle {str(only_right[:2])[:900]}"
    )
