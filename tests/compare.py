"""Compare a Spark result with the rows of a DuckDB query, exactly and in any order."""

import datetime
import math

import duckdb

SOURCES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()

# DuckDB type of each Spark type.
TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "timestamp": "TIMESTAMP WITH TIME ZONE",
}


def connect(directory: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in SOURCES:
        con.execute(f"create view {name} as select * from '{directory}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    if isinstance(value, datetime.date | datetime.datetime):
        return value.isoformat()
    return repr(value)


def _rows(rows, order):
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def difference(df, con, sql: str) -> str | None:
    """What differs between the two results, or None."""
    reply = con.execute(sql)
    names = [d[0] for d in reply.description]
    types = {d[0]: str(d[1]) for d in reply.description}
    expected = reply.fetchall()
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    wanted = {n: TYPES.get(t, t) for n, t in df.dtypes}
    if wanted != types:
        return f"types {({n: (wanted[n], types[n]) for n in names if wanted[n] != types[n]})}"
    actual = df.collect()
    left = _rows(actual, [df.columns.index(n) for n in sorted(names)])
    right = _rows(expected, [names.index(n) for n in sorted(names)])
    if left == right:
        return None
    only_left, only_right = set(left) - set(right), set(right) - set(left)
    return f"{len(left)} rows != {len(right)}; {sorted(only_left)[:3]} != {sorted(only_right)[:3]}"
