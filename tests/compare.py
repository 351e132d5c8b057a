"""Compare a query's rows with those of its SQL in DuckDB."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    if isinstance(value, list):
        return tuple(_plain(v) for v in value)
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(r[i]) for i in order) for r in rows)


# DuckDB type -> Spark type
SAME_TYPES = {
    "BIGINT": "bigint",
    "INTEGER": "int",
    "DOUBLE": "double",
    "VARCHAR": "string",
    "BOOLEAN": "boolean",
    "DATE": "date",
    "TIMESTAMP": "timestamp_ntz",
}


def type_differences(df, con, sql: str) -> list[str]:
    want = con.sql(sql)
    expected = {c: SAME_TYPES.get(str(t), str(t)) for c, t in zip(want.columns, want.types)}
    return [f"{c}: {t}, {expected.get(c)} wanted" for c, t in df.dtypes if expected.get(c) != t]


def differences(df, con, sql: str) -> list[str]:
    """Empty when both give the same columns and the same rows."""
    want = con.sql(sql)
    if sorted(df.columns) != sorted(want.columns):
        return [f"columns {sorted(df.columns)} != {sorted(want.columns)}"]
    got_rows, want_rows = _rows(df.columns, df.collect()), _rows(want.columns, want.fetchall())
    if got_rows == want_rows:
        return []
    only_got, only_want = got_rows - want_rows, want_rows - got_rows
    return [
        f"{sum(got_rows.values())} rows, {sum(want_rows.values())} wanted, {sum(only_got.values())} differ",
        f"columns: {sorted(df.columns)}",
        f"got    {[*only_got][:2]}",
        f"wanted {[*only_want][:2]}",
    ]
