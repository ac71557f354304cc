"""Run a job and its oracle and compare rows, column by column."""

from __future__ import annotations

import datetime
import decimal

import duckdb

VIEWS = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def oracle_connection(folder: str):
    con = duckdb.connect()
    for name in VIEWS.split():
        con.execute(f"create view {name} as select * from read_parquet('{folder}/{name}.parquet')")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return str(value)
    if isinstance(value, (datetime.datetime, datetime.date)):
        return value.isoformat()
    if isinstance(value, float):
        return repr(value)
    return value


def _bag(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(_plain(row[i]) for i in order) for row in rows), key=repr)


def compare(df, con, sql) -> str:
    """An empty text if both agree, else what differs."""
    cursor = con.execute(sql)
    columns = [d[0] for d in cursor.description]
    expected = cursor.fetchall()
    if sorted(columns) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(columns)}"
    kinds = {d[0]: str(d[1]).lower() for d in cursor.description}
    alike = {"bigint": "bigint", "int": "integer", "string": "varchar", "timestamp_ntz": "timestamp", "boolean": "boolean", "date": "date"}
    odd = [
        f"{c}: {k} vs {kinds[c]}"
        for c, k in df.dtypes
        if alike.get(k, k) != kinds[c] and k.replace("decimal", "") != kinds[c].replace("decimal", "").replace(" ", "")
    ]
    ours, theirs = _bag(df.columns, [tuple(r) for r in df.collect()]), _bag(columns, expected)
    if len(ours) != len(theirs):
        return f"rows {len(ours)} != {len(theirs)}; types {odd}"
    for a, b in zip(ours, theirs):
        if a != b:
            return f"differs: {a} vs {b} columns {sorted(columns)}; types {odd}"
    return f"types {odd}" if odd else ""
