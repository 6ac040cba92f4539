"""Run a registered query and its SQL twin over the same parquet files and compare them."""

from __future__ import annotations

import datetime
import decimal
import math

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def oracle_connection(sf_dir: str):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _cell(value):
    if isinstance(value, bool) or value is None:
        return value
    if isinstance(value, (int,)):
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        if math.isnan(value):
            return None
        return int(value) if value.is_integer() else round(value, 6)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None).isoformat()
    return value


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted([names[i] for i in order]), sorted(
        (tuple(_cell(row[i]) for i in order) for row in rows), key=repr
    )


def spark_result(df):
    return _rows(df.columns, [tuple(r) for r in df.collect()])


def oracle_result(con, sql):
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    return _rows(names, cursor.fetchall())


def difference(df, con, sql) -> str | None:
    got_names, got = spark_result(df)
    want_names, want = oracle_result(con, sql)
    if got_names != want_names:
        return f"columns {got_names} != {want_names}"
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}; only spark {sorted(set(got) - set(want), key=repr)[:2]}; only sql {sorted(set(want) - set(got), key=repr)[:2]}"
    if got != want:
        pairs = [(a, b) for a, b in zip(got, want, strict=True) if a != b]
        return f"{len(pairs)} rows differ, e.g. {str(pairs[0])[:1500]}"
    return None
