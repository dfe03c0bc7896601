"""Compare a registered query with its SQL: same columns, same rows, whatever their order."""

from __future__ import annotations

import datetime
import decimal
import math
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, str):
        return value
    if isinstance(value, decimal.Decimal):
        value = float(value)
    if isinstance(value, float):
        return "nan" if math.isnan(value) else (int(value) if value.is_integer() else value)
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    if isinstance(value, datetime.datetime):
        return value.replace(tzinfo=None)
    return value


def spark_rows(df):
    names = sorted(df.columns)
    return names, Counter(tuple(_plain(r[n]) for n in names) for r in df.collect())


def duck_rows(con, sql):
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    order = sorted(range(len(names)), key=lambda i: names[i])
    rows = Counter(tuple(_plain(r[i]) for i in order) for r in cursor.fetchall())
    return [names[i] for i in order], rows


def difference(df, con, sql) -> str | None:
    names, ours = spark_rows(df)
    other_names, theirs = duck_rows(con, sql)
    if names != other_names:
        return f"columns {names} vs {other_names}"
    if ours == theirs:
        return None
    only_ours, only_theirs = list((ours - theirs).items())[:3], list((theirs - ours).items())[:3]
    return f"{sum(ours.values())} vs {sum(theirs.values())} rows; only ours {only_ours}; only theirs {only_theirs}"
