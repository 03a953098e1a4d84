"""Compare a query with its SQL: row counts, columns and values without regard to order."""

import datetime
import math
from decimal import Decimal

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def plain(x):
    if isinstance(x, bool) or x is None:
        return x
    if isinstance(x, (float, Decimal)):
        return None if isinstance(x, float) and math.isnan(x) else round(float(x), 6)
    if isinstance(x, datetime.datetime):
        return x.replace(tzinfo=None).isoformat()
    return str(x) if isinstance(x, datetime.date) else x


def rows(names, values):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(repr(plain(r[i])) for i in order) for r in values))


def compare(df, sql, sf):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf}/{t}.parquet'")
    found = con.execute(sql)
    names = [d[0] for d in found.description]
    want = rows(names, found.fetchall())
    got = rows(df.columns, [tuple(r) for r in df.collect()])
    assert sorted(names) == sorted(df.columns)
    assert len(got) == len(want), (len(got), len(want))
    for a, b in zip(got, want):
        assert a == b, [(n, x, y) for n, x, y in zip(sorted(names), a, b) if x != y]
    return len(got)
