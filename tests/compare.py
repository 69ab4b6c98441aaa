"""Comparing a query with its check SQL."""

from __future__ import annotations

import math
from decimal import Decimal

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages"
    " benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, Decimal):
        return ("n", format(v.normalize(), "f"))
    if isinstance(v, bool):
        return ("b", str(v))
    if isinstance(v, int):
        return ("n", str(v))
    if isinstance(v, float):
        return ("f", "nan" if math.isnan(v) else repr(v))
    if v is None:
        return ("0", "")
    return ("s", str(v))


def rows_of(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(df, sql: str, con) -> list[str]:
    """What differs between a DataFrame and the SQL result; empty when equal."""
    res = con.execute(sql)
    names = [d[0] for d in res.description]
    want = rows_of(names, res.fetchall())
    got = rows_of(df.columns, [tuple(r) for r in df.collect()])
    out = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(df.columns)} != {sorted(names)}"]
    if len(got) != len(want):
        out.append(f"{len(got)} rows != {len(want)}")
    if got != want:
        w, g = set(want), set(got)
        out += [f"got {list(g - w)[:2]}", f"want {list(w - g)[:2]}"]
    return out
