"""Run a registered query and its SQL twin and compare the results exactly."""

from __future__ import annotations

import math

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(folder: str):
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{folder}/{t}.parquet'")
    return con


def _key(row):
    return tuple("" if v is None else f"{type(v).__name__}:{v!r}" for v in row)


def _clean(rows):
    return sorted(([None if isinstance(v, float) and math.isnan(v) else v for v in r] for r in rows), key=_key)


def difference(df, con, sql: str) -> str | None:
    """None when equal, otherwise a short description of the first difference."""
    cols = sorted(df.columns)
    got = _clean([tuple(r) for r in df.select(*cols).collect()])
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    if sorted(names) != cols:
        return f"columns {cols} != {sorted(names)}"
    order = [names.index(c) for c in cols]
    want = _clean([tuple(r[i] for i in order) for r in cur.fetchall()])
    if len(got) != len(want):
        return f"rows {len(got)} != {len(want)}; first {got[:1]} / {want[:1]}"
    bad = [(g, w) for g, w in zip(got, want) if _key(g) != _key(w)]
    return f"{len(bad)} of {len(got)} rows differ; {cols}: {bad[0][0]} / {bad[0][1]}" if bad else None
