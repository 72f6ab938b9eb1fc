"""Side-by-side run of a registered query and its SQL twin."""

from __future__ import annotations

import math
import os
import time

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duck(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        if os.path.exists(f"{sf_dir}/{t}.parquet"):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if v is None:
        return "\0null"
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(round(v, 9) + 0.0)
    return str(v)


def canonical(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return [columns[i] for i in order], sorted(tuple(_cell(r[i]) for i in order) for r in rows)


def compare(spark_df, con, sql, timing=None):
    """Returns None when equal, else a short description of the difference."""
    t0 = time.time()
    got_cols, got = canonical(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    t1 = time.time()
    cur = con.execute(sql)
    want_cols, want = canonical([d[0] for d in cur.description], cur.fetchall())
    if timing is not None:
        timing.update(spark=t1 - t0, sql=time.time() - t1)
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        extra = list(set(got) - set(want))[:2]
        missing = list(set(want) - set(got))[:2]
        return f"rows {len(got)} != {len(want)}; extra {extra} missing {missing}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    if bad:
        return f"{len(bad)} of {len(got)} rows differ, first: {bad[0]}"
    return None
