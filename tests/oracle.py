"""Compare every query with its SQL in DuckDB, as multisets of rows."""

from __future__ import annotations

import glob
import os
from collections import Counter

import duckdb


def connect(sf_dir: str):
    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        view = os.path.basename(path).removesuffix(".parquet")
        con.sql(f"CREATE VIEW {view} AS SELECT * FROM '{path}'")
    return con


def as_multiset(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(str(row[i]) for i in order) for row in rows)


def mismatch(frame, con, sql: str) -> str | None:
    """None if the frame holds the rows the SQL gives, else what differs."""
    relation = con.sql(sql)
    if sorted(frame.columns) != sorted(relation.columns):
        return f"columns {sorted(frame.columns)} against {sorted(relation.columns)}"
    ours = as_multiset(frame.columns, [tuple(r) for r in frame.collect()])
    theirs = as_multiset(relation.columns, relation.fetchall())
    if ours == theirs:
        return None
    return f"only here {list((ours - theirs).items())[:3]}, only in SQL {list((theirs - ours).items())[:3]}"
