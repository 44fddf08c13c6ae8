"""Run a registered query and its SQL twin, compare as multisets of rows."""

from __future__ import annotations

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def connect(sf: str):
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf}/{name}.parquet'")
    return con


def _norm(value):
    if isinstance(value, float):
        return 0.0 if value == 0 else value
    return value


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    data = [tuple(_norm(row[i]) for i in order) for row in rows]
    return names, sorted(data, key=repr)


def difference(df, con, sql: str) -> str | None:
    """None if equal, else a short description."""
    cursor = con.execute(sql)
    want_cols, want = _rows([d[0] for d in cursor.description], cursor.fetchall())
    got_cols, got = _rows(df.columns, df.collect())
    if got_cols != want_cols:
        return f"columns {got_cols} != {want_cols}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w]
    return f"{len(bad)} of {len(got)} rows differ, first {bad[0]}" if bad else None
