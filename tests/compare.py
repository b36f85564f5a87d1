"""Run the registered queries beside their SQL in DuckDB and compare rows."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"


def oracle_connection(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES.split():
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    clean = lambda v: None if isinstance(v, float) and math.isnan(v) else v
    out = [tuple(clean(r[i]) for i in order) for r in rows]
    return sorted(out, key=lambda r: tuple((v is None, str(type(v)), v if v is not None else 0) for v in r))


def difference(df, sql: str, con) -> str | None:
    """None when the rows are identical, else what differs."""
    cur = con.execute(sql)
    names = [d[0] for d in cur.description]
    want = sorted_rows(names, cur.fetchall())
    got = sorted_rows(df.columns, [tuple(r) for r in df.collect()])
    if sorted(df.columns) != sorted(names):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    bad = [(g, w) for g, w in zip(got, want) if g != w or [type(x) for x in g] != [type(x) for x in w]]
    return f"{len(bad)} rows differ, first {bad[0]}" if bad else None


def type_difference(df, sql: str, con) -> str | None:
    """None when every column has the matching SQL type."""
    same = {
        "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR", "boolean": "BOOLEAN",
        "timestamp_ntz": "TIMESTAMP",
    }
    want = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    bad = {c: (t, want.get(c)) for c, t in df.dtypes if same.get(t) != want.get(c)}
    return str(bad) if bad else None
