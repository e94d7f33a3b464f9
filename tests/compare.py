"""Run registered queries next to their SQL counterparts."""

from __future__ import annotations

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings pages "
          "benchmark labels conversations").split()


def connect(sf_dir: str):
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{sf_dir}/{name}.parquet')")
    return con


def _sorted_rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted((tuple(row[i] for i in order) for row in rows), key=repr), [columns[i] for i in order]


def differences(spark_df, con, sql: str) -> str | None:
    """None when rows and columns agree, else what differs."""
    got, got_columns = _sorted_rows(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    cursor = con.execute(sql)
    want, want_columns = _sorted_rows([d[0] for d in cursor.description], cursor.fetchall())
    if got_columns != want_columns:
        return f"columns {got_columns} and {want_columns}"
    if len(got) != len(want):
        return f"{len(got)} and {len(want)} rows"
    for mine, theirs in zip(got, want):
        if mine != theirs:
            return f"{mine} and {theirs}"
    return None
