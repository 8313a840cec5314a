"""Runs a registered query beside its SQL text on the same parquet tables."""

from __future__ import annotations

import glob
import math
import os

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return con


def _sortable(row):
    return tuple((v is None, str(type(v)) if v is None else "", repr(v)) for v in row)


def _plain(value):
    if isinstance(value, float) and math.isnan(value):
        return "NaN"
    if isinstance(value, float) and value == 0:
        return 0.0
    return value


def rows_of(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return [names[i] for i in order], sorted(
        (tuple(_plain(r[i]) for i in order) for r in rows), key=_sortable
    )


def differences(spark_df, con, sql: str) -> str | None:
    """None if names, row count and every value agree, else what differs."""
    cursor = con.execute(sql)
    sql_names, sql_rows = rows_of([d[0] for d in cursor.description], cursor.fetchall())
    names, rows = rows_of(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    if names != sql_names:
        return f"columns {names} != {sql_names}"
    if len(rows) != len(sql_rows):
        return f"{len(rows)} rows != {len(sql_rows)}"
    if not rows:
        return "no rows"
    for mine, theirs in zip(rows, sql_rows):
        if mine != theirs or [type(v) for v in mine] != [type(v) for v in theirs]:
            return f"{dict(zip(names, mine))} != {dict(zip(names, theirs))}"
    return None
