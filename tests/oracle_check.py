"""Run a registered Spark query and its DuckDB SQL side by side and compare.

Compares row count, column names, column types (Spark type mapped to the
DuckDB type name) and the multiset of rows (order-insensitive; doubles
compared after rounding to 6 decimals).
"""

from __future__ import annotations

import datetime as dt
import math
import os

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()

SPARK_TO_DUCK = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
    "smallint": "SMALLINT",
}


def duck_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        path = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(path):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{path}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        if math.isnan(v):
            return None
        return round(v, 6)
    if hasattr(v, "to_pydatetime"):
        return v.to_pydatetime()
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None)
    return v


def _key(row):
    """Sort key: exact (non-float) values first, so a last-digit float
    difference cannot reorder rows."""
    exact = tuple((x is None, type(x).__name__, str(x)) for x in row if not isinstance(x, float))
    floats = tuple((x is None, str(x)) for x in row if isinstance(x, float))
    return exact, floats


def _close(a, b, tol):
    if len(a) != len(b):
        return False
    for x, y in zip(a, b):
        if isinstance(x, float) and isinstance(y, float):
            if abs(x - y) > tol:
                return False
        elif x != y:
            return False
    return True


def compare(spark_df, con, sql: str, tol: float = 0.0) -> list[str]:
    """Return a list of problems (empty when the results agree).

    With ``tol`` doubles may differ by that much (an exact tie at the 7th
    decimal can round either way when two engines sum in different orders).
    """
    problems = []
    rel = con.sql(sql)
    duck_cols = rel.columns
    duck_types = [str(t) for t in rel.types]
    duck_rows = rel.fetchall()

    spark_cols = spark_df.columns
    spark_types = [f.dataType.simpleString() for f in spark_df.schema.fields]
    spark_rows = [tuple(r) for r in spark_df.collect()]

    if sorted(spark_cols) != sorted(duck_cols):
        problems.append(f"columns differ: spark={spark_cols} duck={duck_cols}")
        return problems
    dmap = dict(zip(duck_cols, duck_types))
    for c, t in zip(spark_cols, spark_types):
        want = SPARK_TO_DUCK.get(t, t.upper())
        if dmap[c] != want:
            problems.append(f"type of {c}: spark={t} duck={dmap[c]}")
    if len(spark_rows) != len(duck_rows):
        problems.append(f"row count: spark={len(spark_rows)} duck={len(duck_rows)}")
    order = sorted(duck_cols)
    s_idx = [spark_cols.index(c) for c in order]
    d_idx = [duck_cols.index(c) for c in order]
    s = sorted((tuple(_norm(r[i]) for i in s_idx) for r in spark_rows), key=_key)
    d = sorted((tuple(_norm(r[i]) for i in d_idx) for r in duck_rows), key=_key)
    same = s == d if not tol else len(s) == len(d) and all(_close(a, b, tol) for a, b in zip(s, d))
    if not same:
        diff = [(a, b) for a, b in zip(s, d) if a != b][:3]
        problems.append(f"values differ ({sum(a != b for a, b in zip(s, d))} rows), first: {diff} cols={order}")
    return problems
