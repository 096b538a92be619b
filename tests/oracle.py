"""Compare a query with its SQL: rows, columns, types and values."""

from __future__ import annotations

import math

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark"
    " labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM '{sf_dir}/{t}.parquet'")
    return con


def _plain(v):
    if isinstance(v, float):
        if math.isnan(v):
            return "nan"
        return repr(v + 0.0)
    return str(v) if v is not None else "\0"


def compare(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when both agree, else what differs."""
    cursor = con.execute(sql)
    names = [d[0] for d in cursor.description]
    kinds = {d[0]: str(d[1]).lower() for d in cursor.description}
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} != {sorted(names)}"
    order = sorted(names)
    want = [tuple(_plain(r[names.index(c)]) for c in order) for r in cursor.fetchall()]
    got = [tuple(_plain(r[c]) for c in order) for r in df.collect()]
    spark_kinds = dict(df.dtypes)
    same = {
        "bigint": "bigint", "int": "integer", "double": "double", "string": "varchar", "date": "date",
        "boolean": "boolean", "timestamp_ntz": "timestamp",
    }
    off = {
        c: (spark_kinds[c], kinds[c])
        for c in order
        if same.get(spark_kinds[c]) != kinds[c] and kinds[c] not in ("string",)
    }
    if len(got) != len(want):
        return f"{len(got)} rows != {len(want)}"
    got.sort()
    want.sort()
    for g, w in zip(got, want):
        if g != w:
            return f"{order}: {g} != {w}"
    if off:
        return f"types {off}"
    return None if want else "no rows"
