"""Run a named query and its SQL counterpart and compare them as multisets of rows."""

from __future__ import annotations

import math
from collections import Counter

import duckdb

TABLES = (
    "region", "nation", "customer", "supplier", "part", "orders", "lineitem", "events",
    "documents", "embeddings", "pages", "benchmark", "labels", "conversations",
)


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"create view {table} as select * from read_parquet('{sf_dir}/{table}.parquet')")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value
    return value


def compare(spark_df, con, sql: str) -> str | None:
    """Null when equal, else what differs."""
    mine = spark_df.collect()
    names = sorted(spark_df.columns)
    result = con.execute(sql)
    other_names = [d[0] for d in result.description]
    if sorted(other_names) != names:
        return f"columns {names} != {sorted(other_names)}"
    theirs = [dict(zip(other_names, row)) for row in result.fetchall()]
    left = Counter(tuple(_plain(r[n]) for n in names) for r in mine)
    right = Counter(tuple(_plain(r[n]) for n in names) for r in theirs)
    if left == right:
        types = {n: {type(r[n]).__name__ for r in theirs} - {"NoneType"} for n in names}
        odd = {n: t for n, t in types.items() if t - {"int", "float", "str"}}
        return f"odd oracle types {odd}" if odd else None
    extra, missing = list((left - right).items())[:2], list((right - left).items())[:2]
    return f"{len(mine)} vs {len(theirs)} rows\n   spark only {extra}\n   sql only   {missing}\n   {names}"
