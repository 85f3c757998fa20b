"""Run a registered query and its SQL on the same tables and compare whole results."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter

import duckdb
from pyspark.sql import DataFrame, SparkSession

from workload.oracle import ORACLE
from workload.queries import REGISTRY

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return None if math.isnan(v) else v + 0.0
    if isinstance(v, dt.datetime) and v.time() == dt.time(0):
        return v.date()
    return v


def _rows(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_cell(row[i]) for i in order) for row in rows)


def compare(
    spark: SparkSession, con: duckdb.DuckDBPyConnection, name: str, sf_dir: str, df: DataFrame | None = None
) -> str | None:
    """None when equal, else what differs. ``df`` is the query's result if it has been built already."""
    df = REGISTRY[name](spark, sf_dir) if df is None else df
    ours_rows = df.collect()
    cur = con.execute(ORACLE[name])
    sql_names = [d[0] for d in cur.description]
    kinds = {d[0]: str(d[1]) for d in cur.description}
    sql_rows = cur.fetchall()
    if sorted(df.columns) != sorted(sql_names):
        return f"columns differ: {sorted(set(df.columns) ^ set(sql_names))}"
    spark_kinds = dict(df.dtypes)
    same = {"int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE", "string": "VARCHAR", "date": "DATE"}
    wrong = {c: (k, kinds[c]) for c, k in spark_kinds.items() if same.get(k, k).upper() != kinds[c].upper()}
    ours, theirs = _rows(df.columns, ours_rows), _rows(sql_names, sql_rows)
    if ours != theirs:
        a, b = list((ours - theirs).items())[:2], list((theirs - ours).items())[:2]
        only = sum((ours - theirs).values()), sum((theirs - ours).values())
        return f"rows {len(ours_rows)}/{len(sql_rows)} differ {only}: {sorted(df.columns)} spark {a} sql {b}"
    if not ours_rows:
        return "both empty"
    return f"types differ: {wrong}" if wrong else None
