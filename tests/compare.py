"""Runs a registered query and its SQL twin and compares them as multisets of rows."""

from __future__ import annotations

import glob
import math
import os
from collections import Counter

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.splitext(os.path.basename(path))[0]
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return db


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value + 0.0)
    return value


def spark_rows(df) -> tuple[list[str], Counter]:
    names = sorted(df.columns)
    return names, Counter(tuple(_plain(r[n]) for n in names) for r in df.collect())


def duck_rows(db, sql: str) -> tuple[list[str], Counter]:
    result = db.execute(sql)
    columns = [d[0] for d in result.description]
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    names = [columns[i] for i in order]
    return names, Counter(tuple(_plain(r[i]) for i in order) for r in result.fetchall())


SQL_TYPES = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "string": "VARCHAR",
    "date": "DATE", "timestamp_ntz": "TIMESTAMP", "boolean": "BOOLEAN",
}


def type_difference(df, db, sql: str) -> str:
    """Empty when every column has the same type on both sides."""
    theirs = {d[0]: str(d[1]) for d in db.execute(sql).description}
    wrong = [(n, t, theirs.get(n)) for n, t in df.dtypes if SQL_TYPES.get(t) != theirs.get(n)]
    return str(wrong) if wrong else ""


def difference(df, db, sql: str) -> str:
    """Empty when both give the same columns and rows."""
    names, ours = spark_rows(df)
    sql_names, theirs = duck_rows(db, sql)
    if names != sql_names:
        return f"columns {names} vs {sql_names}"
    if ours == theirs:
        return ""
    only_ours, only_theirs = list((ours - theirs).items())[:3], list((theirs - ours).items())[:3]
    return (f"{sum(ours.values())} vs {sum(theirs.values())} rows, "
            f"{sum((ours - theirs).values())} differ: {str(only_ours)[:700]} || {str(only_theirs)[:700]}")
