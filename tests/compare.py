"""Compare Spark results with DuckDB results as sorted rows of plain values."""

from __future__ import annotations

import glob
import math
import os
from decimal import Decimal

import duckdb


def connect(root: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for path in glob.glob(f"{root}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM read_parquet('{path}')")
    return db


def _plain(value):
    if isinstance(value, Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return "nan"
    return value


def _rows(names: list[str], rows) -> list[tuple]:
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return sorted(plain, key=repr)


def spark_rows(df) -> tuple[list[str], list[tuple]]:
    rows = df.collect()
    return sorted(df.columns), _rows(df.columns, rows)


def duck_rows(db, sql: str) -> tuple[list[str], list[tuple], list[str]]:
    result = db.execute(sql)
    names = [d[0] for d in result.description]
    types = [str(d[1]) for d in result.description]
    rows = result.fetchall()
    return sorted(names), _rows(names, rows), [f"{n}:{t}" for n, t in zip(names, types) if t in ("HUGEINT",) or t.startswith("DECIMAL")]
