"""Spark rows against DuckDB rows of the same tables."""

import math
from pathlib import Path

import duckdb


def connect(sf: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for p in sorted(Path(sf).glob("*.parquet")):
        db.execute(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p}{'/*.parquet' if p.is_dir() else ''}'")
    return db


def _plain(v):
    if isinstance(v, float):
        return None if math.isnan(v) else round(v, 9) + 0.0
    return v


def rows(columns: list[str], found) -> list[str]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(repr([_plain(float(r[i]) if isinstance(r[i], int) and not isinstance(r[i], bool) else r[i]) for i in order]) for r in found)


def compare(query, sql: str, spark, sf: str) -> None:
    df = query(spark, sf)
    cursor = connect(sf).execute(sql)
    names = [d[0] for d in cursor.description]
    assert sorted(df.columns) == sorted(names)
    assert rows(df.columns, df.collect()) == rows(names, cursor.fetchall())
