"""Row-by-row comparison of a registered query with its SQL twin."""

from __future__ import annotations

import duckdb
import pandas as pd

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings "
    "pages benchmark labels conversations"
).split()


def database(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def _rows(df: pd.DataFrame) -> list[tuple]:
    df = df[sorted(df.columns)]
    out = []
    for row in df.itertuples(index=False, name=None):
        out.append(tuple(None if pd.isna(v) else (float(v) if isinstance(v, float) else v) for v in row))
    return sorted(out, key=lambda r: tuple((v is None, str(v)) for v in r))


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """None when equal, else what differs."""
    mine = spark_df.toPandas()
    theirs = con.execute(sql).df()
    if sorted(mine.columns) != sorted(theirs.columns):
        return f"columns {sorted(mine.columns)} != {sorted(theirs.columns)}"
    a, b = _rows(mine), _rows(theirs)
    if len(a) != len(b):
        return f"{len(a)} rows != {len(b)} rows"
    for x, y in zip(a, b):
        if [str(v) for v in _plain(x)] != [str(v) for v in _plain(y)]:
            return f"{x} != {y}"
    return None


def _plain(row: tuple) -> list:
    """Integers in nullable pandas columns arrive as floats."""
    return [int(v) if isinstance(v, float) and v.is_integer() else v for v in row]
