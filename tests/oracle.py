"""Runs a query and its SQL side by side and compares their rows."""

import math
from pathlib import Path

import duckdb
import pandas as pd


def views(sf: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.sql("SET TimeZone = 'UTC'")
    for p in sorted(Path(sf).glob("*.parquet")):
        con.sql(f"CREATE VIEW {p.stem} AS SELECT * FROM '{p if p.is_file() else f'{p}/*.parquet'}'")
    return con


def rows(pdf) -> list[tuple]:
    pdf = pdf[sorted(pdf.columns)]

    def plain(x):
        if x is None or x is pd.NA or x is pd.NaT or (isinstance(x, float) and math.isnan(x)):
            return "null"
        if hasattr(x, "item"):
            x = x.item()
        if isinstance(x, bool):
            return str(x)
        if isinstance(x, (int, float)):
            return f"{float(x):.6g}" if not float(x).is_integer() else str(int(x))
        return str(x)

    return sorted(tuple(plain(x) for x in r) for r in pdf.itertuples(index=False))


def differences(spark, con, query, sql: str, sf: str) -> str:
    """Empty if they agree."""
    got, want = query(spark, sf).toPandas(), con.sql(sql).df()
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} and {sorted(want.columns)}"
    a, b = rows(got), rows(want)
    if a == b:
        return ""
    return f"{len(a)} and {len(b)} rows; only here {sorted(set(a) - set(b))[:3]}; only in SQL {sorted(set(b) - set(a))[:3]}"
