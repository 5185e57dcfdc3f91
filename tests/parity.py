"""Spark result against DuckDB result of the same tables."""

from __future__ import annotations

import glob
import os

import duckdb
import pandas as pd


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    c = duckdb.connect()
    for p in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(p).removesuffix(".parquet")
        c.execute(f"CREATE VIEW {name} AS SELECT * FROM '{p}{'/*.parquet' if os.path.isdir(p) else ''}'")
    return c


def canonical(df: pd.DataFrame) -> list[tuple[str, ...]]:
    def text(v) -> str:
        if v is None or v is pd.NaT or v is pd.NA or (isinstance(v, float) and v != v):
            return "null"
        if isinstance(v, (bool,)) or type(v).__name__ == "bool_" or type(v).__name__ == "bool":
            return str(bool(v))
        if isinstance(v, float) or type(v).__name__.startswith("float"):
            return repr(round(float(v), 9) + 0.0) if float(v) != int(v) else str(int(v))
        return str(v)

    return sorted(tuple(text(v) for v in row) for row in df[sorted(df.columns)].astype(object).itertuples(index=False, name=None))


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str:
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(set(got.columns) ^ set(want.columns))}"
    a, b = canonical(got), canonical(want)
    if a == b:
        return ""
    extra, missing = [x for x in a if x not in set(b)][:3], [x for x in b if x not in set(a)][:3]
    return f"{len(a)} rows, {len(b)} wanted; {sorted(got.columns)}; only here {extra}; only there {missing}"
