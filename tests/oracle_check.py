"""Compare registered queries with their SQL, as multisets of rows."""

from __future__ import annotations

from pathlib import Path

import duckdb
import pandas as pd

TABLES = "events orders lineitem".split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for file in Path(folder).glob("*.parquet"):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def normal(df: pd.DataFrame) -> pd.DataFrame:
    df = df[sorted(df.columns)].copy()
    for name in df.columns:
        if pd.api.types.is_datetime64_any_dtype(df[name]):
            df[name] = df[name].astype("datetime64[us]")
        elif df[name].dtype == object or str(df[name].dtype) in ("str", "string"):
            df[name] = df[name].astype(object).where(df[name].notna(), None)
    return df.sort_values(list(df.columns), na_position="first").reset_index(drop=True)


def difference(got: pd.DataFrame, want: pd.DataFrame) -> str | None:
    """What differs, or None."""
    if sorted(got.columns) != sorted(want.columns):
        return f"columns {sorted(got.columns)} against {sorted(want.columns)}"
    if len(got) != len(want):
        return f"{len(got)} rows against {len(want)}"
    try:
        pd.testing.assert_frame_equal(
            normal(got), normal(want), check_dtype=False, rtol=0, atol=0, check_exact=True
        )
    except AssertionError as failure:
        return str(failure)[:800]
    return None
