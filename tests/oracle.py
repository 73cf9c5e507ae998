"""Compares a registered query with its DuckDB equivalent, column by column, row order aside."""

import glob
import os

import duckdb
import numpy as np
import pandas as pd


def connect(sf_dir):
    c = duckdb.connect()
    for f in glob.glob(f"{sf_dir}/*.parquet"):
        c.sql(f"CREATE VIEW {os.path.basename(f)[:-8]} AS SELECT * FROM '{f}'")
    return c


def _ordered(df):
    df = df[sorted(df.columns)]
    return df.sort_values(list(df.columns), key=lambda s: s.astype(str)).reset_index(drop=True)


def differences(got: pd.DataFrame, want: pd.DataFrame) -> list[str]:
    if sorted(got.columns) != sorted(want.columns):
        return [f"columns {sorted(got.columns)} and {sorted(want.columns)}"]
    if len(got) != len(want):
        return [f"{len(got)} rows and {len(want)}"]
    a, b, out = _ordered(got), _ordered(want), []
    for c in a.columns:
        if pd.api.types.is_numeric_dtype(a[c]) and pd.api.types.is_numeric_dtype(b[c]):
            same = np.isclose(a[c].astype(float), b[c].astype(float), rtol=1e-9, atol=0, equal_nan=True)
        else:
            same = (a[c].astype(str) == b[c].astype(str)) | (a[c].isna() & b[c].isna())
        if not same.all():
            out.append(f"{c}: {int((~same).sum())} rows")
    return out
