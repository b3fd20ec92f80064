"""Helpers for comparing Spark results with an SQL oracle (tests, scripts)."""

from __future__ import annotations

import datetime as dt
import math
import os
from decimal import Decimal

import pandas as pd
import pyarrow as pa


def duck_views(con, sf_dir: str, tables: list[str]):
    for t in tables:
        p = os.path.join(sf_dir, f"{t}.parquet")
        if os.path.exists(p):
            con.sql(f"CREATE OR REPLACE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    """One form of values that are equal; nothing is rounded, NaN is not NULL."""
    if isinstance(v, float) and math.isnan(v):
        return "NaN"
    if isinstance(v, Decimal) and v == v.to_integral_value():
        return int(v)
    if isinstance(v, dt.datetime) and v.time() == dt.time():
        return str(v.date())
    if isinstance(v, (dt.date, dt.time)):
        return str(v)
    if isinstance(v, (bytes, bytearray)):
        return v.hex()
    if isinstance(v, list):
        return tuple(map(_norm, v))
    if isinstance(v, dict):
        return tuple((k, _norm(x)) for k, x in v.items())
    return v


def _order(v):
    number = isinstance(v, (int, float, Decimal)) and not isinstance(v, bool)
    return (2, 0.0, "") if v is None else (0, v, "") if number else (1, 0.0, str(v))


def canonical(table: pa.Table) -> list[tuple]:
    columns = [list(map(_norm, table.column(c).to_pylist())) for c in sorted(table.column_names)]
    return sorted(zip(*columns), key=lambda r: tuple(map(_order, r)))


def frames_equal(got: pa.Table | pd.DataFrame, exp: pa.Table | pd.DataFrame) -> tuple[bool, str]:
    """Whether two results have the same columns and rows, in any order. Arrow
    tables tell NULL from NaN, which pandas takes for one another."""
    got, exp = (x if isinstance(x, pa.Table) else pa.Table.from_pandas(x, preserve_index=False) for x in (got, exp))
    if sorted(got.column_names) != sorted(exp.column_names):
        return False, f"columns differ: {sorted(got.column_names)} vs {sorted(exp.column_names)}"
    if len(got) != len(exp):
        return False, f"row count {len(got)} vs {len(exp)}"
    for x, y in zip(canonical(got), canonical(exp)):
        if x != y:
            return False, f"first diff: {x} vs {y}"
    return True, f"rows={len(got)}"
