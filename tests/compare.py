"""Run registered Spark queries and their DuckDB oracles; compare results."""

from __future__ import annotations

import math

import duckdb
import pandas as pd

TABLES = ["documents", "conversations", "embeddings", "labels", "benchmark", "pages"]


def duck(sf_dir: str, sql: str) -> pd.DataFrame:
    con = duckdb.connect()
    for t in TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con.execute(sql).df()


def _norm(v):
    if v is None or v is pd.NA or (isinstance(v, float) and math.isnan(v)):
        return None
    if hasattr(v, "item"):
        v = v.item()
    if isinstance(v, float):
        return round(v, 6)
    return v


def rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = [tuple(_norm(v) for v in r) for r in df[cols].itertuples(index=False, name=None)]
    return sorted(out, key=lambda r: tuple((x is None, str(x)) for x in r))


def compare(spark, name: str, fn, sql: str, sf_dir: str) -> tuple[bool, str]:
    s = fn(spark, sf_dir).toPandas()
    d = duck(sf_dir, sql)
    if sorted(s.columns) != sorted(d.columns):
        return False, f"columns {sorted(s.columns)} vs {sorted(d.columns)}"
    if len(s) != len(d):
        return False, f"rows {len(s)} vs {len(d)}"
    rs, rd = rows(s), rows(d)
    if rs != rd:
        bad = next(i for i, (a, b) in enumerate(zip(rs, rd)) if a != b)
        return False, f"first diff at {bad}: {str(rs[bad])[:300]} vs {str(rd[bad])[:300]}"
    return True, f"{len(s)} rows"
