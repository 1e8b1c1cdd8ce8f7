"""Order-insensitive comparison of a Spark result with an oracle result."""

from __future__ import annotations

import math

import pandas as pd

DRIVER_TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def duckdb_connection(sf_dir: str):
    import os

    import duckdb

    con = duckdb.connect()
    for t in DRIVER_TABLES:
        p = f"{sf_dir}/{t}.parquet"
        if os.path.exists(p):
            con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def _norm(v):
    if v is None:
        return None
    if isinstance(v, float):
        return None if math.isnan(v) else v
    if isinstance(v, pd.Timestamp):
        return v.to_pydatetime().replace(tzinfo=None)
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        try:
            return v.item()
        except Exception:  # noqa: BLE001
            return v
    return v


def sorted_rows(df: pd.DataFrame) -> list[tuple]:
    cols = sorted(df.columns)
    out = [tuple(_norm(v) for v in rec) for rec in df[cols].itertuples(index=False, name=None)]
    return sorted(
        out, key=lambda r: tuple((x is None, str(type(x)), x if x is not None else 0) for x in r)
    )


def _close(a, b, rel: float) -> bool:
    if a is None or b is None:
        return a is None and b is None
    if isinstance(a, float) or isinstance(b, float):
        try:
            return math.isclose(float(a), float(b), rel_tol=rel, abs_tol=rel)
        except (TypeError, ValueError):
            return False
    return a == b


def compare(spark_pd: pd.DataFrame, oracle_pd: pd.DataFrame, rel: float = 1e-9) -> tuple[str, str]:
    """Return (status, detail); status is OK (bit-exact), NEAR or FAIL."""
    if sorted(spark_pd.columns) != sorted(oracle_pd.columns):
        return "FAIL", f"cols {sorted(spark_pd.columns)} != {sorted(oracle_pd.columns)}"
    if len(spark_pd) != len(oracle_pd):
        return "FAIL", f"rows {len(spark_pd)} != {len(oracle_pd)}"
    a, b = sorted_rows(spark_pd), sorted_rows(oracle_pd)
    if a == b:
        return "OK", ""
    bad = [(x, y) for x, y in zip(a, b) if not all(_close(p, q, rel) for p, q in zip(x, y))]
    if bad:
        return "FAIL", f"{len(bad)} rows differ, e.g. {bad[0]}"
    return "NEAR", f"equal within {rel} (not bit-exact)"
