"""Order-insensitive comparison of a Spark result with an oracle result
(column names sorted, rows sorted, values compared exactly)."""

from __future__ import annotations

import math
from pathlib import Path

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def _norm(v):
    if v is None:
        return None
    if hasattr(v, "item") and not isinstance(v, (str, bytes)):
        v = v.item()
    if isinstance(v, float) and math.isnan(v):
        return "nan"
    return v


def canonical_rows(cols, records) -> list[tuple]:
    order = sorted(range(len(cols)), key=lambda i: cols[i])
    out = [tuple(_norm(r[i]) for i in order) for r in records]
    return sorted(out, key=lambda t: tuple((x is None, str(type(x)), x if x is not None else 0) for x in t))


def duckdb_views(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for t in TABLES:
        p = Path(sf_dir) / f"{t}.parquet"
        if p.exists():
            con.sql(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{p}')")
    return con


def compare(sdf, con, sql: str) -> tuple[bool, str]:
    scols = sdf.columns
    srows = canonical_rows(scols, [tuple(r) for r in sdf.collect()])
    res = con.sql(sql)
    ocols = res.columns
    orows = canonical_rows(ocols, res.fetchall())
    if sorted(scols) != sorted(ocols):
        return False, f"columns differ: {sorted(scols)} vs {sorted(ocols)}"
    if srows != orows:
        s, o = set(srows), set(orows)
        return False, f"rows differ ({len(srows)} vs {len(orows)}): only spark {list(s - o)[:2]} only oracle {list(o - s)[:2]}"
    return True, f"{len(srows)} rows"
