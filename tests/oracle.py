"""Compare a Spark result with its SQL twin in DuckDB on the same parquet files."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _cell(x):
    if x is None:
        return "~"
    if isinstance(x, float):
        return "nan" if math.isnan(x) else repr(x)
    if hasattr(x, "item"):
        return _cell(x.item())
    return str(x)


def _rows(columns, rows):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_cell(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str, limit: int = 5) -> list[str]:
    """What differs; empty when names, kinds and all values agree."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(set(df.columns) ^ set(names))}"]
    theirs = _rows(names, result.fetchall())
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    if len(ours) != len(theirs):
        return [f"rows {len(ours)} vs {len(theirs)}"]
    bad = [(a, b) for a, b in zip(ours, theirs) if a != b]
    columns = sorted(names)
    return [
        f"{len(bad)} rows; " + "; ".join(f"{c}: {x} vs {y}" for c, x, y in zip(columns, a, b) if x != y)
        for a, b in bad[:limit]
    ]
