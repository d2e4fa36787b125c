"""Compare a Spark result with the checking engine's, row order aside."""

from __future__ import annotations

import math
from pathlib import Path

import duckdb


def open_tables(folder: str) -> duckdb.DuckDBPyConnection:
    engine = duckdb.connect()
    for file in Path(folder).glob("*.parquet"):
        engine.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM read_parquet('{file}')")
    return engine


def canonical(rows: list, columns: list[str]) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])

    def value(v):
        if v is None or (isinstance(v, float) and math.isnan(v)):
            return ""
        return f"{v:.9g}" if isinstance(v, float) else str(v)

    return sorted(tuple(value(row[i]) for i in order) for row in rows)


def difference(frame, engine: duckdb.DuckDBPyConnection, sql: str) -> str | None:
    """A description of the first differences, or None."""
    rows = frame.collect()
    found = engine.execute(sql)
    names = [d[0] for d in found.description]
    if sorted(frame.columns) != sorted(names):
        return f"columns {sorted(frame.columns)} and {sorted(names)}"
    ours, theirs = canonical(rows, frame.columns), canonical(found.fetchall(), names)
    if ours == theirs:
        return None
    extra = [r for r in ours if r not in set(theirs)][:3]
    absent = [r for r in theirs if r not in set(ours)][:3]
    return f"{len(ours)} and {len(theirs)} rows; extra {extra}; missing {absent}"
