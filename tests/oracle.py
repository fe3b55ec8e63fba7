"""Runs a registered query and its SQL side by side and compares every value."""

from __future__ import annotations

import datetime as dt
import math
from pathlib import Path

import duckdb

KINDS = {
    "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE", "float": "FLOAT",
    "string": "VARCHAR", "boolean": "BOOLEAN", "date": "DATE",
    "timestamp": "TIMESTAMP", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM '{path}'")
    return con


def _key(value):
    if value is None:
        return (0, "")
    if isinstance(value, float):
        return (1, "nan" if math.isnan(value) else repr(value + 0.0))
    if isinstance(value, dt.datetime):
        return (1, value.replace(tzinfo=None).isoformat())
    return (1, repr(value))


def compare(df, con, sql: str) -> list[str]:
    """Differences as text; empty when schema and values agree."""
    problems = []
    rel = con.sql(sql)
    theirs = dict(zip(rel.columns, [str(t) for t in rel.types]))
    ours = {f.name: KINDS.get(f.dataType.simpleString(), f.dataType.simpleString()) for f in df.schema}
    if sorted(theirs) != sorted(ours):
        return [f"columns {sorted(ours)} vs {sorted(theirs)}"]
    problems += [f"type of {c}: {ours[c]} vs {theirs[c]}" for c in ours if ours[c] != theirs[c]]
    cols = sorted(ours)
    left = sorted([tuple(_key(r[c]) for c in cols) for r in df.collect()])
    order = [rel.columns.index(c) for c in cols]
    right = sorted([tuple(_key(r[i]) for i in order) for r in rel.fetchall()])
    if len(left) != len(right):
        problems.append(f"{len(left)} rows vs {len(right)}")
    for a, b in zip(left, right):
        if a != b:
            diff = [(c, x[1][:120], y[1][:120]) for c, x, y in zip(cols, a, b) if x != y]
            problems.append(f"first difference: {diff}; key {[x[1][:30] for x in a][:4]}")
            break
    if not left:
        problems.append("no rows")
    return problems
