"""Comparison of a Spark result with a DuckDB result, without regard to row order."""

from __future__ import annotations

from collections import Counter
from pathlib import Path

import duckdb


def tables(sf_dir: str):
    con = duckdb.connect()
    for file in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {file.stem} AS SELECT * FROM '{file}'")
    return con


def _cell(value):
    return "NaN" if isinstance(value, float) and value != value else value


def difference(df, con, sql: str) -> str | None:
    """None if equal, else what differs."""
    names = sorted(df.columns)
    answer = con.execute(sql)
    theirs = [d[0] for d in answer.description]
    if sorted(theirs) != names:
        return f"columns {names} and {sorted(theirs)}"
    order = [theirs.index(n) for n in names]
    right = Counter(tuple(_cell(row[i]) for i in order) for row in answer.fetchall())
    left = Counter(tuple(_cell(row[n]) for n in names) for row in df.select(*[f"`{n}`" for n in names]).collect())
    if not right:
        return "the SQL gives no row"
    if left == right:
        return None
    return (
        f"{names}: {left.total()} and {right.total()} rows; only in Spark "
        f"{list((left - right).items())[:3]}; only in SQL {list((right - left).items())[:3]}"
    )
