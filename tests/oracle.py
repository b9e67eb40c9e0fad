"""Compares a query's rows with those its SQL gives in DuckDB on the same files."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        if Path(f"{sf_dir}/{name}.parquet").exists():
            con.execute(f"create view {name} as select * from read_parquet('{sf_dir}/{name}.parquet')")
    return con


def plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else value + 0.0
    return str(value) if hasattr(value, "isoformat") else value


def bag(columns: list[str], rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(plain(row[i]) for i in order) for row in rows)


def differences(df, sql: str, con) -> str | None:
    """None if names and rows agree, else what differs."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    if sorted(names) != sorted(df.columns):
        return f"columns {sorted(df.columns)} against {sorted(names)}"
    wanted, got = bag(names, result.fetchall()), bag(df.columns, df.collect())
    if wanted == got:
        return None
    return (
        f"{sum(got.values())} rows against {sum(wanted.values())}; "
        f"only here {list((got - wanted).items())[:3]}; only there {list((wanted - got).items())[:3]}"
    )
