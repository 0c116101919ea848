"""Side-by-side check of a Spark query and its DuckDB oracle: names, types, and values."""

from __future__ import annotations

import math

import duckdb
import pyarrow as pa

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _kind(t: pa.DataType) -> str:
    if pa.types.is_large_string(t) or pa.types.is_string(t):
        return "string"
    if pa.types.is_timestamp(t):
        return f"timestamp{'' if t.tz is None else '_tz'}"
    return str(t)


def _value(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else repr(v + 0.0)
    return repr(v) if v is not None else "~"


def _rows(table: pa.Table) -> list[tuple[str, ...]]:
    names = sorted(table.column_names)
    columns = [[_value(v) for v in table.column(n).to_pylist()] for n in names]
    return sorted(zip(*columns)) if columns else []


def differences(spark_df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Empty when both sides agree."""
    ours = spark_df.toArrow()
    theirs = con.sql(sql).to_arrow_table()
    found = []
    a = {f.name: _kind(f.type) for f in ours.schema}
    b = {f.name: _kind(f.type) for f in theirs.schema}
    if sorted(a) != sorted(b):
        return [f"columns differ: {sorted(a)} / {sorted(b)}"]
    found += [f"type of {n}: {a[n]} / {b[n]}" for n in a if a[n] != b[n]]
    left, right = _rows(ours), _rows(theirs)
    if len(left) != len(right):
        found.append(f"rows: {len(left)} / {len(right)}")
    if left != right:
        only_left = sorted(set(left) - set(right))[:2]
        only_right = sorted(set(right) - set(left))[:2]
        found.append(f"values ({sorted(a)}): {only_left} / {only_right}")
    return found
