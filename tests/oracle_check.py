"""Run a registered query in Spark and its oracle in DuckDB, and compare them exactly."""

from __future__ import annotations

import glob
import os

import duckdb

# Spark type names by the DuckDB type they must meet.
SAME_TYPE = {
    "string": "VARCHAR", "int": "INTEGER", "bigint": "BIGINT", "double": "DOUBLE",
    "float": "FLOAT", "date": "DATE", "boolean": "BOOLEAN", "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    # Where an order leaves NULLs open, they stand where Spark puts them.
    db.execute("set default_null_order = 'nulls_first_on_asc_last_on_desc'")
    for path in glob.glob(f"{sf_dir}/*.parquet"):
        name = os.path.basename(path)[: -len(".parquet")]
        db.execute(f"create view {name} as select * from read_parquet('{path}')")
    return db


def _rows(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    return sorted((tuple(repr(row[i]) for i in order) for row in rows))


def is_ordered(df) -> bool:
    """Whether the query itself puts its rows in order."""
    return df._jdf.queryExecution().analyzed().toString().lstrip().startswith(("Sort", "GlobalLimit"))


def out_of_order(df, db, sql: str) -> list[str]:
    """For a query that orders its rows: where its order is not the oracle's."""
    result = db.sql(sql)
    names = sorted(df.columns)
    ours = [tuple(repr(r[n]) for n in names) for r in df.collect()]
    at = [list(result.columns).index(n) for n in names]
    theirs = [tuple(repr(r[i]) for i in at) for r in result.fetchall()]
    return [f"row {i}: {a} against {b}" for i, (a, b) in enumerate(zip(ours, theirs)) if a != b][:3]


def differences(df, db, sql: str) -> list[str]:
    """What differs between the two results; nothing if they are equal."""
    result = db.sql(sql)
    types = dict(zip(result.columns, map(str, result.types)))
    found = []
    if set(df.columns) != set(types):
        return [f"columns {sorted(set(df.columns) ^ set(types))}"]
    for name, kind in df.dtypes:
        if SAME_TYPE.get(kind) != types[name]:
            found.append(f"type of {name}: {kind} against {types[name]}")
    ours = _rows(df.columns, [tuple(r) for r in df.collect()])
    theirs = _rows(result.columns, result.fetchall())
    if len(ours) != len(theirs):
        found.append(f"{len(ours)} rows against {len(theirs)}")
    elif ours != theirs:
        pairs = [(a, b) for a, b in zip(ours, theirs) if a != b]
        found.append(f"{len(pairs)} rows differ, first {pairs[0]}")
    return found
