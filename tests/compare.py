"""Run a registered query on Spark and its SQL on DuckDB and compare all rows."""

from __future__ import annotations

from collections import Counter

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()

# DuckDB type names by Spark type name; anything else must not occur.
TYPE_NAMES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "date": "DATE",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    db = duckdb.connect()
    for name in TABLES:
        db.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return db


def differences(df: DataFrame, db: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs between the two results; empty if nothing does."""
    result = db.execute(sql)
    theirs = {d[0]: str(d[1]) for d in result.description}
    ours = {name: TYPE_NAMES[kind] for name, kind in df.dtypes}
    if ours != theirs:
        only = set(ours.items()) ^ set(theirs.items())
        return [f"columns differ: {sorted(only)}"]
    names = sorted(ours)
    places = {name: i for i, name in enumerate(theirs)}
    expected = Counter(tuple(row[places[n]] for n in names) for row in result.fetchall())
    found = Counter(tuple(row[n] for n in names) for row in df.collect())
    out = []
    if found != expected:
        out.append(f"{found.total()} rows against {expected.total()}")
        out += [f"only Spark: {str(row)[:400]}" for row in list((found - expected))[:3]]
        out += [f"only SQL:   {str(row)[:400]}" for row in list((expected - found))[:3]]
    return out
