"""Run a query on Spark and its plain SQL on DuckDB, and compare schema, counts and values."""

from __future__ import annotations

import math
from collections import Counter
from pathlib import Path

import duckdb

# DuckDB type per Spark type, for results that are to match column by column.
DUCK_TYPES = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "double": "DOUBLE",
    "boolean": "BOOLEAN",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(folder).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _rows(names: list[str], rows) -> Counter:
    order = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(
        tuple("nan" if isinstance(r[i], float) and math.isnan(r[i]) else r[i] for i in order) for r in rows
    )


def compare(spark_result, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """Differences, none if the results agree."""
    reply = con.execute(sql)
    names = [d[0] for d in reply.description]
    types = {d[0]: str(d[1]) for d in reply.description}
    theirs = _rows(names, reply.fetchall())
    found = []
    fields = {f.name: f.dataType.simpleString() for f in spark_result.schema.fields}
    if sorted(fields) != sorted(names):
        return [f"columns {sorted(fields)} against {sorted(names)}"]
    for name, kind in fields.items():
        if DUCK_TYPES.get(kind) != types[name]:
            found.append(f"type of {name}: {kind} against {types[name]}")
    ours = _rows(list(fields), [tuple(r) for r in spark_result.collect()])
    if sum(ours.values()) != sum(theirs.values()):
        found.append(f"{sum(ours.values())} rows against {sum(theirs.values())}")
    extra, absent = ours - theirs, theirs - ours
    if extra or absent:
        found.append(f"only here {list(extra)[:3]}, only there {list(absent)[:3]}")
    return found
