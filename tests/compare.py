"""Compare a Spark result with a DuckDB result: columns, types, row count and every value."""

from __future__ import annotations

import duckdb
from pyspark.sql import DataFrame

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels "
    "conversations"
).split()

_TYPES = {
    "int": "INTEGER",
    "bigint": "BIGINT",
    "double": "DOUBLE",
    "string": "VARCHAR",
    "boolean": "BOOLEAN",
    "timestamp_ntz": "TIMESTAMP",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _lines(rows: list, names: list[str], wanted: list[str]) -> list[tuple[str, ...]]:
    at = [names.index(name) for name in wanted]
    return sorted(tuple(repr(row[i]) for i in at) for row in rows)


def differences(result: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs, as text; empty when the results are the same."""
    answer = con.execute(sql)
    names = [d[0] for d in answer.description]
    expected = answer.fetchall()
    found: list[str] = []
    if sorted(result.columns) != sorted(names):
        return [f"columns {sorted(set(result.columns) ^ set(names))}"]
    types = {row[0]: row[1] for row in con.execute(f"DESCRIBE {sql}").fetchall()}
    for name, kind in result.dtypes:
        if _TYPES.get(kind) != types[name]:
            found.append(f"type of {name}: {kind} and {types[name]}")
    wanted = sorted(names)
    ours = _lines([tuple(r) for r in result.collect()], result.columns, wanted)
    theirs = _lines(expected, names, wanted)
    if len(ours) != len(theirs):
        found.append(f"rows: {len(ours)} and {len(theirs)}")
    different = [(a, b) for a, b in zip(ours, theirs) if a != b]
    if different:
        a, b = different[0]
        cells = {n: (x, y) for n, x, y in zip(wanted, a, b) if x != y}
        found.append(f"{len(different)} rows differ, first {cells}")
    return found
