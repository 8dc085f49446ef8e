"""Compare a Spark result with DuckDB's, as bags of rows."""

from __future__ import annotations

from collections import Counter

import duckdb

BASE = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()

_SAME = {
    "bigint": "BIGINT",
    "int": "INTEGER",
    "string": "VARCHAR",
    "date": "DATE",
    "timestamp_ntz": "TIMESTAMP",
    "boolean": "BOOLEAN",
    "decimal(15,2)": "DECIMAL(15,2)",
    "double": "DOUBLE",
}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in BASE:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{sf_dir}/{table}.parquet'")
    return con


def differences(df, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    """What differs: names, types, rows. Empty when the results are the same bag."""
    expected = con.execute(sql)
    names = [d[0] for d in expected.description]
    rows = expected.fetchall()
    types = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    found = []
    if sorted(names) != sorted(df.columns):
        return [f"columns {sorted(set(names) ^ set(df.columns))}"]
    for field in df.schema.fields:
        kind = field.dataType.simpleString()
        if _SAME.get(kind) != types[field.name]:
            found.append(f"type of {field.name}: {kind} / {types[field.name]}")
    order = sorted(names)
    want = Counter(tuple(r[names.index(n)] for n in order) for r in rows)
    have = Counter(tuple(r[n] for n in order) for r in df.collect())
    if want != have:
        found.append(
            f"rows {sum(have.values())} / {sum(want.values())}; only in Spark {list((have - want).items())[:2]}; "
            f"only in SQL {list((want - have).items())[:2]}"
        )
    return found
