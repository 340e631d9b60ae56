"""Compare a Spark result with the same query in DuckDB: names, types and all values."""

from __future__ import annotations

from pathlib import Path

import duckdb
from pyspark.sql import DataFrame

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"

# Spark type name to the DuckDB types that hold the same values.
SAME_TYPE = {
    "integer": {"INTEGER"},
    "long": {"BIGINT", "HUGEINT"},
    "double": {"DOUBLE"},
    "string": {"VARCHAR"},
    "date": {"DATE"},
}


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES.split():
        if Path(f"{folder}/{name}.parquet").exists():
            con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{folder}/{name}.parquet'")
    return con


def differences(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> list[str]:
    names = sorted(df.columns)
    result = con.sql(sql)
    if sorted(result.columns) != names:
        return [f"columns {names} / {sorted(result.columns)}"]
    out = []
    types = dict(zip(result.columns, (str(t) for t in result.types)))
    for f in df.schema:
        if types[f.name] not in SAME_TYPE.get(f.dataType.typeName(), set()):
            out.append(f"type of {f.name}: {f.dataType.simpleString()} / {types[f.name]}")
    left = [tuple(r) for r in df.select(*names).collect()]
    right = con.sql(f"SELECT {', '.join(chr(34) + n + chr(34) for n in names)} FROM ({sql}) AS q").fetchall()
    if len(left) != len(right):
        out.append(f"rows {len(left)} / {len(right)}")

    def order(row):
        return tuple((v is not None, v if v is not None else 0) for v in row)

    def text(row):
        return tuple(repr(v) for v in row)

    a, b = {}, {}
    for rows, counts in ((left, a), (right, b)):
        for r in rows:
            counts[text(r)] = counts.get(text(r), 0) + 1
    extra = [k for k in a if a[k] != b.get(k, 0)]
    lacking = [k for k in b if b[k] != a.get(k, 0)]
    if extra or lacking:
        out.append(f"{len(extra)} / {len(lacking)} rows differ; {names} {sorted(extra)[:2]} / {sorted(lacking)[:2]}")
    return out
