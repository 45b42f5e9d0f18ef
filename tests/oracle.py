"""Compare a Spark result with DuckDB's, as multisets of rows with columns sorted by name."""

from __future__ import annotations

import decimal
import math
from collections import Counter
from pathlib import Path

import duckdb

TABLES = ("region", "nation", "customer", "supplier", "part", "orders", "lineitem")


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.sql(f"CREATE VIEW {name} AS SELECT * FROM '{Path(folder) / name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, decimal.Decimal):
        return float(value)
    if isinstance(value, float) and math.isnan(value):
        return None
    return value


def rows_by_name(names, rows) -> Counter:
    places = sorted(range(len(names)), key=lambda i: names[i])
    return Counter(tuple(_plain(row[i]) for i in places) for row in rows)


_DUCK_TYPES = {
    "string": "VARCHAR", "bigint": "BIGINT", "int": "INTEGER", "double": "DOUBLE",
    "boolean": "BOOLEAN", "date": "DATE",
}


def differences(spark_df, con, sql: str) -> list[str]:
    relation = con.sql(sql)
    found = []
    if sorted(spark_df.columns) != sorted(relation.columns):
        return [f"columns: {sorted(spark_df.columns)} / {sorted(relation.columns)}"]
    duck_types = dict(zip(relation.columns, map(str, relation.types)))
    for name, kind in spark_df.dtypes:
        expected = _DUCK_TYPES.get(kind, kind.upper())
        if expected != duck_types[name].replace(" ", ""):
            found.append(f"type of {name}: {kind} / {duck_types[name]}")
    ours = rows_by_name(spark_df.columns, [tuple(r) for r in spark_df.collect()])
    theirs = rows_by_name(relation.columns, relation.fetchall())
    if ours != theirs:
        found.append(
            f"rows: {sum(ours.values())} / {sum(theirs.values())}; "
            f"only ours {list((ours - theirs).items())[:3]}; only theirs {list((theirs - ours).items())[:3]}")
    return found
