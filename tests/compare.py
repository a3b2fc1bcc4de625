"""Runs a registered query and its SQL twin and compares schema and rows."""

from __future__ import annotations

import datetime as dt
import decimal
import math
from collections import Counter

import duckdb

TABLES = ("region nation customer supplier part orders lineitem events documents embeddings "
          "pages benchmark labels conversations").split()

# DuckDB type names as Spark writes them.
_TYPES = {"VARCHAR": "string", "INTEGER": "int", "BIGINT": "bigint", "DOUBLE": "double",
          "DATE": "date", "BOOLEAN": "boolean", "TIMESTAMP": "timestamp"}


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(value):
    if isinstance(value, float):
        return "nan" if math.isnan(value) else float(f"{value:.12g}")
    if isinstance(value, (decimal.Decimal, dt.date)):
        return str(value)
    return value


def _bag(names, rows) -> Counter:
    order = sorted(range(len(names)), key=names.__getitem__)
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, con, sql: str) -> list[str]:
    """What is unequal, in words; empty when schema and rows agree."""
    result = con.execute(sql)
    names = [d[0] for d in result.description]
    rows = result.fetchall()
    kinds = {r[0]: r[1] for r in con.execute(f"DESCRIBE {sql}").fetchall()}
    kinds = {n: _TYPES.get(k, k.lower()) for n, k in kinds.items()}
    found = []
    spark_kinds = {f.name: f.dataType.simpleString() for f in df.schema}
    if spark_kinds != kinds:
        found.append(f"schema: {sorted(spark_kinds.items() ^ kinds.items())}")
    spark_rows = df.collect()
    ours, theirs = _bag(df.columns, spark_rows), _bag(names, rows)
    if ours != theirs:
        extra, absent = list((ours - theirs).items()), list((theirs - ours).items())
        found.append(f"rows: {len(spark_rows)} against {len(rows)}; {len(extra)} extra "
                     f"{extra[:3]}; {len(absent)} absent {absent[:3]}")
    return found
