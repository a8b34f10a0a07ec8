"""Order-insensitive comparison of a Spark result with a DuckDB result."""

from __future__ import annotations

import math
from collections import Counter

TABLES = (
    "region nation customer supplier part orders lineitem events documents "
    "embeddings pages benchmark labels conversations"
).split()


def connect(sf_dir):
    import duckdb

    con = duckdb.connect()
    con.execute("set timezone='UTC'")
    for t in TABLES:
        con.execute(f"create view {t} as select * from '{sf_dir}/{t}.parquet'")
    return con


def _cell(v):
    if isinstance(v, float):
        return "nan" if math.isnan(v) else round(v, 9)
    return v


def rows(columns, values):
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_cell(r[i]) for i in order) for r in values)


def spark_rows(df):
    return sorted(df.columns), rows(df.columns, df.collect())


def duck_rows(con, sql):
    cur = con.execute(sql)
    columns = [c[0] for c in cur.description]
    return sorted(columns), rows(columns, cur.fetchall())


def duck_types(con, sql):
    names = {
        "BIGINT": "bigint", "INTEGER": "int", "VARCHAR": "string", "DOUBLE": "double",
        "BOOLEAN": "boolean", "DATE": "date", "TIMESTAMP": "timestamp_ntz",
    }
    described = con.execute(f"describe {sql}").fetchall()
    return {r[0]: names.get(r[1], r[1]) for r in described}
