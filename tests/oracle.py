"""Compare registered queries with their SQL: rows, column names, values."""

from __future__ import annotations

import math
import time
from collections import Counter

import duckdb

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations"
).split()


def connect(folder: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for table in TABLES:
        con.execute(f"CREATE VIEW {table} AS SELECT * FROM '{folder}/{table}.parquet'")
    return con


def cell(value):
    if isinstance(value, float):
        return None if math.isnan(value) else float(f"{value:.9g}")
    return value


def differences(spark, plan, sql: str, folder: str, con) -> tuple[str, float]:
    """Empty text when equal, and the seconds the Spark side took."""
    started = time.time()
    df = plan(spark, folder)
    names = sorted(df.columns)
    rows = df.select(*names).collect()
    took = time.time() - started
    answer = con.execute(sql)
    found = [d[0] for d in answer.description]
    if sorted(found) != names:
        return f"columns {names} and {sorted(found)}", took
    order = [found.index(n) for n in names]
    kinds = {n: (str(answer.description[found.index(n)][1]), dict(df.dtypes)[n]) for n in names}
    left = Counter(tuple(cell(v) for v in row) for row in rows)
    right = Counter(tuple(cell(row[i]) for i in order) for row in answer.fetchall())
    loose = [f"{n}: {a} / {b}" for n, (a, b) in kinds.items() if not alike(a, b)]
    if left == right:
        return ("types " + "; ".join(loose)) if loose else "", took
    return f"{sum(left.values())}/{sum(right.values())} rows; {list((left - right))[:3]} / {list((right - left))[:3]}", took


def alike(duck: str, spark: str) -> bool:
    same = {
        "bigint": "BIGINT",
        "int": "INTEGER",
        "string": "VARCHAR",
        "double": "DOUBLE",
        "boolean": "BOOLEAN",
    }
    return duck == same.get(spark, duck) or (duck, spark) == ("NUMBER", "bigint")
