"""Compare a Spark result with the SQL result of another engine, value by value."""

from __future__ import annotations

import datetime as dt
import decimal
import math

TABLES = (
    "region nation customer supplier part orders lineitem events documents embeddings pages "
    "benchmark labels conversations"
).split()


def connect(sf_dir: str):
    import duckdb

    con = duckdb.connect()
    for name in TABLES:
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{sf_dir}/{name}.parquet'")
    return con


def _plain(v):
    if isinstance(v, decimal.Decimal):
        v = float(v)
    if isinstance(v, float):
        return "NaN" if math.isnan(v) else repr(v + 0.0)
    if isinstance(v, dt.datetime):
        return v.replace(tzinfo=None).isoformat()
    return repr(v)


def canonical(columns: list[str], rows) -> list[tuple]:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return sorted(tuple(_plain(r[i]) for i in order) for r in rows)


def differences(spark_df, con, sql: str) -> list[str]:
    """Empty when both results hold the same columns, types of numbers and values."""
    spark_rows = spark_df.collect()
    cursor = con.execute(sql)
    names = [c[0] for c in cursor.description]
    oracle_rows = cursor.fetchall()
    problems = []
    if sorted(names) != sorted(spark_df.columns):
        return [f"columns {sorted(spark_df.columns)} != {sorted(names)}"]
    if len(spark_rows) != len(oracle_rows):
        problems.append(f"rows {len(spark_rows)} != {len(oracle_rows)}")
    ours, theirs = canonical(spark_df.columns, spark_rows), canonical(names, oracle_rows)
    if ours != theirs:
        only_ours = [r for r in ours if r not in set(theirs)][:3]
        only_theirs = [r for r in theirs if r not in set(ours)][:3]
        problems.append(f"{sorted(names)}\n  ours only   {only_ours}\n  theirs only {only_theirs}")
    return problems
