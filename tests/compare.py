"""Compare a Spark result with its SQL twin in DuckDB: column names, row count and sorted values."""

from __future__ import annotations

import datetime as dt
import math
from collections import Counter
from decimal import Decimal
from pathlib import Path

import duckdb


def connect(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for path in sorted(Path(sf_dir).glob("*.parquet")):
        con.execute(f"CREATE VIEW {path.stem} AS SELECT * FROM read_parquet('{path}')")
    return con


def _plain(value):
    if isinstance(value, bool) or value is None or isinstance(value, (str, int)):
        return value
    if isinstance(value, Decimal):
        return f"{value:f}"
    if isinstance(value, float):
        return "nan" if math.isnan(value) else repr(value)
    if isinstance(value, (dt.date, dt.datetime)):
        return value.isoformat()
    if isinstance(value, (list, tuple)):
        return tuple(_plain(v) for v in value)
    return str(value)


def rows_of(columns, rows) -> Counter:
    order = sorted(range(len(columns)), key=lambda i: columns[i])
    return Counter(tuple(_plain(row[i]) for i in order) for row in rows)


def differences(df, con: duckdb.DuckDBPyConnection, sql: str, sample: int = 5) -> str:
    """Empty when both sides agree, else a short report."""
    table = df.toArrow()
    spark_names = table.column_names
    spark_rows = rows_of(spark_names, zip(*[c.to_pylist() for c in table.columns])) if table.num_columns else Counter()
    answer = con.execute(sql)
    names = [d[0] for d in answer.description]
    if sorted(names) != sorted(spark_names):
        return f"columns differ: spark {sorted(spark_names)} sql {sorted(names)}"
    sql_rows = rows_of(names, answer.fetchall())
    if spark_rows == sql_rows:
        return ""
    only_spark, only_sql = spark_rows - sql_rows, sql_rows - spark_rows
    return (
        f"rows: spark {sum(spark_rows.values())} sql {sum(sql_rows.values())}; columns {sorted(names)}\n"
        f"only spark ({sum(only_spark.values())}): {sorted(only_spark, key=str)[:sample]}\n"
        f"only sql ({sum(only_sql.values())}): {sorted(only_sql, key=str)[:sample]}"
    )
