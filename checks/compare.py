"""Local Spark-versus-DuckDB comparison (same idea as the driver's check:
column names, row count, and the order-insensitive multiset of values)."""

from __future__ import annotations

import decimal
from collections import Counter

import duckdb
from pyspark.sql import DataFrame

from tillroll.sources.standins import DRIVER_TABLES

EXTRA_TABLES = ("documents", "embeddings", "pages", "benchmark", "labels", "conversations")


def duckdb_connection(sf_dir: str) -> duckdb.DuckDBPyConnection:
    con = duckdb.connect()
    for t in DRIVER_TABLES:
        con.execute(f"CREATE VIEW {t} AS SELECT * FROM read_parquet('{sf_dir}/{t}.parquet')")
    return con


def _norm(v):
    if isinstance(v, decimal.Decimal):
        return ("dec", v.normalize() if v == v else v)
    if isinstance(v, float):
        return ("dec", decimal.Decimal(repr(v)).normalize())
    if isinstance(v, int) and not isinstance(v, bool):
        return ("dec", decimal.Decimal(v).normalize())
    return ("v", v)


def compare(df: DataFrame, con: duckdb.DuckDBPyConnection, sql: str) -> dict:
    spark_cols = df.columns
    spark_rows = [tuple(r) for r in df.collect()]
    cur = con.execute(sql)
    duck_cols = [d[0] for d in cur.description]
    duck_rows = cur.fetchall()
    res = {
        "columns_match": sorted(spark_cols) == sorted(duck_cols),
        "spark_rows": len(spark_rows),
        "oracle_rows": len(duck_rows),
    }
    if res["columns_match"]:
        order = [duck_cols.index(c) for c in spark_cols]
        a = Counter(tuple(_norm(v) for v in r) for r in spark_rows)
        b = Counter(tuple(_norm(r[i]) for i in order) for r in duck_rows)
        res["values_match"] = a == b
        if a != b:
            res["only_spark"] = list((a - b).elements())[:3]
            res["only_oracle"] = list((b - a).elements())[:3]
    else:
        res["values_match"] = False
        res["spark_cols"] = spark_cols
        res["oracle_cols"] = duck_cols
    res["ok"] = res["columns_match"] and res["values_match"] and res["spark_rows"] == res["oracle_rows"]
    return res
