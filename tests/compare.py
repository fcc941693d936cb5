"""Compare a Spark result with the rows that DuckDB gives for its SQL counterpart."""

from __future__ import annotations

import glob
import os

import duckdb

TABLES = "/root/testdata/sf0.001"


def connect(folder):
    con = duckdb.connect()
    con.execute("SET TimeZone = 'UTC'")
    for path in glob.glob(f"{folder}/*.parquet"):
        name = os.path.basename(path).removesuffix(".parquet")
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path}'")
    return con


def canonical(names, rows):
    order = sorted(range(len(names)), key=lambda i: names[i])
    plain = [tuple(_plain(row[i]) for i in order) for row in rows]
    return [names[i] for i in order], sorted(plain, key=repr)


def _plain(value):
    return round(value, 6) if isinstance(value, float) else value


def spark_rows(df):
    return canonical(df.columns, [tuple(r) for r in df.collect()])


def oracle_rows(con, sql):
    found = con.execute(sql)
    return canonical([d[0] for d in found.description], found.fetchall())
