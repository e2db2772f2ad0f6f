"""Rows of a query and of its SQL in DuckDB, in a form that can be compared."""
import os

import duckdb

TABLES = "region nation customer supplier part orders lineitem events documents embeddings pages benchmark labels conversations".split()


def connect(sf_dir):
    con = duckdb.connect()
    for name in TABLES:
        path = f"{sf_dir}/{name}.parquet"
        con.execute(f"CREATE VIEW {name} AS SELECT * FROM '{path + '/*.parquet' if os.path.isdir(path) else path}'")
    return con


def sql_rows(con, sql):
    out = con.sql(sql)
    names = sorted(out.columns)
    return names, sorted(map(repr, out.select(*(f'"{n}"' for n in names)).fetchall()))


def spark_rows(df):
    names = sorted(df.columns)
    return names, sorted(repr(tuple(r)) for r in df.select(*(f"`{n}`" for n in names)).collect())
