"""What the modules of queries share: the registry and a few helpers."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}
AS_OF = "1996-06-14 23:59:59.999"


def query(sql: str | None = None):
    def add(f):
        QUERIES[f.__name__] = f
        if sql is not None:
            ORACLES[f.__name__] = sql
        return f

    return add


def t(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def at(text: str) -> Column:
    """A literal instant without time zone."""
    return F.expr(f"TIMESTAMP_NTZ'{text}'")


def shaped(spark: SparkSession, sf_dir: str, shapes: dict[str, tuple[str, dict[str, str], str]]) -> dict[str, DataFrame]:
    """Tables in a system's own shape, by name, each made of one of the given tables: (table, columns in SQL, where)."""
    return {name: t(spark, sf_dir, source).where(where).selectExpr(*(f"{e} AS {c}" for c, e in columns.items())) for name, (source, columns, where) in shapes.items()}


def shaped_sql(shapes: dict[str, tuple[str, dict[str, str], str]]) -> str:
    """The same tables as a list of common table expressions for DuckDB."""
    return ",\n".join(f"{name} AS (SELECT {', '.join(f'{e} AS {c}' for c, e in columns.items())} FROM {source} WHERE {where})" for name, (source, columns, where) in shapes.items())
