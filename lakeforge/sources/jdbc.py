"""JDBC sources: options for a ranged, pushed-down read."""
from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession

from lakeforge.operators.cdc import partition_count

#: Database kind -> (driver class, URL form).
DATABASES = {
    "sqlserver": ("com.microsoft.sqlserver.jdbc.SQLServerDriver", "jdbc:sqlserver://{host}:{port};databaseName={database}"),
    "netezza": ("org.netezza.Driver", "jdbc:netezza://{host}:{port}/{database}"),
    "mysql": ("com.mysql.cj.jdbc.Driver", "jdbc:mysql://{host}:{port}/{database}"),
}


def connection(kind: str, host: str, port: int, database: str, user: str, password: Callable[[], str]) -> dict[str, str]:
    """Reader options; the password comes from a function, such as one that asks a secret store."""
    driver, url = DATABASES[kind.lower()]
    return {"driver": driver, "url": url.format(host=host, port=port, database=database), "user": user, "password": password()}


def reference_connection(main: dict[str, str], own: dict[str, str] | None) -> dict[str, str]:
    """The reference tables' connection; the main one where they have none."""
    return own or main


def ranged(options: dict[str, str], query: str, column: str | None, low=None, high=None, partitions: int | None = None) -> dict[str, str]:
    """Options of a read of a sub-query, in ranges of a column where its bounds are numbers or instants. Without bounds
    for a column this raises, rather than reading in one piece."""
    out = options | {"dbtable": f"({query}) q"}
    if column is None:
        return out
    if low is None or high is None:
        raise ValueError(f"no bounds for {column}")
    return out | {"partitionColumn": column, "lowerBound": str(low), "upperBound": str(high), "numPartitions": str(partition_count(low, high, partitions))}


def read(spark: SparkSession, options: dict[str, str]) -> DataFrame:
    return spark.read.format("jdbc").options(**options).load()
