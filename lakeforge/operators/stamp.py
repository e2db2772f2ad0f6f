"""System columns of a harmonised table."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


def epoch_seconds(c: Column) -> Column:
    """Whole seconds since 1970 (rounded down) of a timestamp without time zone, whatever the session's zone."""
    return F.floor(F.timestamp_diff("MICROSECOND", F.expr("TIMESTAMP_NTZ'1970-01-01 00:00:00'"), c) / F.lit(1000000)).cast("long")


def month_of(c: Column) -> Column:
    """First day of the value's month, as yyyy-MM-dd; a calendar year, never a week year."""
    return F.date_format(F.trunc(c.cast("date"), "MM"), "yyyy-MM-dd")


def with_batch(df: DataFrame, ingestion_date: str, batch: str) -> DataFrame:
    return df.withColumns({"ingestiondt": F.lit(ingestion_date), "batch": F.lit(batch)})


def with_month_and_uid(df: DataFrame, cdc: str, key: str) -> DataFrame:
    """ingestiondt from the CDC value's month, uniqueid from its seconds and the key."""
    return df.withColumns({"ingestiondt": month_of(F.col(cdc)), "uniqueid": F.concat(epoch_seconds(F.col(cdc)).cast("string"), F.col(key).cast("string"))})


def with_bucket(df: DataFrame, key: str, buckets: int = 10) -> DataFrame:
    """bucket = key modulo buckets, never negative."""
    return df.withColumn("bucket", F.pmod(F.col(key).cast("long"), F.lit(buckets)))


def without_operational(df: DataFrame) -> DataFrame:
    """Drops the source's own columns, which have a $ in their names."""
    return df.select(*(F.col(f"`{c}`") for c in df.columns if "$" not in c))


def plain_names(df: DataFrame) -> DataFrame:
    """Column names without dots and spaces."""
    return df.toDF(*(c.replace(".", "").replace(" ", "") for c in df.columns))


def restamped(df: DataFrame, ingestion_date: str, batch: str) -> DataFrame:
    """Rows as tombstones of a new batch."""
    return with_batch(df, ingestion_date, batch).withColumn("deleted_flag", F.lit(1))


def months_times_two(df: DataFrame, cdc: str) -> DataFrame:
    """One row: how many write partitions a load by month wants."""
    return df.agg((F.countDistinct(month_of(F.col(cdc))) * 2).alias("partitions"))
