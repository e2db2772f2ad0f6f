"""Catalog tables in buckets of a key, so that an upsert doesn't shuffle them."""
from __future__ import annotations

import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def write_bucketed(df: DataFrame, table: str, path: str, key: str, buckets: int) -> None:
    """A new catalog table at path, in files of one bucket each."""
    df.repartition(buckets, key).write.bucketBy(buckets, key).sortBy(key).option("path", path).mode("overwrite").saveAsTable(table)


def changed_rows(base: DataFrame, delta: DataFrame, key: str, deleted: DataFrame | None = None) -> DataFrame:
    """base with delta's rows in the place of those with their keys and without deleted keys, as joins by key alone: where
    base is bucketed, only delta and deleted are shuffled, and the rows stay in their buckets. A key is in delta once; rows
    with a null key stay, as do delta's."""
    if deleted is not None:  # before the outer join, as its rows are no longer known to be in their buckets
        gone = deleted.select(key).where(F.col(key).isNotNull()).distinct()
        base, delta = (x.join(gone, key, "left_anti").select(base.columns) for x in (base, delta))
    old, new = base.select(key, F.struct(*base.columns).alias("old")), delta.select(key, F.struct(*base.columns).alias("new"))
    return old.join(new, key, "full_outer").select(F.coalesce("new", "old").alias("row")).select("row.*")


def upsert_bucketed(spark: SparkSession, table: str, path: str, delta: DataFrame, key: str, buckets: int, *, deleted: DataFrame | None = None) -> DataFrame:
    """Writes the table's next state to a new folder below path, bucket by bucket, and then points the table to it, which
    is the one step that counts; returns the rows that were written, for their plan. What it pointed to before stays."""
    rows = changed_rows(spark.table(table), delta, key, deleted)
    aside = f"{table}__{uuid.uuid4().hex[:8]}"
    to = f"{path.rstrip('/')}/{uuid.uuid4().hex}"
    rows.write.bucketBy(buckets, key).sortBy(key).option("path", to).mode("overwrite").saveAsTable(aside)
    spark.sql(f"ALTER TABLE {table} SET LOCATION '{to}'")
    spark.catalog.refreshTable(table)
    spark.sql(f"DROP TABLE {aside}")  # the files stay, as the table isn't a managed one
    return rows
