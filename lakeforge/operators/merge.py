"""Current state from changes: latest rows, hard deletes, upserts, repair of duplicates."""
from __future__ import annotations

from collections.abc import Sequence

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeforge.operators.audit import last_batch, padded


def latest(df: DataFrame, keys: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """The first row of each key in `order`."""
    w = Window.partitionBy(*keys).orderBy(*order)
    return df.withColumn("__n", F.row_number().over(w)).where("__n = 1").drop("__n")


def most_recent(df: DataFrame, keys: Sequence[str], *, typed: bool = False) -> DataFrame:
    """The row of each key with the greatest (uniqueid, uniqueid, batch), as strings; with typed, batch as a number."""
    batch = F.col("batch").cast("decimal(38,0)") if typed else F.col("batch")
    order = [F.desc("uniqueid"), batch.desc()] if typed else [F.array("uniqueid", "uniqueid", "batch").desc()]
    return latest(df, keys, order)


def with_deleted_flag(live: DataFrame, changes: DataFrame | None = None) -> DataFrame:
    """Live rows with flag 0 and, where there is a change table, its deletions with flag 1, by column name."""
    live = live.withColumn("deleted_flag", F.lit(0))
    return live if changes is None else live.unionByName(changes.withColumn("deleted_flag", F.lit(1)), allowMissingColumns=True)


def live_only(df: DataFrame) -> DataFrame:
    return df.where(F.col("deleted_flag") == 0)


def vanished(lake: DataFrame, source_ids: DataFrame, key: str) -> DataFrame:
    """key, ingestiondt, batch of the latest lake row of each key that isn't deleted and that the source lacks.

    Date and batch come from one row: the latest by (ingestiondt, batch), batches as numbers where they are."""
    last = F.max(F.struct("ingestiondt", padded(F.col("batch").cast("string")).alias("order"), "batch", "deleted_flag")).alias("m")
    current = lake.groupBy(key).agg(last).where("m.deleted_flag = 0").select(key, "m.ingestiondt", "m.batch")
    return current.join(source_ids.select(key).distinct(), key, "left_anti")


def tombstones(lake: DataFrame, source_ids: DataFrame, key: str, ingestion_date: str, batch: str) -> DataFrame:
    """The latest lake rows of vanished keys, as deleted rows of a new batch. Lake partitions without one are pruned
    at run time; the vanished keys are broadcast only where Spark finds them small."""
    gone = vanished(lake, source_ids, key)
    rows = lake.join(gone, [key, "ingestiondt", "batch"]).withColumns({"ingestiondt": F.lit(ingestion_date), "batch": F.lit(batch), "deleted_flag": F.lit(1)})
    return rows.select(lake.columns)


def upserted(base: DataFrame, delta: DataFrame, key: str, deleted: DataFrame | None = None) -> DataFrame:
    """base without the keys of delta or of deleted, then delta (without deleted keys)."""
    gone = delta.select(key) if deleted is None else delta.select(key).union(deleted.select(key))
    kept = base.join(gone.distinct(), key, "left_anti")
    new = delta if deleted is None else delta.join(deleted.select(key).distinct(), key, "left_anti")
    return kept.select(base.columns).unionByName(new.select(base.columns))


def touched_partitions(base: DataFrame, delta: DataFrame, key: str, partition: str) -> DataFrame:
    """Partitions that an upsert has to write again: those that hold a key of delta, and those that delta is in."""
    return base.join(delta.select(key).distinct(), key, "left_semi").select(partition).union(delta.select(partition)).distinct()


def duplicates(df: DataFrame, key: str) -> DataFrame:
    """key, n, last_batch of keys with more than one row."""
    return df.groupBy(key).agg(F.count("*").alias("n"), F.max("batch").alias("last_batch")).where("n > 1")


def without_duplicates(df: DataFrame, key: Sequence[str], order: Sequence[Column]) -> DataFrame:
    """One row for each key; none that had no duplicate is lost."""
    return latest(df, key, order)


def staged(df: DataFrame, key: str, ingestion_date: str, batch: str, buckets: int = 10) -> DataFrame:
    """A full staging load: live rows, stamped with the batch, with their bucket, dealt by partition and bucket."""
    rows = live_only(df).drop("deleted_flag").withColumns({"batch": F.lit(batch), "bucket": F.pmod(F.col(key), F.lit(buckets))})
    return rows.repartition("ingestiondt", "bucket")


def kv_items(df: DataFrame, keys: Sequence[str], sort_key: str | None = None, name: str = "kv_key") -> DataFrame:
    """Rows for a key-value store: decimals as doubles, times as strings, the keys joined by `-`, the latest by sort_key."""
    casts = {}
    for f in df.schema:
        kind = f.dataType.simpleString()
        if kind.startswith("decimal"):
            casts[f.name] = F.col(f.name).cast("double")
        elif kind.startswith("timestamp"):
            casts[f.name] = F.date_format(F.col(f.name), "yyyy-MM-dd HH:mm:ss")
    out = df.withColumns(casts | {name: F.concat_ws("-", *(F.col(k).cast("string") for k in keys))})
    return latest(out, [name], [F.desc(sort_key), *(F.desc(c) for c in sorted(df.columns) if c != sort_key)]) if sort_key else out


def seeded(harmonised: DataFrame, key: str, source: str, backup: DataFrame | None = None, full: DataFrame | None = None) -> DataFrame:
    """First staging contents: `backup`, the last full load's batch (`last_full`), or the most recent row of each key. Rows
    that don't tell their load type need the batch of the last full load beside them: full(batch), as of last_batch_like()."""
    if source == "backup":
        return backup
    if source == "last_full":
        last = last_batch(harmonised.where(F.col("load_type") == "tl")) if full is None else full.select("batch")
        return harmonised.join(F.broadcast(last), "batch", "left_semi")
    return most_recent(harmonised, [key])
