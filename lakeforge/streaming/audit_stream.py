"""Audit events as a stream, and loads as micro-batches."""
from __future__ import annotations

import time
from collections.abc import Callable
from datetime import datetime

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeforge.operators.audit import AUDIT


def audit_events(raw: DataFrame, schema: T.StructType = AUDIT, column: str = "value") -> DataFrame:
    """Audit rows from JSON texts; a field that an event lacks is null, a text that isn't JSON gives no row."""
    return raw.select(F.from_json(column, schema).alias("e")).where("e is not null and e.batch is not null").select("e.*")


def to_events(audit: DataFrame, key: str = "processname") -> DataFrame:
    """key and value (JSON) for a stream; nulls are left out."""
    return audit.select(F.col(key).alias("key"), F.to_json(F.struct(*(c for c in audit.columns if c != key))).alias("value"))


def append_stream(events: DataFrame, path: str, checkpoint: str, by: list[str], *, available_now: bool = True, interval: str = "60 seconds"):
    """Appends each micro-batch once: the file sink keeps a log of the batches that it has written."""
    writer = events.writeStream.format("parquet").option("path", path).option("checkpointLocation", checkpoint).partitionBy(*by).outputMode("append")
    return (writer.trigger(availableNow=True) if available_now else writer.trigger(processingTime=interval)).start()


def upsert_stream(changes: DataFrame, apply: Callable[[DataFrame, int], None], checkpoint: str):
    """Hands each micro-batch to apply(rows, batch number); apply must give the same for the same number again."""
    return changes.writeStream.foreachBatch(apply).option("checkpointLocation", checkpoint).trigger(availableNow=True).start()


def text_stream(spark: SparkSession, path: str) -> DataFrame:
    return spark.readStream.text(path)


def continuous(load: Callable[[DataFrame | None], DataFrame], clock: Callable[[], datetime], until: datetime, *, pause: float = 300, sleep: Callable[[float], None] = time.sleep, once: bool = False) -> DataFrame | None:
    """Loads again and again until an instant, at least `pause` seconds from start to start. Each load gets the audit
    rows of the one before, so that it needn't read them back. With once, a single load."""
    audit = None
    while True:
        began = clock()
        audit = load(audit)
        if once or clock() >= until:
            return audit
        sleep(max(0.0, pause - (clock() - began).total_seconds()))


def wait_for(clock: Callable[[], datetime], past: datetime, *, tries: int = 20, pause: float = 30, sleep: Callable[[float], None] = time.sleep) -> datetime:
    """The source's clock once it has passed the last window's end; raises when it doesn't within the tries."""
    for _ in range(tries):
        now = clock()
        if now > past:
            return now
        sleep(pause)
    raise TimeoutError(f"the source's clock hasn't passed {past}")
