"""Several streams of one kind of events as one."""
from __future__ import annotations

from collections.abc import Sequence
from functools import reduce

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F


def merged_shards(spark: SparkSession, paths: Sequence[str], schema: str, at: str, keys: Sequence[str], *, delay: str = "1 hour", policy: str = "min", files_a_batch: int | None = None) -> DataFrame:
    """The events (JSON lines) of all shards, each event once, told by its keys.

    policy says how the shards' watermarks make one: with `min` the slowest shard decides, so that one that lags loses
    nothing and the state waits for it; with `max` the fastest does, and what lags by more than `delay` is dropped. An event
    that a shard repeats, or two shards have, counts once if the copies are no further apart than `delay`. The policy is
    set in a session of its own, not in the caller's; the query runs in that session. Events without an instant are dropped,
    as they would never leave the state."""
    if policy not in ("min", "max"):
        raise ValueError(f"{policy} isn't min or max")
    own = spark.newSession()
    own.conf.set("spark.sql.streaming.multipleWatermarkPolicy", policy)
    own.conf.set("spark.sql.session.timeZone", spark.conf.get("spark.sql.session.timeZone"))

    def one(number: int, path: str) -> DataFrame:
        reader = own.readStream.schema(schema)
        reader = reader if files_a_batch is None else reader.option("maxFilesPerTrigger", files_a_batch)
        return reader.json(path).where(F.col(at).isNotNull()).withColumn("shard", F.lit(number)).withWatermark(at, delay)

    return reduce(DataFrame.unionByName, (one(k, p) for k, p in enumerate(paths))).dropDuplicatesWithinWatermark(list(keys))
