"""Queries of streams with state, of several shards, and of sinks that count a batch once; upserts of bucketed tables."""
from __future__ import annotations

import uuid

from pyspark.sql import functions as F

from lakeforge.plans.base import query, t
from lakeforge.sources import bucketed, sinks
from lakeforge.streaming import audit_stream, marks, once, shards

EVENT = "event_id long, ts timestamp, user_id long, event_type string, value double"


@query("SELECT event_type, user_id % 10 AS u, count(*) AS n, CAST(sum(event_id) AS BIGINT) AS ids FROM events GROUP BY 1, 2")
def stream_shards(spark, d):
    """Events in three shards, of which each repeats some of its own and has some of the next one's."""
    base = sinks.scratch(spark)
    e = t(spark, d, "events").select("event_id", F.col("ts").cast("timestamp").alias("ts"), "user_id", "event_type", "value")
    for k in range(3):
        mine = e.where(F.col("event_id") % 3 == k)
        again = mine.where(F.col("event_id") % 5 == 0).unionByName(e.where((F.col("event_id") % 3 == (k + 1) % 3) & (F.col("event_id") % 7 == 0)))
        mine.unionByName(again).write.json(f"{base}/shard{k}")
    rows = shards.merged_shards(spark, [f"{base}/shard{k}" for k in range(3)], EVENT, "ts", ["event_id"])
    audit_stream.append_stream(rows, f"{base}/out", f"{base}/state", ["shard"]).awaitTermination()
    return spark.read.parquet(f"{base}/out").groupBy("event_type", (F.col("user_id") % 10).alias("u")).agg(F.count("*").alias("n"), F.sum("event_id").alias("ids"))


def stream_watermarks_of(spark, audit):
    """The marks after a stream of all audit rows, in several micro-batches."""
    base = sinks.scratch(spark)
    audit_stream.to_events(audit).select("value").repartition(4).write.text(f"{base}/in")
    events = audit_stream.audit_events(spark.readStream.option("maxFilesPerTrigger", 1).text(f"{base}/in"))
    sink = once.OncePerBatch(f"{base}/marks", "watermarks")
    marks.watermark_stream(events).writeStream.outputMode("update").foreachBatch(sink).option("checkpointLocation", f"{base}/state").trigger(availableNow=True).start().awaitTermination()
    return once.newest(sink.read(spark, f"tablename string, {marks.STATE}"), ["tablename"]).select("tablename", "ingestiondt", *marks.MARKS)


@query("SELECT o_orderkey, o_custkey, CASE WHEN o_orderkey % 5 = 2 THEN o_totalprice + 1 ELSE o_totalprice END AS o_totalprice FROM orders WHERE o_orderkey % 5 <> 3 UNION ALL SELECT o_orderkey + 10000000, o_custkey, o_totalprice FROM orders WHERE o_orderkey % 5 = 4")
def upsert_bucketed(spark, d):
    """A staging table in buckets of its key: changed, deleted and new keys."""
    rows, name, path = t(spark, d, "orders").select("o_orderkey", "o_custkey", "o_totalprice"), f"stage_{uuid.uuid4().hex[:8]}", sinks.scratch(spark)
    bucketed.write_bucketed(rows, name, f"{path}/first", "o_orderkey", 8)
    delta = rows.where("o_orderkey % 5 = 2").withColumn("o_totalprice", F.col("o_totalprice") + 1).unionByName(rows.where("o_orderkey % 5 = 4").withColumn("o_orderkey", F.col("o_orderkey") + 10_000_000))
    bucketed.upsert_bucketed(spark, name, path, delta, "o_orderkey", 8, deleted=rows.where("o_orderkey % 5 = 3"))
    return spark.table(name)
