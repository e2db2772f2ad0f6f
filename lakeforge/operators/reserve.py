"""Monthly reserve load: row numbers continued, the month before expired, statistics of the run."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeforge.operators.durable import durable


def numbered(new: DataFrame, old: DataFrame, order: list[Column], bucket: Column, number: str = "row_id") -> DataFrame:
    """new with row numbers that go on from old's greatest one, by bucket and order. Rows are dealt to tasks by ranges of
    both, each task numbers its own, and starts after those before it: no task sorts a bucket. The number of rows of each
    task is all that reaches the driver. The dealt rows are kept (spark.checkpoint.dir), as both passes must see the same."""
    last = old.agg(F.coalesce(F.max(number), F.lit(0)).cast("long")).first()[0]
    by = [F.col("__b").asc_nulls_first(), *order]
    dealt = new.withColumn("__b", bucket).repartitionByRange(*by).sortWithinPartitions(*by)
    rows = durable(dealt.select("*", F.monotonically_increasing_id().alias("__id")))
    task, place = F.shiftright("__id", 33), F.col("__id").bitwiseAND(F.lit((1 << 33) - 1))
    sizes = {r["task"]: r["n"] for r in rows.groupBy(task.alias("task")).agg(F.count("*").alias("n")).collect()}
    starts, at = {}, last
    for k in sorted(sizes):
        starts[k], at = at, at + sizes[k]
    start = F.element_at(F.create_map(*(F.lit(x) for kv in starts.items() for x in kv)), task) if starts else F.lit(0)
    return rows.withColumn(number, (start + place + 1).cast("long")).drop("__b", "__id")


def expired(old: DataFrame, on: Column) -> DataFrame:
    """old with the open rows' expiration date set."""
    return old.withColumn("expiration_date", F.coalesce("expiration_date", on))


def run_statistics(run: str, source: DataFrame, target: DataFrame) -> DataFrame:
    s, t = source.agg(F.count("*").alias("source_count")), target.agg(F.count("*").alias("target_count"))
    return s.join(F.broadcast(t)).select(F.lit(run).alias("run_name"), "source_count", "target_count", (F.col("source_count") == F.col("target_count")).alias("matches"))
