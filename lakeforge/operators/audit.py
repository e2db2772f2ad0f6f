"""Audit rows, watermarks, restarts and the gate before deletions."""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

text = lambda *names: [T.StructField(n, T.StringType()) for n in names]
AUDIT = T.StructType(
    [*text("ingestiondt", "batch", "tablename"), T.StructField("sourcecount", T.LongType()), *text("loadstarttime", "loadendtime", "loadstatus", "exception", "batchwindowstart", "batchwindowend", "querystring", "loadtype", "batchstarttime"),
     T.StructField("targetcount", T.LongType()), *text("harddeletebatch")]
)
BATCH_STATS = T.StructType(text("processname", "ingestiondt", "batch", "batchstarttime", "batchwindowstart", "batchwindowend", "harddeletebatch"))
MISSING_AUDIT = T.StructType(text("processname", "tablename", "missingids", "cutoffvalue", "ingestiondt", "batch", "loadtime", "insertind", "missingdatabatch"))


def padded(c: Column, width: int = 15) -> Column:
    """Numbers as texts that order like numbers; other texts unchanged."""
    return F.when(c.rlike(r"^\d+$"), F.lpad(c, width, "0")).otherwise(c)


def unpadded(c: Column) -> Column:
    return F.when(c.rlike(r"^\d+$"), F.coalesce(F.nullif(F.ltrim(c, F.lit("0")), F.lit("")), F.lit("0"))).otherwise(c)


def last_batch(rows: DataFrame) -> DataFrame:
    """One row with the greatest batch, as a number where it is one."""
    return rows.agg(F.max_by("batch", padded(F.col("batch").cast("string"))).alias("batch"))


def last_batch_like(audit: DataFrame, pattern: str) -> DataFrame:
    """One row with the greatest batch of the tables whose name is like a pattern: names may tell full loads (`%t`)."""
    return last_batch(audit.where(F.col("tablename").like(pattern)))


def watermarks(audit: DataFrame, process: str | None = None) -> DataFrame:
    """The high-water marks of each table: greatest date, batch and window ends of its loads, but for delete batches,
    empty windows (the text `null`) and loads that ended in an unknown state."""
    rows = audit.where((F.coalesce("harddeletebatch", F.lit("n")) != "y") & (F.coalesce("loadstatus", F.lit("")) != "failedUnknown") & F.col("batchwindowend").isNotNull() & (F.col("batchwindowend") != "null"))
    if process is not None:
        rows = rows.where(F.col("processname") == process)
    marks = [unpadded(F.max(padded(F.col(c)))).alias(c) for c in ("batch", "batchwindowstart", "batchwindowend")]
    return rows.groupBy("tablename").agg(F.max("ingestiondt").alias("ingestiondt"), *marks)


def loggable(rows: DataFrame) -> DataFrame:
    """Audit rows to append: those with a window end."""
    return rows.where(F.col("batchwindowend").isNotNull())


def failed_tables(audit: DataFrame, identifier: str = "failed") -> DataFrame:
    """Tables with that status on the latest day."""
    day = audit.agg(F.max("ingestiondt").alias("ingestiondt"))
    return audit.join(F.broadcast(day), "ingestiondt", "left_semi").where(F.col("loadstatus") == identifier).select("tablename").distinct()


def latest_batch_tables(audit: DataFrame) -> DataFrame:
    """Tables that the latest batch has reached."""
    return audit.join(F.broadcast(last_batch(audit)), "batch", "left_semi").select("tablename").distinct()


def tables_to_run(tables: DataFrame, audit: DataFrame, restart: bool, level: str = "table") -> DataFrame:
    """All tables; on a restart the failed ones (level table), or those that the latest batch hasn't reached (batch)."""
    if not restart:
        return tables
    if level == "table":
        return tables.join(failed_tables(audit), "tablename", "left_semi")
    return tables.join(latest_batch_tables(audit), "tablename", "left_anti")


def latest_by_table(audit: DataFrame) -> DataFrame:
    w = Window.partitionBy("tablename").orderBy(padded(F.col("batch").cast("string")).desc(), F.desc("loadendtime"), F.desc("loadstatus"))
    return audit.withColumn("n", F.row_number().over(w)).where("n = 1").drop("n")


def delete_gate(audit: DataFrame) -> DataFrame:
    """One row blocked: how many tables of the latest batch didn't end in success; deletions run only at 0."""
    rows = latest_by_table(audit).join(F.broadcast(last_batch(audit)), "batch", "left_semi")
    return rows.agg(F.count(F.when(~F.col("loadstatus").eqNullSafe("success"), 1)).alias("blocked"))


def batch_stats(audit: DataFrame) -> DataFrame:
    """One row for each process and batch."""
    return audit.groupBy("processname", "ingestiondt", "batch").agg(
        F.min("batchstarttime").alias("batchstarttime"), F.min("batchwindowstart").alias("batchwindowstart"), F.max("batchwindowend").alias("batchwindowend"), F.max("harddeletebatch").alias("harddeletebatch")
    )


def gate_passes(audit: DataFrame) -> bool:
    return delete_gate(audit).first()["blocked"] == 0
