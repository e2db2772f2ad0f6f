"""Sinks: partitioned tables, checked writes, upserts of partitions, snapshots, key-value stores, reports."""
from __future__ import annotations

import html
import tempfile
import time
import uuid
from collections.abc import Callable, Iterable, Sequence
from typing import Protocol

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F


def scratch(spark: SparkSession) -> str:
    """A new folder under the one that the cluster shares (spark.checkpoint.dir); a local one only where it names none and
    all of the session runs on this machine."""
    shared = spark.conf.get("spark.checkpoint.dir", None)
    if not shared and not spark.sparkContext.master.startswith("local["):
        raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
    return f"{shared.rstrip('/')}/{uuid.uuid4().hex}" if shared else tempfile.mkdtemp(prefix="lakeforge-")


def save_mode(load_type: str, restart: bool) -> str:
    return "overwrite" if load_type == "tl" or restart else "append"


def write_partitioned(df: DataFrame, path: str, by: Sequence[str], mode: str = "append", *, dynamic: bool = False, max_records: int = 0) -> None:
    """Parquet by partition. With dynamic, an overwrite replaces only the partitions it writes; that is set for this
    write alone, not for the session."""
    writer = df.write.mode(mode).partitionBy(*by)
    if dynamic:
        writer = writer.option("partitionOverwriteMode", "dynamic")
    if max_records:
        writer = writer.option("maxRecordsPerFile", max_records)
    writer.parquet(path)


def counted_write(df: DataFrame, path: str, by: Sequence[str], mode: str = "append", *, batch: str | None = None) -> tuple[int, int]:
    """(rows sent, rows of those batches now there): the first, and which batches there are, seen during the write, so df is
    computed once. Only those batches' partitions are read back; their names are all that reaches the driver."""
    seen = Observation()
    own = F.collect_set("batch") if batch is None else F.array(F.first(F.lit(batch)))
    write_partitioned(df.observe(seen, F.count("*").alias("n"), own.alias("batches")), path, by, mode)
    there = df.sparkSession.read.schema(df.schema).parquet(path).where(F.col("batch").isin(list(seen.get["batches"])))
    return seen.get["n"], there.count()


def drop_batch(spark: SparkSession, path: str, batch: str) -> None:
    """Removes a batch's partitions, wherever below the table's folder they are; a table that isn't there is left alone."""
    fs, where = filesystem(spark, path)
    name = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString("batch", batch)
    for pattern in (name, f"*/{name}"):
        for found in fs.globStatus(spark._jvm.org.apache.hadoop.fs.Path(where, pattern)) or ():
            fs.delete(found.getPath(), True)


def write_with_retry(write: Callable[[], tuple[int, int]], retries: int = 1) -> str:
    """success, failed (counts differ) or failedUnknown (an exception), after at most one more try."""
    status = "failed"
    for _ in range(retries + 1):
        try:
            sent, there = write()
            status = "success" if sent == there else "failed"
        except Exception:  # noqa: BLE001  the status is what the audit keeps
            status = "failedUnknown"
        if status == "success":
            break
    return status


def upsert_partitions(spark: SparkSession, path: str, delta: DataFrame, key: str, partition: str, *, deleted: DataFrame | None = None) -> None:
    """Upsert into a partitioned Parquet table: only partitions that hold a touched key are read whole and written
    again, beside the table, and then moved into it; those that are left without a row go. The keys are looked for in a scan
    of key and partition alone; the partitions' names are all that reaches the driver. Each partition is replaced at once,
    the table isn't: where all of it must change together, use versioned.VersionedTable."""
    from lakeforge.operators.merge import touched_partitions, upserted

    base = spark.read.parquet(path)
    gone = delta.select(key, partition) if deleted is None else delta.select(key, partition).unionByName(base.join(deleted.select(key), key, "left_semi").select(key, partition))
    touched = [r[0] for r in touched_partitions(base.select(key, partition), gone, key, partition).collect()]
    name = F.col(partition)
    held = name.isin([x for x in touched if x is not None]) | name.isNull() if None in touched else name.isin(touched)
    aside = f"{path.rstrip('/')}__{uuid.uuid4().hex}"
    new = upserted(base.where(held), delta, key, deleted)
    write_partitioned(new.repartition(partition, F.pmod(F.xxhash64(key), F.lit(8))), aside, [partition], "overwrite")
    move_partitions(spark, path, aside, partition, touched)


def move_partitions(spark: SparkSession, path: str, aside: str, partition: str, touched: Iterable) -> None:
    """The copy's partitions take the place of the table's, by renames; of the touched ones, those that it lacks go."""
    fs, there = filesystem(spark, path)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    folder = spark._jvm.org.apache.spark.sql.catalyst.catalog.ExternalCatalogUtils.getPartitionPathString
    names = {folder(partition, None if x is None else str(x)) for x in touched}
    new = {s.getPath().getName() for s in fs.listStatus(hadoop(aside)) if s.isDirectory()}
    for name in sorted(names | new):
        to = hadoop(there, name)
        fs.delete(to, True)
        if name in new and not fs.rename(hadoop(hadoop(aside), name), to):
            raise OSError(f"can't move {name} into {path}")
    remove(spark, aside)


def append_recon(metrics: DataFrame, path: str) -> None:
    """Compared metrics, added to those of earlier runs by system (source_system_cd), in one file for each."""
    write_partitioned(metrics.repartition("source_system_cd"), path, ["source_system_cd"], "append")


def filesystem(spark: SparkSession, path: str):
    where = spark._jvm.org.apache.hadoop.fs.Path(path)
    return where.getFileSystem(spark._jsc.hadoopConfiguration()), where


def remove(spark: SparkSession, path: str) -> None:
    fs, where = filesystem(spark, path)
    fs.delete(where, True)


def snapshot(spark: SparkSession, path: str, to: str, by: Sequence[str] = ()) -> None:
    """A copy of a table's current rows."""
    spark.read.parquet(path).write.mode("overwrite").partitionBy(*by).parquet(to)


def promote(spark: SparkSession, new: str, path: str, backup: str) -> None:
    """new takes the table's place; what was there becomes the backup. Two renames, no copy."""
    fs, at = filesystem(spark, path)
    hadoop = spark._jvm.org.apache.hadoop.fs.Path
    if fs.exists(at):
        fs.delete(hadoop(backup), True)
        if not fs.rename(at, hadoop(backup)):
            raise OSError(f"can't move {path}")
    if not fs.rename(hadoop(new), at):
        raise OSError(f"can't move {new}")


def backed_up(spark: SparkSession, path: str, to: str, *, drop: bool = False) -> bool:
    """Copies a table; the original goes, where that is asked for, only if the copy has as many rows."""
    snapshot(spark, path, to)
    same = spark.read.parquet(path).count() == spark.read.parquet(to).count()
    if same and drop:
        remove(spark, path)
    return same


class KeyValueStore(Protocol):
    def put(self, rows: Iterable[dict]) -> None: ...


def write_key_values(df: DataFrame, store: Callable[[], KeyValueStore], key: str, partitions: int = 50, batch: int = 500) -> None:
    """Puts all rows, dealt by key; store() opens a connection in each task. Puts of a retried task repeat, by key."""

    def run(rows) -> None:
        target, held = store(), []
        for r in rows:
            held.append(r.asDict())
            if len(held) >= batch:
                target.put(held)
                held = []
        if held:
            target.put(held)

    df.repartition(partitions, key).foreachPartition(run)


def html_table(df: DataFrame, limit: int = 20, width: int = 20) -> str:
    """A report of the first rows; long cells are cut and end in `...`, all is escaped."""

    def cell(x) -> str:
        s = "" if x is None else str(x)
        return html.escape(s if len(s) <= width else s[: width - 3] + "...")

    rows = [f"<tr>{''.join(f'<td>{cell(x)}</td>' for x in r)}</tr>" for r in df.limit(limit).collect()]
    return f"<table><tr>{''.join(f'<th>{html.escape(c)}</th>' for c in df.columns)}</tr>{''.join(rows)}</table>"


def failure_report(audit: DataFrame, limit: int = 200) -> str:
    """HTML of failed loads, headed by their first row's date, batch and load type; empty when all went well."""
    rows = audit.where(F.col("loadstatus") != "success").orderBy("batch", "tablename").limit(limit)
    first = rows.first()
    return "" if first is None else f"<h3>{html.escape(f'{first.ingestiondt} {first.batch} {first.loadtype}')}</h3>" + html_table(rows.select("tablename", "loadstatus", "exception"), limit, 200)


def valid_address(address: str) -> bool:
    return "@" in address and "." in address


class Notifier(Protocol):
    def send(self, to: Sequence[str], subject: str, body: str) -> None: ...


class NoNotifier:
    """Sends nothing."""

    def send(self, to: Sequence[str], subject: str, body: str) -> None:
        pass


def create_statements(table: str, path: str, df: DataFrame, by: Sequence[str]) -> list[str]:
    columns = ", ".join(f"`{f.name}` {f.dataType.simpleString()}" for f in df.schema)
    out = [f"CREATE TABLE IF NOT EXISTS {table} ({columns}) USING parquet" + (f" PARTITIONED BY ({', '.join(by)})" if by else "") + f" LOCATION '{path}'"]
    return out + ([f"MSCK REPAIR TABLE {table}"] if by else [])


def publish_lists(spark: SparkSession, path: str, new: DataFrame) -> None:
    """Consolidated reference tables by their name, of which only the changed ones are written again."""
    from lakeforge.operators.lookup import changed_lists

    fs, where = filesystem(spark, path)
    if fs.exists(where):
        old = spark.read.schema(new.schema).parquet(path)
        # in both directions: a list that only lost rows has changed, too
        changed = changed_lists(new, old).select("typelistname").union(changed_lists(old, new).select("typelistname")).distinct()
        aside = f"{path.rstrip('/')}__{uuid.uuid4().hex}"
        write_partitioned(new.join(changed, "typelistname", "left_semi"), aside, ["typelistname"], "overwrite")
        move_partitions(spark, path, aside, "typelistname", [r[0] for r in changed.collect()])
    else:
        write_partitioned(new, path, ["typelistname"], "overwrite")


def rewritten(spark: SparkSession, path: str, by: Sequence[str], rows: DataFrame, max_records: int) -> None:
    """rows, which come from the table at path, in the table's place; dealt by partition so that files are few."""
    aside, backup = (f"{path.rstrip('/')}__{uuid.uuid4().hex}" for _ in range(2))
    write_partitioned(rows.repartition(*by), aside, by, "overwrite", max_records=max_records)
    promote(spark, aside, path, backup)
    remove(spark, backup)


def compact(spark: SparkSession, path: str, by: Sequence[str], max_records: int = 5_000_000) -> None:
    """The same rows in few files for each partition."""
    rewritten(spark, path, by, spark.read.parquet(path), max_records)


def restore_audit(spark: SparkSession, path: str, batch: str, by: Sequence[str], max_records: int = 5_000_000) -> None:
    """Audit rows of batches after `batch` go, as when a table is restored to it."""
    rows = spark.read.parquet(path)
    rewritten(spark, path, by, rows.where(F.col("batch").cast("decimal(38,0)") <= F.lit(batch).cast("decimal(38,0)")), max_records)


def write_csv(df: DataFrame, path: str, name: str, stamp: str) -> str:
    """Quoted CSV files with a header under a name with the run's stamp; returns where."""
    to = f"{path.rstrip('/')}/{name}_{stamp}"
    df.write.mode("overwrite").csv(to, header=True, quoteAll=True)
    return to


def connected(connect: Callable[[], object], *, tries: int = 3, pause: float = 300, sleep: Callable[[float], None] = time.sleep):
    """connect()'s value, after a few tries; the last error goes on to the caller."""
    for k in range(tries):
        try:
            return connect()
        except Exception:  # noqa: BLE001  tried again, then raised
            if k == tries - 1:
                raise
            sleep(pause)
