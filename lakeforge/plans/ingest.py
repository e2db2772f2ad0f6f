"""Whole loads, composed of operators."""
from __future__ import annotations

from collections.abc import Callable, Sequence
from concurrent.futures import ThreadPoolExecutor
from dataclasses import dataclass, replace
from datetime import datetime
from typing import TypeVar

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeforge.operators import audit, cdc, lookup, merge, pii, recon, schema, stamp
from lakeforge.sources import sinks
from lakeforge.spec import LookupSpec, TableSpec

X = TypeVar("X")


@dataclass(frozen=True)
class Load:
    """What one load of a table is given: nothing is taken from the session or the machine's clock."""

    spec: TableSpec
    key: str
    load_type: str
    batch: str
    clock: datetime
    start: Column | None = None
    end: Column | None = None
    use_window: bool = False
    restart: bool = False
    lookups: tuple[LookupSpec, ...] = ()
    pii: tuple[str, ...] = ()
    rule: cdc.CutOff = cdc.CutOff()


def harmonised(source: DataFrame, refs: dict[str, DataFrame], load: Load, changes: DataFrame | None = None) -> DataFrame:
    """Window, cut-off, stamps, deletions and lookups of one load, as one plan."""
    c = cdc.cdc_column(load.spec)
    rows = cdc.read_window(stamp.without_operational(source), load.spec, load.load_type, use_window=load.use_window, restart=load.restart, start=load.start, end=load.end)
    if not load.use_window:
        rows = cdc.up_to(rows, c, cdc.bounds(rows, c), load.clock, load.rule)
    rows = stamp.with_batch(rows, load.clock.strftime("%Y-%m-%d"), load.batch).withColumn("__cdc", c)
    rows = stamp.with_month_and_uid(rows, "__cdc", load.key).drop("__cdc")
    if load.spec.hard_delete_flag in ("id", "cdc"):
        rows = merge.with_deleted_flag(rows, changes)
    return lookup.lookup_chain(rows, refs, list(load.lookups))


def masked_from_secured(spark: SparkSession, secured: str, path: str, load: Load, by: Sequence[str] = ("ingestiondt", "batch")) -> tuple[int, int]:
    """The batch's masked copy, made of what its secured table at `secured` holds and not of the source once more, so that
    both copies are of the same rows; returns the counts of the masked write (rows sent, rows there)."""
    rows = spark.read.parquet(secured).where(F.col("batch") == load.batch)
    kinds = {f.name: f.dataType for f in rows.schema.fields}
    rows = pii.masked(rows.withColumns({c: F.col(c).cast("string") for c in by if kinds[c].simpleString() != "string"}), load.pii)
    sinks.drop_batch(spark, path, load.batch)
    return sinks.counted_write(rows, path, list(by), "append", batch=load.batch)


def secured_and_masked(rows: DataFrame, load: Load) -> tuple[DataFrame, DataFrame]:
    return pii.split(rows, load.pii)


def audit_log(spark: SparkSession, path: str) -> DataFrame:
    """The audit kept at a path; no rows where nothing has been written yet."""
    fs, where = sinks.filesystem(spark, path)
    return spark.read.schema(audit.AUDIT).parquet(path) if fs.exists(where) else spark.createDataFrame([], audit.AUDIT)


def next_window(source: DataFrame, log: DataFrame, load: Load) -> tuple[str, str, str] | None:
    """(batch, start, end) of a load: from the audit's watermark to the cut-off of the values after it; on a restart those
    of the table's last load, unless that was a success. A load after one that lost rows (failed) starts where that one did.
    None: there is nothing to load. Only single rows are fetched."""
    mine = log.where(F.col("tablename") == load.spec.table)
    last = audit.latest_by_table(mine).first()
    if load.restart:
        return None if last is None or last.loadstatus == "success" else (last.batch, last.batchwindowstart, last.batchwindowend)
    mark = audit.watermarks(mine).first() if load.load_type != "tl" else None
    start = mark.batchwindowend if mark else str(cdc.EPOCH_START)
    if mark and last.loadstatus == "failed":
        start = last.batchwindowstart
    c = cdc.cdc_column(load.spec).cast("timestamp_ntz")
    limits = cdc.bounds(cdc.read_window(source, load.spec, "di", end=instant(start)), c).first()
    end = cdc.cut_off(limits.low, limits.high, load.clock, load.rule)
    return None if end is None or str(end) <= start else (load.batch, start, str(end))


def instant(text: str) -> Column:
    """A window's end, as the audit keeps it, as a literal: scans get it as a filter."""
    return F.lit(text).cast("timestamp_ntz")


def load_next(spark: SparkSession, source: DataFrame, refs: dict[str, DataFrame], load: Load, path: str, audit_path: str, *, write: Callable[..., tuple[int, int]] = sinks.counted_write, retries: int = 1) -> str:
    """One load of a table from where its last one ended: audit, window, read, stamps and look-ups, write, audit again.

    Rows go to partitions ingestiondt, batch; each try first removes what an earlier one left of the batch, so that neither
    a retry nor a restart repeats rows; so does a load after one that ended as failed with that one's rows, which it loads
    again. The audit then gets one row with the window, both counts and the status, which is
    returned: success, failed (counts differ) or failedUnknown (an exception; the next load starts where this one did).
    `empty`: no value lies after the watermark; nothing is written. A full load is written beside the table and takes its
    place only if all rows are there.
    """
    if load.spec.cdc_kind not in ("timestamp", "coalesce", "greatest"):
        raise ValueError(f"{load.spec.table} has no column of instants to take windows from")
    log = audit_log(spark, audit_path)
    last = audit.latest_by_table(log.where(F.col("tablename") == load.spec.table)).first()
    lost = last.batch if last and last.loadstatus == "failed" and not load.restart else None
    found = next_window(source, log, load)
    if found is None:
        return "empty"
    batch, start, end = found
    this = replace(load, batch=batch, use_window=True, start=instant(start), end=instant(end))
    rows = harmonised(source, refs, this)
    mode = sinks.save_mode(load.load_type, False)
    counts: list[int | None] = [None, None]

    whole = mode == "overwrite"
    to = f"{path.rstrip('/')}__new" if whole else path

    def attempt() -> tuple[int, int]:
        for old in {batch, lost} - {None}:
            sinks.drop_batch(spark, to, old)
        counts[:] = write(rows, to, ["ingestiondt", "batch"], mode, batch=batch)
        return counts[0], counts[1]

    status = sinks.write_with_retry(attempt, retries)
    if whole and status == "success":
        sinks.promote(spark, to, path, f"{path.rstrip('/')}__old")
        sinks.remove(spark, f"{path.rstrip('/')}__old")
    elif whole:
        sinks.remove(spark, to)
    if status == "failedUnknown":
        counts = [None, None]
    at = str(load.clock)
    row = {"ingestiondt": f"{load.clock:%Y-%m-%d}", "batch": batch, "tablename": load.spec.table, "sourcecount": counts[0], "targetcount": counts[1], "loadstarttime": at, "loadendtime": at, "loadstatus": status}
    row |= {"batchwindowstart": start, "batchwindowend": end, "loadtype": load.load_type, "batchstarttime": at, "harddeletebatch": "n"}
    done = audit.loggable(spark.createDataFrame([row], audit.AUDIT))
    done.coalesce(1).write.mode("append").parquet(audit_path)
    return status


def missing_rows(source: DataFrame, lake: DataFrame, refs: dict[str, DataFrame], load: Load, *, by_checksum: bool = False) -> DataFrame:
    """Source rows whose key the lake lacks, of those that the table's spec looks at (missing_where), harmonised like any
    load. by_checksum: for sides that are mostly alike, see recon.missing_by_checksum()."""
    source = source.where(load.spec.missing_where) if load.spec.missing_where else source
    keys = (recon.missing_by_checksum if by_checksum else recon.missing_keys)(source, lake, [load.key])
    found = recon.reloaded(source, keys, load.key).withColumn("__cdc", cdc.cdc_column(load.spec))
    return lookup.lookup_chain(stamp.with_month_and_uid(stamp.with_batch(found, "", load.batch), "__cdc", load.key).drop("__cdc"), refs, list(load.lookups))


def history(raw: DataFrame, target: DataFrame, month: str, batch: str) -> DataFrame:
    """Header-less history rows with the target's names and types, stamped with their own month and a batch; rows whose
    first column doesn't fit its type are rejected."""
    rows = schema.positional(raw, target.schema, ("deletetime", "ingestiondt", "batch"))
    return rows.where(F.col(rows.columns[0]).isNotNull()).withColumns({"deletetime": F.lit(None).cast("timestamp_ntz"), "ingestiondt": F.to_date(F.col(month).cast("string"), "yyyyMM").cast("string"), "batch": F.lit(batch)})


def all_tables(work: Sequence[X], run: Callable[[X], object], spark, *, at_once: int = 25, pool: str | None = None) -> list[tuple[X, object]]:
    """run() for each table on a few driver threads; a table's exception is its result, so that others go on."""

    def one(x: X) -> tuple[X, object]:
        if pool:
            spark.sparkContext.setLocalProperty("spark.scheduler.pool", pool)
        try:
            return x, run(x)
        except Exception as e:  # noqa: BLE001  reported with its table
            return x, e

    with ThreadPoolExecutor(at_once) as threads:
        return list(threads.map(one, work))
