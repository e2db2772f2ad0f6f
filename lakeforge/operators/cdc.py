"""Change-data-capture windows: which rows a load takes, and where the next one starts."""
from __future__ import annotations

from dataclasses import dataclass
from datetime import datetime, timedelta

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeforge.spec import TableSpec

EPOCH_START = datetime(1900, 1, 1)


def cdc_column(spec: TableSpec, change_table: bool = False) -> Column:
    """The expression that orders a table's changes."""
    if change_table:
        return F.col("deletetime")
    if spec.cdc_kind == "coalesce":
        return F.coalesce(*(F.col(x.strip()) for x in spec.cdc_col[len("coalesce(") : -1].split(",")))
    if spec.cdc_kind == "greatest":
        return F.greatest(*(F.col(x.strip()) for x in spec.cdc_col.split(",")))
    return F.col(spec.cdc_col)


def without_sentinel(c: Column) -> Column:
    """Null for the year 9999, which sources write for `never`."""
    return F.when(F.year(c) < 9999, c)


def window_predicate(c: Column, load_type: str, use_window: bool, restart: bool, start: Column | None, end: Column | None) -> Column | None:
    """What a load reads: a full load everything, or up to `end` when windows are used; an incremental one what came
    after `end`, or the window (start, end] when windows are used or a batch is restarted. None: no filter."""
    end = F.lit(EPOCH_START) if end is None else end
    if load_type == "tl":
        return c <= end if use_window else None
    if use_window or restart:
        return (c > start) & (c <= end)
    return c > end


def read_window(df: DataFrame, spec: TableSpec, load_type: str, *, use_window: bool = False, restart: bool = False, start: Column | None = None, end: Column | None = None) -> DataFrame:
    if spec.is_reference or (load_type == "tl" and spec.cdc_kind in ("none", "number")):
        return df
    p = window_predicate(cdc_column(spec), load_type, use_window, restart, start, end)
    return df if p is None else df.where(p)


def after_number(df: DataFrame, column: str, seen: int | None) -> DataFrame:
    """Rows of a table whose changes a growing number orders."""
    return df.where(F.col(column) > F.lit(seen or 0))


def deletes_only(df: DataFrame, operation: str = "__$operation") -> DataFrame:
    """Deletions of a change table."""
    return df.where(F.col(f"`{operation}`") == 1)


def literal(when: datetime, kind: T.DataType) -> Column:
    """An instant as a literal of a column's type, so that a scan gets a comparison with it as a filter."""
    text = F.lit(when.isoformat(sep=" ", timespec="microseconds"))
    return text.cast("timestamp_ntz") if isinstance(kind, T.TimestampNTZType) else F.lit(when).cast(kind)


def kind_of(df: DataFrame, c: Column) -> T.DataType:
    return df.select(c.alias("c")).schema["c"].dataType


def bounds(df: DataFrame, c: Column) -> DataFrame:
    """One row low, high of the CDC expression; sentinels don't count. Of a plain column of instants they are left out by a
    filter that the scan gets."""
    kind = kind_of(df, c)
    if isinstance(kind, (T.TimestampNTZType, T.TimestampType)):
        rows = df.where(c < literal(datetime(9999, 1, 1), kind))
        return rows.agg(F.min(c).alias("low"), F.max(c).alias("high"))
    return df.agg(F.min(without_sentinel(c)).alias("low"), F.max(without_sentinel(c)).alias("high"))


def load_bounds(spec: TableSpec, load_type: str, source: DataFrame, lake: DataFrame) -> DataFrame:
    """One row lower, upper that a load of a table starts from. A full load reads the source by ranges of its partition column,
    whose ends these are; an incremental one goes on from the greatest value that the lake has, lower being null: of
    several CDC columns the greatest of their maxima, those without a value apart. Each maximum is one that a scan's
    statistics or a source can answer, as no row's values are compared with each other."""
    if load_type == "tl" and spec.cdc_kind != "greatest":
        if not spec.partition_by:
            raise ValueError(f"{spec.table} has no column to read a full load by")
        return source.agg(F.min(spec.partition_by).alias("lower"), F.max(spec.partition_by).alias("upper"))
    text = spec.cdc_col[len("coalesce(") : -1] if spec.cdc_kind == "coalesce" else spec.cdc_col
    found = [F.max(x.strip()) for x in text.split(",")]
    upper = F.greatest(*found) if len(found) > 1 else found[0]
    return lake.agg(upper.alias("upper")).select(F.lit(None).cast("string").alias("lower"), "upper")


@dataclass(frozen=True)
class CutOff:
    """Rules for the upper end of a load."""

    lag_minutes: int = 0
    ahead_minutes: int = 30
    narrow_minutes: int = 1


def cut_off(low: datetime | None, high: datetime | None, clock: datetime, rule: CutOff = CutOff()) -> datetime | None:
    """The window's end: the largest value when it lies ahead of the source's clock or all values are within a minute,
    else the largest value less the lag. None, when there are no values, takes no rows."""
    if high is None:
        return None
    if high - clock > timedelta(minutes=rule.ahead_minutes) or high - low < timedelta(minutes=rule.narrow_minutes):
        return high
    return high - timedelta(minutes=rule.lag_minutes)


def staging_cut_off(mode: str, clock: datetime) -> datetime:
    """MIDNIGHT (one millisecond before today), an instant in ISO form, or anything else for the source's clock."""
    if mode.upper() == "MIDNIGHT":
        return clock.replace(hour=0, minute=0, second=0, microsecond=0) - timedelta(milliseconds=1)
    try:
        return datetime.fromisoformat(mode)
    except ValueError:
        return clock


def cut_off_column(low: Column, high: Column, clock: datetime, rule: CutOff = CutOff()) -> Column:
    """cut_off() as an expression, so that a load needn't stop for its bounds."""
    minutes = lambda a, b: F.timestamp_diff("MICROSECOND", a, b) / F.lit(60_000_000)
    as_is = (minutes(F.lit(clock).cast("timestamp_ntz"), high) > rule.ahead_minutes) | (minutes(low, high) < rule.narrow_minutes)
    return F.when(as_is, high).otherwise(high - F.expr(f"INTERVAL {rule.lag_minutes} MINUTES"))


def up_to(df: DataFrame, c: Column, limits: DataFrame, clock: datetime, rule: CutOff = CutOff()) -> DataFrame:
    """Rows up to the cut-off of limits(low, high), a table of one row. It is fetched first: as a literal, the cut-off is a
    filter of the scan, beside the window's start, so that row groups outside aren't read."""
    ends = limits.first()
    end = cut_off(ends["low"], ends["high"], clock, rule)
    return df.where(F.lit(False)) if end is None else df.where(c <= literal(end, kind_of(df, c)))


def source_clock(replication: DataFrame, column: str, lag_minutes: int) -> DataFrame:
    """One row: the latest replicated instant plus the lag."""
    return replication.agg((F.max(column) + F.expr(f"INTERVAL {lag_minutes} MINUTES")).alias("clock"))


def partition_count(low, high, override: int | None = None, *, unit: float = 5e7, small: int = 1_000_000, other: int = 5) -> int:
    """Partitions of a ranged read: the spec's own number, 1 for up to a million, else four for each whole `unit`,
    10 where that is under 5 and 100 where it is over. Bounds that aren't numbers give `other`."""
    if override:
        return override
    if not isinstance(low, (int, float)) or not isinstance(high, (int, float)):
        return other
    if high - low <= small:
        return 1
    p = int((high - low) // unit) * 4
    return 10 if p < 5 else min(p, 100)


def partition_count_column(low: Column, high: Column, *, unit: int = 50_000_000, small: int = 1_000_000) -> Column:
    p = F.floor((high - low) / F.lit(unit)) * 4
    return F.when(high - low <= small, 1).when(p < 5, 10).otherwise(F.least(p, F.lit(100))).cast("int")
