"""Schema drift."""
from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


@dataclass(frozen=True)
class Drift:
    added: tuple[str, ...]
    removed: tuple[str, ...]
    retyped: tuple[tuple[str, str, str], ...]  # name, old type, new type


def drift(old: T.StructType, new: T.StructType) -> Drift:
    """Differences by name (in any case) first, then by type."""
    a, b = ({f.name.lower(): f.dataType.simpleString() for f in s} for s in (old, new))
    return Drift(tuple(sorted(b.keys() - a.keys())), tuple(sorted(a.keys() - b.keys())), tuple((n, a[n], b[n]) for n in sorted(a.keys() & b.keys()) if a[n] != b[n]))


def drift_rows(old: DataFrame, new: DataFrame) -> DataFrame:
    d = drift(old.schema, new.schema)
    rows = [(n, "added", None, None) for n in d.added] + [(n, "removed", None, None) for n in d.removed] + [(n, "retyped", x, y) for n, x, y in d.retyped]
    return old.sparkSession.createDataFrame(rows, "name string, change string, old_type string, new_type string")


def drift_report(old: DataFrame, new: T.StructType) -> DataFrame:
    """drift_rows() with how many of old's rows each change is about: values that go with a removed column, values that a
    new type can't hold, rows that get a null for an added one. All from one scan of old."""
    d = drift(old.schema, new)
    lost = lambda n, kind: F.count(F.when(F.col(n).isNotNull() & F.expr(f"try_cast(`{n}` AS {kind}) IS NULL"), 1))
    found = [(n, "added", None, None, F.count("*")) for n in d.added] + [(n, "removed", None, None, F.count(n)) for n in d.removed] + [(n, "retyped", x, y, lost(n, y)) for n, x, y in d.retyped]
    cells = [F.struct(*(F.lit(x).cast("string").alias(c) for x, c in zip(row[:4], ("name", "change", "old_type", "new_type"))), row[4].alias("n_rows")) for row in found]
    if not cells:
        return old.sparkSession.createDataFrame([], "name string, change string, old_type string, new_type string, n_rows long")
    return old.agg(F.array(*cells).alias("x")).select(F.explode("x").alias("x")).select("x.*")


def evolved(df: DataFrame, target: T.StructType) -> DataFrame:
    """df with the target's columns and types: nulls for what it lacks or what can't be cast, without what it has more."""
    own = {c.lower(): c for c in df.columns}
    cast = lambda f: F.expr(f"try_cast(`{own[f.name.lower()]}` AS {f.dataType.simpleString()})") if f.name.lower() in own else F.lit(None).cast(f.dataType)
    return df.select(*(cast(f).alias(f.name) for f in target))


def alter_statements(table: str, d: Drift, new: T.StructType) -> list[str]:
    """DDL that adds the new columns; removed and retyped ones need a rewrite."""
    kinds = {f.name.lower(): f.dataType.simpleString() for f in new}
    return [f"ALTER TABLE {table} ADD COLUMNS ({', '.join(f'`{n}` {kinds[n]}' for n in d.added)})"] if d.added else []


def positional(df: DataFrame, target: T.StructType, leave_out: tuple[str, ...] = ()) -> DataFrame:
    """Header-less columns with names and types of the target, by position; texts that don't fit become null."""
    fields = [f for f in target if f.name.lower() not in leave_out]
    return df.select(*(F.expr(f"try_cast(`{c}` AS {f.dataType.simpleString()})").alias(f.name) for c, f in zip(df.columns, fields)))
