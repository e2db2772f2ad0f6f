"""Metrics over joins of many tables, planned from a specification of the joins.

A sum over a join asks of most joined tables only how many of their rows match. Such tables are folded: counted by key
(with what is joined to them in turn) and joined as one number a key, so that rows neither fan out nor pile up at a hot
key; the sum takes each row as many times as the product of its numbers. Tables whose columns are needed stay as they are.
"""
from __future__ import annotations

import re
from collections.abc import Callable, Mapping, Sequence
from dataclasses import dataclass
from datetime import datetime
from functools import reduce
from operator import mul

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F


@dataclass(frozen=True)
class Edge:
    """A table joined as `name` where `key` (SQL over its columns) equals `to` (SQL over name.column of tables before it).
    where: which of its own rows take part; given: a further condition on tables before it. Both are parts of the join's
    ON, so a left edge never drops a row. needed: its columns are used by other edges or by metrics (its key is a column).
    below: edges from this table and from one another alone, which are joined and counted with it (its key is a column)."""

    name: str
    table: str
    key: str
    to: str
    how: str = "inner"
    where: str = "true"
    given: str = "true"
    needed: bool = False
    below: tuple[Edge, ...] = ()

    def __post_init__(self):
        if self.how not in ("inner", "left"):
            raise ValueError(f"{self.name}: {self.how} isn't inner or left")
        if self.needed and self.below:
            raise ValueError(f"{self.name} is needed as it is, so nothing is counted with it")
        self.spec()

    def spec(self) -> JoinSpec:
        return JoinSpec(self.name, self.table, self.below)

    def parents(self, names: Sequence[str]) -> set[str]:
        return set(names) & set(re.findall(r"(\w+)\.", f"{self.to} {self.given}"))


@dataclass(frozen=True)
class JoinSpec:
    """Edges in an order in which each comes after the tables that it refers to."""

    base: str
    table: str
    edges: tuple[Edge, ...] = ()

    def __post_init__(self):
        known = [self.base]
        for e in self.edges:
            if e.name in known:
                raise ValueError(f"{e.name} is joined twice")
            if not e.parents(known):
                raise ValueError(f"{e.name} refers to no table before it")
            known.append(e.name)

    def tables(self) -> set[str]:
        return {self.table}.union(*(e.spec().tables() for e in self.edges))


def folded(e: Edge, spec: JoinSpec, tables: Mapping[str, DataFrame]) -> DataFrame:
    """k, n: by key, how many rows e and all that hangs on it alone would give."""
    rows, key = tables[e.table].where(e.where).alias(e.name), F.expr(e.key)
    if e.below:
        rows, key = joined(e.spec(), tables, rows), F.col(f"{e.name}.{e.key}")
    rows, weight = attached(rows, e.name, spec, tables)
    weight = weight * F.col("weight") if e.below else weight
    return rows.where(key.isNotNull()).groupBy(key.alias("k")).agg(F.sum(weight).alias("n")).alias(e.name)


def attached(rows: DataFrame, name: str, spec: JoinSpec, tables: Mapping[str, DataFrame]) -> tuple[DataFrame, Column]:
    """rows with all folded edges that hang on the table `name` alone, and the product of their numbers."""
    names = [spec.base, *(x.name for x in spec.edges)]
    weight = [F.lit(1).cast("long")]
    for e in spec.edges:
        if not e.needed and owner(e, spec, names) == name:
            rows = rows.join(folded(e, spec, tables), F.expr(f"{e.name}.k = {e.to}") & F.expr(e.given), e.how)
            weight.append(F.coalesce(F.col(f"{e.name}.n"), F.lit(1)) if e.how == "left" else F.col(f"{e.name}.n"))
    return rows, reduce(mul, weight)


def owner(e: Edge, spec: JoinSpec, names: Sequence[str]) -> str:
    """Where a folded edge hangs: at the one table that isn't needed by others, or at the base with those that are."""
    needed = {spec.base, *(x.name for x in spec.edges if x.needed)}
    below = e.parents(names) - needed
    if len(below) > 1 or below and e.parents(names) & needed:
        raise ValueError(f"{e.name} refers to {sorted(e.parents(names))}: mark these as needed")
    return below.pop() if below else spec.base


def joined(spec: JoinSpec, tables: Mapping[str, DataFrame], base: DataFrame | None = None) -> DataFrame:
    """The join's rows before fan-out, with columns as name.column, and how often each counts: weight. base: the first
    table's rows, if not all of them."""
    rows = tables[spec.table].alias(spec.base) if base is None else base
    for e in spec.edges:
        if e.needed:
            rows = rows.join(tables[e.table].where(e.where).alias(e.name), F.expr(f"{e.name}.{e.key} = {e.to}") & F.expr(e.given), e.how)
    rows, weight = attached(rows, spec.base, spec, tables)
    return rows.withColumn("weight", weight)


@dataclass(frozen=True)
class Window:
    """What metrics are asked for: an id, and from when to when."""

    id: int
    start: datetime
    end: datetime


@dataclass(frozen=True)
class Measure:
    """A metric: kind is distinct or sum of `value` (SQL), over the rows for which `when` holds; since: its auditfrom."""

    entity: str
    kind: str
    value: str
    when: Callable[[Window], Column]
    since: Callable[[Window], datetime] = lambda w: datetime(1900, 1, 1)


#: Fixed value: conditions whose bits are in one long.
BITS = 62


def instant(when: datetime) -> Column:
    return F.lit(when.isoformat(sep=" ", timespec="microseconds")).cast("timestamp_ntz")


def measured(rows: DataFrame, measures: Sequence[Measure], windows: Sequence[Window]) -> DataFrame:
    """window, auditentity, auditfrom, auditthru, value, n_rows of each metric and window, all from one scan of rows, which
    may have a weight; distinct counts, which are of one column, take a second one of its values. A sum of no rows, or of
    nulls alone, is null; a distinct count is 0.

    A row is known by the set of conditions that hold for it, as bits: rows are summed up by these sets, of which windows in
    a row make few, and a counted value's rows give the union of their sets. So a row adds to each sum once, and not once for
    each window, and what is shuffled by value is one set, not all metrics."""
    counted = {m.value for m in measures if m.kind == "distinct"}
    if len(counted) > 1:
        raise ValueError(f"distinct counts of several columns: {sorted(counted)}")
    amounts = list(dict.fromkeys(m.value for m in measures if m.kind != "distinct"))
    whens = list(dict.fromkeys(m.when for m in measures))
    holds = [F.coalesce(when(w), F.lit(False)) for when in whens for w in windows]
    held = [F.when(c, F.lit(1 << k % BITS)).otherwise(F.lit(0)).cast("long") for k, c in enumerate(holds)]
    sets = [reduce(lambda a, b: a.bitwiseOR(b), held[k : k + BITS]).alias(f"set{k // BITS}") for k in range(0, len(held), BITS)]
    names = [f"set{k}" for k in range(len(sets))]
    weighted = "weight" in rows.columns
    if weighted:  # spares joins the rows of no window; over a scan, times that are computed would be once for each condition
        rows = rows.where(reduce(lambda a, b: a | b, holds))
    some = reduce(lambda a, b: a | b, (F.col(x) != 0 for x in names))
    flat = rows.select(*sets, (F.col("weight") if weighted else F.lit(1).cast("long")).alias("n"), *(F.expr(a).alias(f"v{i}") for i, a in enumerate(amounts)))
    money = [F.when(some, F.col(f"v{i}")).cast("decimal(20,2)") for i in range(len(amounts))]
    flat = flat.select(*names, "n", *((v * F.col("n") if weighted else v).alias(f"v{i}") for i, v in enumerate(money)))
    found = flat.groupBy(*names).agg(F.sum("n").alias("n"), *(F.sum(f"v{i}").alias(f"v{i}") for i in range(len(money)))).withColumn("values", F.lit(0).cast("long"))
    for c in counted:
        each = rows.select(F.expr(c).alias("key"), *sets).where("key is not null").groupBy("key").agg(*(F.bit_or(x).alias(x) for x in names))
        found = found.unionByName(each.groupBy(*names).agg(F.count("*").alias("values")), allowMissingColumns=True)
    cells = [(m, w, whens.index(m.when) * len(windows) + j) for m in measures for j, w in enumerate(windows)]
    inside = lambda k: F.col(f"set{k // BITS}").bitwiseAND(F.lit(1 << k % BITS)) != 0
    sum_of = lambda c, k: F.sum(F.when(inside(k), F.col(c)))
    value = lambda m, k: F.coalesce(sum_of("values", k), F.lit(0)) if m.kind == "distinct" else sum_of(f"v{amounts.index(m.value)}", k)
    wide = found.agg(*(x for i, (m, _, k) in enumerate(cells) for x in (value(m, k).cast("double").alias(f"value{i}"), F.coalesce(sum_of("n", k), F.lit(0)).alias(f"n{i}"))))
    text = lambda when: F.lit(when.strftime("%Y-%m-%d %H:%M:%S"))
    rows_of = [F.struct(F.lit(w.id).cast("long").alias("window"), F.lit(m.entity).alias("auditentity"), text(m.since(w)).alias("auditfrom"), text(w.end).alias("auditthru"), F.col(f"value{i}").alias("value"), F.col(f"n{i}").alias("n_rows")) for i, (m, w, _) in enumerate(cells)]
    return wide.select(F.explode(F.array(*rows_of)).alias("x")).select("x.*")
