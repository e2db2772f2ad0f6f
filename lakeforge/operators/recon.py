"""Reconciliation of source and lake by metrics: four templates, a comparison, and rows that one side lacks."""
from __future__ import annotations

from collections.abc import Callable, Sequence
from dataclasses import dataclass
from functools import reduce

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T


def same_month(c: Column, as_of: Column) -> Column:
    return F.trunc(c, "MM") == F.trunc(as_of, "MM")


def same_year(c: Column, as_of: Column) -> Column:
    return F.year(c) == F.year(as_of)


def metric(df: DataFrame, entity: str, value: Column) -> DataFrame:
    """One row auditentity, value."""
    return df.agg(value.cast("double").alias("value")).select(F.lit(entity).alias("auditentity"), "value")


def as_of_distinct(df: DataFrame, entity: str, key: str, at: str, as_of: Column, where: Column | None = None) -> DataFrame:
    """Distinct keys up to an instant."""
    rows = df.where(F.col(at) <= as_of)
    return metric(rows if where is None else rows.where(where), entity, F.countDistinct(key))


def as_of_sum(df: DataFrame, entity: str, amount: str, at: str, as_of: Column, *, empty_is_zero: bool = True, scale: int = 2) -> DataFrame:
    """Sum up to an instant, exact to `scale` decimals; of no rows 0, or null where the other form is asked for."""
    total = F.sum(F.coalesce(F.col(amount), F.lit(0)).cast(f"decimal(20,{scale})"))
    return metric(df.where(F.col(at) <= as_of), entity, F.coalesce(total, F.lit(0)) if empty_is_zero else total)


def month_to_date(df: DataFrame, entity: str, amount: str, at: str, as_of: Column) -> DataFrame:
    return as_of_sum(df.where(same_month(F.col(at), as_of)), entity, amount, at, as_of)


def year_to_date(df: DataFrame, entity: str, amount: str, at: str, as_of: Column) -> DataFrame:
    return as_of_sum(df.where(same_year(F.col(at), as_of)), entity, amount, at, as_of)


@dataclass(frozen=True)
class Metric:
    """A metric of one table: kind is distinct, sum, mtd or ytd; where is a condition in SQL."""

    entity: str
    kind: str
    column: str
    at: str
    where: str = "true"


def greatest_case(df: DataFrame, keys: Sequence[str], cases: Sequence[tuple[Column, Column]], otherwise: Column | None = None, name: str = "value") -> DataFrame:
    """key, name: by the first of the keys that isn't null, the greatest of what each row's first case that holds gives
    (`otherwise` where none does; without it, such rows give nothing). A derived table to join by key, one row for each."""
    value = F.when(*cases[0])
    for case in cases[1:]:
        value = value.when(*case)
    value = value if otherwise is None else value.otherwise(otherwise)
    return df.groupBy(F.coalesce(*keys).alias("key")).agg(F.max(value).alias(name))


def metrics(df: DataFrame, specs: Sequence[Metric], as_of: Column, scale: int = 2) -> DataFrame:
    """auditentity, value of all metrics of a table, in one scan.

    Distinct counts are exact and don't multiply the rows by the metrics: whole numbers are counted as bits of bitmaps, one
    bitmap for each 32,768 neighbours and metric, made by each task and then joined by `or`; other columns by a flag for
    each value. Only where several columns are counted is a row read once for each of them."""
    counted = list(dict.fromkeys(m.column for m in specs if m.kind == "distinct"))
    whole = {c for c in counted if isinstance(df.schema[c].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType))}
    if len(counted) > 1:
        df = df.withColumn("__which", F.explode(F.array(*(F.lit(k) for k in range(len(counted))))))
    which = F.col("__which") if len(counted) > 1 else F.lit(0)

    def plain(c: str) -> Column:
        """One text for each value; 0.0 and -0.0 are one."""
        return (F.col(c) + F.lit(0.0) if isinstance(df.schema[c].dataType, (T.FloatType, T.DoubleType)) else F.col(c)).cast("string")

    def chosen(of: dict[str, Column], kind: str) -> Column:
        cases = [F.when(which == k, of[c]) for k, c in enumerate(counted) if c in of]
        return F.coalesce(*cases) if cases else F.lit(None).cast(kind)

    keys = [chosen({c: F.bitmap_bucket_number(F.col(c).cast("long")) for c in whole}, "long").alias("__bucket"), chosen({c: plain(c) for c in counted if c not in whole}, "string").alias("__value")]

    def one(m: Metric) -> tuple[Column, Callable[[Column], Column]]:
        """What each key's rows give, and what these give together."""
        at = F.col(m.at)
        rows = F.coalesce((at <= as_of) & F.expr(m.where), F.lit(False))
        if m.kind == "distinct":
            mine = rows & (which == counted.index(m.column)) & F.col(m.column).isNotNull()
            if m.column in whole:
                return F.bitmap_construct_agg(F.when(mine, F.bitmap_bit_position(F.col(m.column).cast("long")))), lambda c: F.coalesce(F.sum(F.bitmap_count(c)), F.lit(0)).cast("double")
            return F.max(F.when(mine, 1).otherwise(0)), lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("double")
        rows = rows & (which == 0) & {"sum": F.lit(True), "mtd": same_month(at, as_of), "ytd": same_year(at, as_of)}[m.kind]
        return F.sum(F.when(rows, F.coalesce(F.col(m.column), F.lit(0)).cast(f"decimal(20,{scale})"))), lambda c: F.coalesce(F.sum(c), F.lit(0)).cast("double")

    parts = [one(m) for m in specs]
    first = df.groupBy(*keys) if counted else df.groupBy()
    wide = first.agg(*(p.alias(f"m{k}") for k, (p, _) in enumerate(parts))).agg(*(total(F.col(f"m{k}")).alias(f"m{k}") for k, (_, total) in enumerate(parts)))
    each = F.explode(F.array(*(F.struct(F.lit(m.entity).alias("auditentity"), F.col(f"m{k}").alias("value")) for k, m in enumerate(specs))))
    return wide.select(each.alias("x")).select("x.*")


def together(metrics: Sequence[DataFrame], *, distinct: bool = False) -> DataFrame:
    out = reduce(DataFrame.unionByName, metrics)
    return out.distinct() if distinct else out


def reconciled(source: DataFrame, lake: DataFrame, system: str, extract_date: str, start: str, end: str, *, outer: bool = True) -> DataFrame:
    """Both sides' values of each metric and its status: success when equal, failed when not or when both are null,
    missing when one side has no such metric (only the metrics of both sides, unless outer)."""
    s = source.select("auditentity", F.col("value").alias("src_value"), F.lit(True).alias("in_source"))
    t = lake.select("auditentity", F.col("value").alias("lake_value"), F.lit(True).alias("in_lake"))
    both = s.join(t, "auditentity", "full_outer" if outer else "inner")
    status = F.when(F.col("in_source").isNull() | F.col("in_lake").isNull(), "missing").when(F.col("src_value") == F.col("lake_value"), "success").otherwise("failed")
    return both.select(F.lit(extract_date).alias("extractdate"), "auditentity", F.lit(start).alias("auditfrom"), F.lit(end).alias("auditthru"), "src_value", F.lit(system).alias("source_system_cd"), "lake_value", status.alias("recon_status"))


def reconciled_each(source: DataFrame, lake: DataFrame, system: str, extract_date: str, *, outer: bool = True) -> DataFrame:
    """reconciled() of metrics that bring their own times: auditfrom and auditthru are the source's, or else the lake's, as
    are the status of policies (polstatus, null where there is none) and the load cycle, where they have one."""
    own = [c for c in ("etl_load_cycle_id",) if c in source.columns]
    text = lambda df, c: F.col(c).cast("string") if c in df.columns else F.lit(None).cast("string")
    told = lambda df, name: df.select(*own, "auditentity", F.struct(text(df, "polstatus").alias("polstatus"), text(df, "auditfrom").alias("auditfrom"), text(df, "auditthru").alias("auditthru"), F.col("value").alias("value")).alias(name))
    both = told(source, "s").join(told(lake, "t"), [*own, "auditentity"], "full_outer" if outer else "inner")
    first = lambda c: F.coalesce(f"s.{c}", f"t.{c}").alias(c)
    status = F.when(F.col("s").isNull() | F.col("t").isNull(), "missing").when(F.col("s.value") == F.col("t.value"), "success").otherwise("failed")
    return both.select(*own, F.lit(extract_date).alias("extractdate"), first("polstatus"), "auditentity", first("auditfrom"), first("auditthru"), F.col("s.value").alias("src_value"), F.lit(system).alias("source_system_cd"), F.col("t.value").alias("lake_value"), status.alias("recon_status"))


def missing_keys(source: DataFrame, target: DataFrame, columns: Sequence[str], up_to: Column | None = None) -> DataFrame:
    """Distinct source keys that the target lacks; with a CDC column among them, stale rows count as missing."""
    rows = source if up_to is None else source.where(up_to)
    return rows.select(*columns).subtract(target.select(*columns))


def missing_by_checksum(source: DataFrame, target: DataFrame, columns: Sequence[str], up_to: Column | None = None, *, ranges: int = 1024, levels: int = 3, leaf: int = 100_000, most: int = 20_000) -> DataFrame:
    """missing_keys() for sides that are mostly alike: both are summed up by ranges of the first column, and only ranges
    whose sums differ are looked into, by smaller ranges and at last row by row.

    A range's sums are its number of rows and the xor and sum of 64-bit hashes of them. Ranges are of the column's values
    where it is a whole number, so that scans can leave out what lies outside, else of its hash. It stops descending when
    what differs has at most `leaf` rows, and doesn't where more than `most` ranges differ, as then most rows are to be
    compared anyway. Rows with a null in the first column are always compared row by row. The numbers of differing ranges
    (8 bytes each) are all that reaches the driver.
    """
    key = columns[0]
    place = F.col(key).cast("long") if isinstance(source.schema[key].dataType, (T.ByteType, T.ShortType, T.IntegerType, T.LongType)) else F.xxhash64(key)
    rows = (source if up_to is None else source.where(up_to)).select(*columns)
    there = target.select(*columns)
    ends = rows.where(F.col(key).isNotNull()).agg(F.min(place).alias("low"), F.max(place).alias("high")).first()
    if ends["low"] is None:
        return rows.subtract(there)
    low, high = ends["low"], ends["high"]
    within = place.between(low, high)
    width = max(1, -(-(high - low + 1) // ranges))
    for level in range(levels):
        number = F.floor((place.cast("decimal(20,0)") - F.lit(low)) / F.lit(width)).cast("long").alias("range")
        hashed = F.xxhash64(*columns)
        sums = [F.count("*").alias("n"), F.bit_xor(hashed).alias("x"), F.sum(hashed.cast("decimal(20,0)")).alias("s")]
        of = lambda df: df.where(within & F.col(key).isNotNull()).groupBy(number).agg(*sums)  # noqa: B023, E731
        mine, theirs = of(rows).alias("a"), of(there).alias("b")
        differ = mine.join(theirs, "range", "left").where(~(F.col("a.n").eqNullSafe(F.col("b.n")) & F.col("a.x").eqNullSafe(F.col("b.x")) & F.col("a.s").eqNullSafe(F.col("b.s")))).select("range", F.col("a.n").alias("n"))
        found = differ.take(most + 1)
        if len(found) > most:
            break
        if not found:
            within = F.lit(False)
            break
        numbers = sorted(r["range"] for r in found)
        within = within & place.between(low + numbers[0] * width, min(high, low + (numbers[-1] + 1) * width - 1)) & F.floor((place.cast("decimal(20,0)") - F.lit(low)) / F.lit(width)).cast("long").isin(numbers)
        if width == 1 or sum(r["n"] for r in found) <= leaf:
            break
        width = max(1, width * len(numbers) // ranges or 1)
    look = within | F.col(key).isNull()
    return rows.where(look).subtract(there.where(look))


def first_missing(keys: DataFrame, column: str, n: int = 500) -> DataFrame:
    """The n least keys, for a report."""
    return keys.orderBy(column).limit(n)


def reloaded(source: DataFrame, keys: DataFrame, key: str) -> DataFrame:
    """Source rows of missing keys."""
    return source.join(keys.select(key).distinct(), key, "left_semi")


def batches_to_load(identified: DataFrame, loaded: DataFrame) -> DataFrame:
    """Batches of missing keys that were found but not loaded yet."""
    return identified.select("tablename", "missingdatabatch").subtract(loaded.select("tablename", "missingdatabatch"))
