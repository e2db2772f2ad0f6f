"""Lookups in reference tables, and the reference tables themselves."""
from __future__ import annotations

from functools import reduce

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.spec import LookupSpec

BROADCAST_ROWS = 1_000_000
BROADCAST_BYTES = 64 << 20


def sized(df: DataFrame, rows: int = BROADCAST_ROWS, size: int = BROADCAST_BYTES) -> DataFrame:
    """Marked for broadcast where it has at most `rows` rows and `size` bytes, as texts and 16 for each value; else left to a
    shuffled join. It is computed for that, as far as one row beyond the limit."""
    each = sum((F.coalesce(F.octet_length(F.col(f"`{c}`").cast("string")), F.lit(0)) + 16 for c in df.columns), F.lit(0))
    seen = df.limit(rows + 1).agg(F.count("*").alias("n"), F.coalesce(F.sum(each), F.lit(0)).alias("size")).first()
    return F.broadcast(df) if seen["n"] <= rows and seen["size"] <= size else df


def dimension(ref: DataFrame, spec: LookupSpec, number: int = 0) -> DataFrame:
    """The reference's rows that fit the lookup's conditions: its key and attributes, without repeats, and one row for
    each key (the least attributes), so that a lookup never multiplies rows. A null key is left out."""
    rows = ref.where(F.col(spec.ref_col).isNotNull())
    for column, value in spec.equals:
        rows = rows.where(F.col(column).cast("string") == F.lit(value))
    for column in spec.nulls:
        rows = rows.where(F.col(column).isNull())
    least = F.min(F.struct(*(F.col(a).alias(n) for a, n in spec.attributes))).alias("__a")
    return rows.groupBy(F.col(spec.ref_col).alias(f"__k{number}")).agg(least).select(f"__k{number}", "__a.*")


def lookup(main: DataFrame, ref: DataFrame, spec: LookupSpec, number: int = 0, broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """main with the lookup's attributes; a row without a match keeps nulls."""
    names = [n for _, n in spec.attributes]
    dim = sized(dimension(ref, spec, number), broadcast_rows)
    return main.drop(*names).join(dim, F.col(spec.source_col) == F.col(f"__k{number}"), "left").drop(f"__k{number}")


def lookup_chain(main: DataFrame, refs: dict[str, DataFrame], specs: list[LookupSpec], broadcast_rows: int = BROADCAST_ROWS) -> DataFrame:
    """All lookups in order; a later one may use what an earlier one added."""
    return reduce(lambda df, x: lookup(df, refs[x[1].ref_table], x[1], x[0], broadcast_rows), enumerate(specs), main)


def consolidated(types: dict[str, DataFrame]) -> DataFrame:
    """All reference tables in one, by name, with the table's name; a column that one lacks is null there."""
    named = [df.withColumn("typelistname", F.lit(name)) for name, df in sorted(types.items())]
    return reduce(lambda a, b: a.unionByName(b, allowMissingColumns=True), named)


def changed(new: DataFrame, old: DataFrame) -> DataFrame:
    """Distinct rows of new that old doesn't have; nulls are equal."""
    return new.select(*sorted(new.columns)).subtract(old.select(*sorted(new.columns)))


def changed_lists(new: DataFrame, old: DataFrame) -> DataFrame:
    """Names of the reference tables to publish again."""
    return changed(new, old).select("typelistname").distinct()


def one_list(all_lists: DataFrame, name: str) -> DataFrame:
    return all_lists.where(F.col("typelistname") == name).drop("typelistname")
