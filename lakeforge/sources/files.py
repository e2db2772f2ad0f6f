"""File sources: parquet with lineage, header-less text, XML."""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T


def parquet_with_lineage(spark: SparkSession, path: str) -> DataFrame:
    """Rows with the path of the file that holds them."""
    return spark.read.parquet(path).withColumn("source_file", F.col("_metadata.file_path"))


def footer_bounds(spark: SparkSession, path: str, column: str) -> DataFrame:
    """One row low, high of a column of whole numbers or dates, from the files' footers alone: no row is read. It belongs to
    a session of its own, in which Parquet is asked for that; the caller's settings stay."""
    own = spark.newSession()
    own.conf.set("spark.sql.sources.useV1SourceList", "")
    own.conf.set("spark.sql.parquet.aggregatePushdown", "true")
    return own.read.parquet(path).agg(F.min(column).alias("low"), F.max(column).alias("high"))


def tsv(spark: SparkSession, path: str, schema: T.StructType | str) -> DataFrame:
    """Tab-delimited rows without a header; malformed ones are dropped."""
    return spark.read.csv(path, schema=schema, sep="\t", header=False, mode="DROPMALFORMED")


def fixed_width(spark: SparkSession, path: str, fields: list[tuple[str, int, int]]) -> DataFrame:
    """Text rows cut at (name, first character from 1, length), trimmed."""
    return spark.read.text(path).select(*(F.trim(F.substring("value", a, n)).alias(name) for name, a, n in fields))


def table(spark: SparkSession, name: str, fallback: str | None = None) -> DataFrame:
    """A catalog table, or another one where it doesn't exist (a plain copy for a secured one)."""
    return spark.table(name if fallback is None or spark.catalog.tableExists(name) else fallback)


def xml(spark: SparkSession, path: str, row_tag: str, schema: T.StructType | str, xsd: str | None = None) -> DataFrame:
    """Documents of one kind; what doesn't parse, or the XSD rejects, has its text in _corrupt_record."""
    options = {"rowTag": row_tag, "mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record", **({"rowValidationXSDPath": xsd} if xsd else {})}
    return spark.read.format("xml").options(**options).schema(schema).load(path).withColumn("source_file", F.col("_metadata.file_path"))


def xml_lines(spark: SparkSession, path: str, schema: str) -> DataFrame:
    """Documents of one kind, one on each line of text files; what doesn't parse is in _corrupt_record."""
    parsed = F.from_xml("value", f"{schema}, _corrupt_record string", {"mode": "PERMISSIVE", "columnNameOfCorruptRecord": "_corrupt_record"})
    lines = spark.read.text(path).select("value", F.col("_metadata.file_path").alias("source_file"))
    return lines.select(parsed.alias("d"), "source_file").select("d.*", "source_file")


def unseen(files: DataFrame, seen: DataFrame, column: str = "source_file") -> DataFrame:
    """Rows of files that no earlier run has parsed."""
    return files.join(seen.select(column).distinct(), column, "left_anti")


def rejected(raw: DataFrame, loaded: DataFrame, key: str) -> DataFrame:
    """Keys that the raw file has and the loaded rows don't."""
    return raw.select(key).subtract(loaded.select(key))
