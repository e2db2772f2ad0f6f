"""The training-data pipeline: documents in, packed sequences out.

STAGES are applied in order; each gets what the one before kept. All but the last return the columns of documents.
Rows that share a doc_id stay or go together; a row with a null doc_id is kept by every stage that picks by doc_id.
Repeated rows are all kept or all go; an empty table goes through as an empty table; whole texts are read, however long.

Every stage bounds the Arrow batches that Python workers get, for its session (spark.sql.execution.arrow.maxBytesPerBatch,
BATCH_BYTES at most): JVM and worker hold a batch at the same time, for each core.
"""
from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeforge.llm import decontaminate, language_id, line_dedup, ngram_join, packing, queries
from lakeforge.llm.common import cut, held_out, table, without

BATCH_BYTES = 4 << 20

#: The first stage is a learnt classifier, which SQL can't express; tests hold the run against a brute-force version.
ORACLE_SQL = None


def small_batches(spark: SparkSession) -> None:
    """A setting that is lower already stays."""
    name = "spark.sql.execution.arrow.maxBytesPerBatch"
    held = spark._jvm.org.apache.spark.network.util.JavaUtils.byteStringAsBytes(spark.conf.get(name))
    spark.conf.set(name, min(held, BATCH_BYTES))


def identify_language(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents whose language can't be told, for want of text or of letters, go; so do null and empty texts. A tie
    between languages rejects nothing."""
    small_batches(spark)
    told = language_id.identify(docs, docs.where(~held_out()))
    return without(docs, told.where("lang_pred = 'und'"))


def dedup_lines(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Lines that five documents or more have go, but from the last one of them; n_chars follows. Null and empty
    texts become one empty line; the largest doc_id is the last one, so there are no ties."""
    small_batches(spark)
    kept = line_dedup.drop_repeated_lines(docs, carry=True).select("doc_id", F.col("kept").alias("text"), "carried.*")
    return kept.withColumn("n_chars", F.length("text").cast("long")).select(docs.columns)


def keep_one_of_each_group(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Of the documents that n-gram Jaccard links connect, the one with the smallest doc_id stays. Null and empty texts and
    those without words are linked with nothing and stay; rows that share the smallest doc_id all stay."""
    small_batches(spark)
    return without(docs, ngram_join.jaccard_components(docs).where("doc_id <> component_id"))


def decontaminate_benchmark(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """Documents that hold a benchmark item go; null and empty texts hold none, null and empty items are in none. A
    document that holds several items goes once."""
    small_batches(spark)
    return without(docs, decontaminate.contaminated(docs, table(spark, sf_dir, "benchmark")))


def pack_sequences(spark: SparkSession, docs: DataFrame, sf_dir: str) -> DataFrame:
    """The pieces of sequences of 1024 tokens at most, mixed by source. Null and empty texts are their end id alone; null
    sources share a queue; tokens due at once go in order of their sources' names."""
    small_batches(spark)
    return packing.pack(docs, queries.vocabulary("byte_bpe_50k.json")).drop("ids")


STAGES = [
    ("language_id", identify_language),
    ("line_dedup", dedup_lines),
    ("ngram_jaccard_join", keep_one_of_each_group),
    ("decontamination", decontaminate_benchmark),
    ("packing", pack_sequences),
]


def run(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = queries.documents(spark, sf_dir)
    for _, stage in STAGES[:-1]:
        docs = cut(stage(spark, docs, sf_dir))
    return STAGES[-1][1](spark, docs, sf_dir)
