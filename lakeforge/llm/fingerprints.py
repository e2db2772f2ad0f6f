"""Document fingerprints by winnowing, in DataFrame functions only.

Words are runs without white space, except that letters of scripts that are written without blanks stand alone, as do all
characters of runs of over LONGEST characters (minified code, base64, long names), so that no cut depends on where a run
starts. Every run of k words has a cyclic polynomial hash: the words' hashes, each rotated by one bit more than the one
after it, put together by exclusive or. It is built from the hashes of shorter runs, of 4 from two of 2 and of 5 from one
of 4 and a word, so each takes log2(k) steps and not k. Of each `window` runs in a row the least hash is kept, the
rightmost of equal ones, with its place. Two texts that share k + window - 1 words in a row share a fingerprint.
"""
from __future__ import annotations

import json

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from lakeforge.llm.common import let, parts, text_size

#: Scripts that are written without blanks.
UNSPACED = "Han Hiragana Katakana Thai Lao Khmer Myanmar"
LONGEST = 32
PLACE_BITS = 30  # an array has fewer than 2^31 / 2 words, so a place fits


def words(text: Column) -> Column:
    """The text's words; a plain split unless some part needs more."""
    alone = "".join(rf"\p{{Is{x}}}" for x in UNSPACED.split())
    spaced = F.when(text.rlike(f"[{alone}]"), F.regexp_replace(text, f"([{alone}])", " $1 ")).otherwise(text)
    plain = lambda x: F.array_remove(F.split(x, r"[\x20\x09-\x0D]+", -1), "")
    apart = lambda x: F.flatten(F.transform(plain(x), lambda w: F.when(F.length(w) > LONGEST, F.array_remove(F.split(w, ""), "")).otherwise(F.array(w))))
    return F.when(text.rlike(rf"[^\x20\x09-\x0D]{{{LONGEST + 1}}}"), apart(spaced)).otherwise(plain(spaced))


def rotated(x: Column, bits: int) -> Column:
    return F.shiftleft(x, bits).bitwiseOR(F.shiftrightunsigned(x, 64 - bits)) if bits else x


def runs_of(k: int, hashed: Column) -> Column:
    """The hashes of all runs of k words, from those of runs of half as many, or of one word less and the last word."""
    if k == 1:
        return hashed
    half = k // 2 if k % 2 == 0 else k - 1
    count = lambda x: F.greatest(F.size(x) - (k - half), F.lit(0))
    other = lambda x: F.slice(x if k % 2 == 0 else hashed, half + 1, count(x))
    return let(runs_of(half, hashed), lambda x: F.zip_with(F.slice(x, F.lit(1), count(x)), other(x), lambda y, z: rotated(y, k - half).bitwiseXOR(z)))


def with_winnowed(df: DataFrame, text: str, out: str, k: int, window: int) -> DataFrame:
    """Adds array<struct<h: long, at: int>> `out`: the runs that winnowing keeps of column `text`, in order, with the
    place of their first words from 0; empty without words.

    Least is a run's hash by its upper 33 bits, and of equal ones the rightmost; the hash that is given has all 64, so
    texts are of any length that a column holds. Fewer than k words are one run, fewer runs than `window` one window."""
    hashed, runs, kept = f"{out}__hashed", f"{out}__runs", f"{out}__kept"
    n = F.size(hashed)
    short = F.aggregate(hashed, F.lit(0).cast("long"), lambda x, w: rotated(x, 1).bitwiseXOR(w))
    all_runs = F.when(n >= k, runs_of(k, F.col(hashed))).when(n > 0, F.array(short)).otherwise(F.array().cast("array<long>"))
    last = (1 << PLACE_BITS) - 1
    packed = F.transform(runs, lambda h, i: F.shiftleft(F.shiftrightunsigned(h, 1 + PLACE_BITS), PLACE_BITS).bitwiseOR(F.lit(last) - i))
    df = df.withColumn(hashed, F.transform(words(F.col(text)), lambda w: F.xxhash64(w))).withColumn(runs, all_runs)
    windows = lambda x: F.sequence(F.lit(1), F.greatest(F.size(x) - (window - 1), F.lit(1)))
    least = lambda x: F.array_distinct(F.transform(windows(x), lambda j: F.array_min(F.slice(x, j, window))))
    df = df.withColumn(kept, let(packed, least))
    at = lambda x: (F.lit(last) - x.bitwiseAND(F.lit(last))).cast("int")
    found = F.transform(kept, lambda x: F.struct(F.element_at(runs, at(x) + 1).alias("h"), at(x).alias("at")))
    return df.withColumn(out, F.when(F.size(runs) > 0, found).otherwise(F.array().cast("array<struct<h:bigint,at:int>>"))).drop(hashed, runs, kept)


def hashes(kept: Column) -> Column:
    return F.array_distinct(kept["h"])


def written(kept: Column) -> Column:
    """hash:place of each, hash in hex and place (of the run's first word, from 0) in decimal, comma-joined."""
    return F.array_join(F.transform(kept, lambda x: F.concat(F.lower(F.hex(x["h"])), F.lit(":"), x["at"].cast("string"))), ",")


def likeness(a: str, b: str) -> Column:
    """Jaccard similarity of two sets of hashes; 1 for two empty ones."""
    both = F.size(F.array_intersect(a, b))
    return F.when(F.size(a) + F.size(b) == 0, 1.0).otherwise(both / (F.size(a) + F.size(b) - both))


def neighbours(docs: DataFrame) -> DataFrame:
    """docs(doc_id, text) dealt to ranges of doc_id, each row with its range (`bucket`) and `ghost`: a copy that the
    range above gets as its last row's next document (the whole order's first row is the last one's).

    Each range ends with a doc_id that exists, the greatest of a range that Spark sampled, so only those rows are copied.
    There are as many ranges as shuffle partitions, and more where the texts' bytes ask for them; their ends (8 bytes each)
    reach the driver and are two literals of the plan."""
    n = parts(docs, text_size(docs)[1])
    known = docs.where("doc_id is not null")
    sampled = known.select("doc_id").repartitionByRange(n, "doc_id").groupBy(F.spark_partition_id()).agg(F.max("doc_id").alias("b"))
    ends = sorted({r["b"] for r in sampled.collect()})
    # two levels of bounds, so that a row is compared with about 2 * sqrt(n) of them
    step = max(1, round(len(ends) ** 0.5))
    fine = F.from_json(F.lit(json.dumps([ends[i : i + step] for i in range(0, len(ends), step)])), "array<array<long>>")
    coarse = F.from_json(F.lit(json.dumps(ends[step - 1 :: step][: (len(ends) - 1) // step])), "array<long>")
    below = lambda bounds: F.size(F.filter(bounds, lambda b: b < F.col("doc_id")))
    if not ends:
        return known.withColumns({"bucket": F.lit(0), "ghost": F.lit(False)})
    group = below(coarse) if len(ends) > step else F.lit(0)
    placed = known.withColumn("group", group).withColumn("own", F.col("group") * step + below(F.element_at(fine, F.col("group") + 1))).drop("group")
    last = F.element_at(F.element_at(fine, (F.col("own") / step).cast("int") + 1), F.pmod(F.col("own"), F.lit(step)) + 1) == F.col("doc_id")
    above = F.struct(F.pmod(F.col("own") + 1, F.lit(len(ends))).alias("bucket"), F.lit(True).alias("ghost"))
    own = F.struct(F.col("own").alias("bucket"), F.lit(False).alias("ghost"))
    return placed.withColumn("to", F.explode(F.when(last, F.array(own, above)).otherwise(F.array(own)))).select("doc_id", "text", "to.bucket", "to.ghost").repartitionById(n, "bucket")


def fingerprint(docs: DataFrame, *, k: int = 5, window: int = 8) -> DataFrame:
    """doc_id, n_chars, fingerprint for every row of docs(doc_id, text, ...); see fingerprint_edited()."""
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    return with_winnowed(rows, "text", "own", k, window).select("doc_id", F.length("text").cast("long").alias("n_chars"), written(F.col("own")).alias("fingerprint"))


def fingerprint_edited(docs: DataFrame, *, k: int = 5, window: int = 8) -> DataFrame:
    """doc_id, n_chars, edited (text), fingerprint, edited_fingerprint, near_edited, near_next for every row of
    docs(doc_id, text, ...).

    The edited text has its last floor(n_chars / 3) code points replaced by the first as many (or all) of the next
    document's, by falling doc_id, the last one's next being the first. A null text counts as empty; an empty text has
    an empty fingerprint, and two empty fingerprints are alike (1). Rows that share a doc_id follow each other by
    falling text. A row with a null doc_id has an empty text as its next. A row alone is its own next. Of equal hashes in
    a window the rightmost is kept. Other columns are ignored; an empty table gives no rows. Texts are read whole, of any
    length that a column holds.
    """
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), F.coalesce("text", F.lit("")).alias("text"))
    order = Window.partitionBy("bucket").orderBy("ghost", F.desc("doc_id"), F.desc("text"))
    own = with_winnowed(neighbours(rows), "text", "own", k, window)
    own = own.withColumn("next_text", F.lead("text").over(order)).withColumn("next", F.lead("own").over(order)).where("not ghost").drop("bucket", "ghost")
    alone = with_winnowed(rows.where("doc_id is null"), "text", "own", k, window).withColumn("next_text", F.lit("")).withColumn("next", F.array().cast("array<struct<h:bigint,at:int>>"))
    both = own.unionByName(alone).withColumn("n_chars", F.length("text").cast("long"))
    cut = F.floor(F.col("n_chars") / 3).cast("int")
    both = both.withColumn("edited", F.concat(F.substring("text", F.lit(1), F.col("n_chars").cast("int") - cut), F.substring("next_text", F.lit(1), cut))).drop("text", "next_text")
    both = with_winnowed(both, "edited", "new", k, window)
    both = both.withColumns({"a": hashes(F.col("own")), "b": hashes(F.col("new")), "c": hashes(F.col("next"))})
    return both.select("doc_id", "n_chars", "edited", written(F.col("own")).alias("fingerprint"), written(F.col("new")).alias("edited_fingerprint"), likeness("a", "b").alias("near_edited"), likeness("a", "c").alias("near_next"))
