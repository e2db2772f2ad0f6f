"""One query for each operator, over its whole table, with production parameters."""
from __future__ import annotations

from collections.abc import Callable
from pathlib import Path

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from lakeforge.llm import decontaminate, fingerprints, html_extraction, language_id, line_dedup, ngram_join, packing, prefix_trie, quality, secret_scan, spelling, substring_dedup, token_counts
from lakeforge.llm.common import held_out, table

QUERIES: dict[str, Callable[[SparkSession, str], DataFrame]] = {}
ORACLES: dict[str, str] = {}


def query(f: Callable[[SparkSession, str], DataFrame]) -> Callable[[SparkSession, str], DataFrame]:
    QUERIES[f.__name__] = f
    return f


def documents(spark: SparkSession, sf_dir: str, name: str = "documents") -> DataFrame:
    """The documents (or pages), dealt to all cores where their files have fewer splits than there are cores; a scan of no
    column tells."""
    docs, cores = table(spark, sf_dir, name), spark.sparkContext.defaultParallelism
    splits = (docs.select(F.spark_partition_id().alias("p")).agg(F.max("p")).first()[0] or 0) + 1
    return docs.repartition(cores) if splits < cores else docs


def vocabulary(name: str) -> bytes:
    import public_tokenizers

    return Path(public_tokenizers.path(name)).read_bytes()


@query
def op1_token_counts(spark: SparkSession, sf_dir: str) -> DataFrame:
    return token_counts.count_tokens(documents(spark, sf_dir), vocabulary("piece_bpe_32k.model"))


@query
def op9_packing(spark: SparkSession, sf_dir: str) -> DataFrame:
    return packing.pack(documents(spark, sf_dir), vocabulary("byte_bpe_50k.json")).drop("ids")


@query
def op2_line_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    kept = line_dedup.drop_repeated_lines(documents(spark, sf_dir))
    return kept.select("doc_id", "n_lines", "n_dropped", F.sha2("kept", 256).alias("kept_sha256"))


ORACLES["op2_line_dedup"] = r"""
WITH lines AS (
  SELECT doc_id, unnest(string_split(coalesce(text, ''), chr(10))) AS line,
         generate_subscripts(string_split(coalesce(text, ''), chr(10)), 1) AS n
  FROM documents),
keyed AS (
  SELECT *, translate(trim(line, E' \t\n\x0b\x0c\r'), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz') AS key FROM lines),
repeated AS (
  SELECT key, max(doc_id) AS keeper FROM keyed WHERE length(key) >= 40 GROUP BY key HAVING count(DISTINCT doc_id) >= 5),
marked AS (
  SELECT k.doc_id, k.n, k.line, r.keeper IS NOT NULL AND r.keeper <> k.doc_id AS gone FROM keyed k LEFT JOIN repeated r USING (key))
SELECT doc_id, count(*) AS n_lines, count(*) FILTER (gone) AS n_dropped,
       sha256(coalesce(string_agg(line, chr(10) ORDER BY n) FILTER (NOT gone), '')) AS kept_sha256
FROM marked GROUP BY doc_id
"""


@query
def op7_language_id(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = documents(spark, sf_dir)
    out = language_id.identify(docs, docs.where(~held_out()))
    return out.select("doc_id", held_out().alias("held_out"), "lang_pred", "score")


@query
def op8_quality(spark: SparkSession, sf_dir: str) -> DataFrame:
    labels = table(spark, sf_dir, "labels").where(~held_out())
    out = quality.score_quality(documents(spark, sf_dir), labels)
    return out.select("doc_id", held_out().alias("held_out"), "score", "predicted")


@query
def op3_ngram_jaccard_join(spark: SparkSession, sf_dir: str) -> DataFrame:
    return ngram_join.jaccard_components(documents(spark, sf_dir))


ORACLES["op3_ngram_jaccard_join"] = r"""
WITH RECURSIVE listed AS (
  SELECT doc_id, regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[^\x20\x09-\x0D]+') AS w
  FROM documents),
sets AS (
  SELECT doc_id, list_distinct(CASE WHEN len(w) >= 5 THEN list_transform(range(1, len(w) - 3), lambda i: array_to_string(w[i:i + 4], ' '))
                                    WHEN len(w) > 0 THEN [array_to_string(w, ' ')] ELSE [] END) AS s
  FROM listed),
shingles AS (SELECT doc_id, len(s) AS n, unnest(s) AS t FROM sets),
links AS (
  SELECT a.doc_id AS x, b.doc_id AS y FROM shingles a JOIN shingles b ON a.t = b.t AND a.doc_id <> b.doc_id
  GROUP BY a.doc_id, b.doc_id, a.n, b.n HAVING 100 * count(*) >= 80 * (a.n + b.n - count(*))),
reached AS (SELECT x, y FROM links UNION SELECT r.x, l.y FROM reached r JOIN links l ON r.y = l.x)
SELECT doc_id, CAST(len(s) AS BIGINT) AS n_shingles, least(doc_id, coalesce((SELECT min(y) FROM reached WHERE x = doc_id), doc_id)) AS component_id,
       (SELECT count(*) FROM links WHERE x = doc_id) AS n_links
FROM sets
"""


@query
def op6_substring_dedup(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = substring_dedup.remove_repeats(documents(spark, sf_dir))
    return out.select("doc_id", "n_words", "n_removed", F.sha2("kept", 256).alias("kept_sha256"))


ORACLES["op6_substring_dedup"] = r"""
WITH listed AS (SELECT doc_id, regexp_extract_all(coalesce(text, ''), '[^\x20\x09-\x0D]+') AS w FROM documents),
windows AS (
  SELECT doc_id, i, array_to_string(w[i:i + 12], ' ') AS g
  FROM (SELECT doc_id, w, unnest(range(1, len(w) - 11)) AS i FROM listed WHERE len(w) >= 13)),
firsts AS (SELECT g, min(doc_id) AS first FROM windows GROUP BY g),
gone AS (SELECT DISTINCT doc_id, unnest(range(i, i + 13)) AS p FROM windows JOIN firsts USING (g) WHERE first < doc_id),
words AS (SELECT doc_id, unnest(w) AS word, generate_subscripts(w, 1) AS p FROM listed),
kept AS (SELECT doc_id, string_agg(word, ' ' ORDER BY p) AS kept, count(*) AS n FROM words ANTI JOIN gone USING (doc_id, p) GROUP BY doc_id)
SELECT doc_id, CAST(len(w) AS BIGINT) AS n_words, len(w) - coalesce(n, 0) AS n_removed, sha256(coalesce(kept, '')) AS kept_sha256
FROM listed LEFT JOIN kept USING (doc_id)
"""


@query
def op10_document_fingerprints(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = fingerprints.fingerprint_edited(documents(spark, sf_dir))
    return out.withColumn("edited_sha256", F.sha2("edited", 256)).drop("edited")


@query
def op4_secret_scan(spark: SparkSession, sf_dir: str) -> DataFrame:
    out = secret_scan.scan(documents(spark, sf_dir))
    return out.withColumn("base_sha256", F.sha2("base", 256)).drop("base")


@query
def op5_benchmark_decontamination(spark: SparkSession, sf_dir: str) -> DataFrame:
    return decontaminate.contaminated(documents(spark, sf_dir), table(spark, sf_dir, "benchmark"))


@query
def op11_spelling_variants(spark: SparkSession, sf_dir: str) -> DataFrame:
    return spelling.group_variants(documents(spark, sf_dir))


def sql_crc32(text: str) -> str:
    """DuckDB's expression of the crc32 of a string's UTF-8 bytes, half a byte a step."""
    steps = []
    for k in range(16):
        for _ in range(4):
            k = k >> 1 ^ (0xEDB88320 if k & 1 else 0)
        steps.append(k)
    halves = f"list_transform(range(0, len(hex({text}))), lambda i: CAST(position(substr(hex({text}), xor(i, 1) + 1, 1) IN '0123456789ABCDEF') - 1 AS BIGINT))"
    ones = "CAST(4294967295 AS BIGINT)"
    return f"xor({ones}, list_reduce({halves}, lambda c, b: xor(c >> 4, {steps}[(xor(c, b) & 15) + 1]), {ones}))"


ORACLES["op11_spelling_variants"] = rf"""
WITH RECURSIVE runs AS (
  SELECT coalesce(CAST(doc_id AS VARCHAR), '') || ':' AS d,
         unnest(regexp_extract_all(translate(coalesce(text, ''), 'ABCDEFGHIJKLMNOPQRSTUVWXYZ', 'abcdefghijklmnopqrstuvwxyz'), '[a-z\x{{00C0}}-\x{{00FF}}]{{6,}}')) AS r
  FROM documents),
hashed AS (SELECT r, n, {sql_crc32("d || r")} AS h FROM (SELECT d, r, count(*) AS n FROM runs GROUP BY d, r)),
words AS (
  SELECT word, CAST(sum(n) AS BIGINT) AS n
  FROM (SELECT n, CASE WHEN h % 199 = 0 THEN substr(r, 1, h % length(r)) || substr(r, h % length(r) + 2) ELSE r END AS word FROM hashed)
  WHERE length(word) >= 6 GROUP BY word HAVING sum(n) >= 5),
less AS (SELECT word, n, i, substr(word, 1, i) || substr(word, i + 2) AS rest FROM (SELECT word, n, unnest(range(0, length(word))) AS i FROM words)),
near AS (
  SELECT a.word AS x, b.word AS y, b.n FROM less a JOIN less b ON a.rest = b.rest AND a.i = b.i AND a.word <> b.word
  UNION SELECT l.word, w.word, w.n FROM less l JOIN words w ON l.rest = w.word
  UNION SELECT w.word, l.word, l.n FROM less l JOIN words w ON l.rest = w.word),
best AS (SELECT x, count(*) AS n_near, max(n) AS most, min(y) FILTER (n = top) AS y FROM (SELECT *, max(n) OVER (PARTITION BY x) AS top FROM near) GROUP BY x),
formed AS (SELECT word, n, coalesce(n_near, 0) AS n_near, CASE WHEN most >= 5 * n THEN y END AS form, CASE WHEN most >= 5 * n THEN most END AS form_n FROM words LEFT JOIN best ON x = word),
followed AS (
  SELECT word, coalesce(form, word) AS far, 1 AS steps FROM formed
  UNION ALL SELECT f.word, g.form, steps + 1 FROM followed f JOIN formed g ON f.far = g.word WHERE g.form IS NOT NULL)
SELECT word, form, root, n, n_near, form_n
FROM formed JOIN (SELECT word, arg_max(far, steps) AS root FROM followed GROUP BY word) USING (word)
"""


@query
def op12_conversation_prefix_trie(spark: SparkSession, sf_dir: str) -> DataFrame:
    return prefix_trie.prefix_trie(table(spark, sf_dir, "conversations")).drop("node")


ORACLES["op12_conversation_prefix_trie"] = rf"""
WITH turns AS (
  SELECT conv_id, row_number() OVER (PARTITION BY conv_id ORDER BY turn NULLS FIRST) AS k, {{'role': coalesce(role, ''), 'text': coalesce(text, '')}} AS what
  FROM conversations WHERE conv_id IS NOT NULL),
listed AS (SELECT conv_id, list(what ORDER BY k) AS own, {sql_crc32("CAST(conv_id AS VARCHAR)")} % 6 AS h FROM turns GROUP BY conv_id),
built AS (
  SELECT c.conv_id, list_concat(coalesce(b.own[1:c.h], []), c.own[c.h + 1:]) AS seq
  FROM listed c LEFT JOIN listed b ON b.conv_id = c.conv_id - c.conv_id % 100),
members AS (SELECT conv_id, seq, unnest(range(0, len(seq) + 1)) AS d FROM built),
nodes AS (
  SELECT seq[1:d] AS path, d, min(conv_id) AS conv_id, count(*) AS n_convs,
         string_agg(CAST(conv_id AS VARCHAR), ',' ORDER BY conv_id) FILTER (len(seq) = d) AS ends
  FROM members GROUP BY seq[1:d], d),
kids AS (SELECT path[1:d - 1] AS path, count(*) AS n_children FROM nodes WHERE d > 0 GROUP BY path[1:d - 1]),
told AS (
  SELECT n.*, coalesce(n_children, 0) AS n_children, CASE WHEN d > 0 THEN (n_convs - 1) * length(n.path[d].text) ELSE 0 END AS own
  FROM nodes n LEFT JOIN kids k ON n.path = k.path),
sums AS (
  SELECT path[1:k] AS path, count(*) FILTER (n_children = 0) AS n_leaves, CAST(sum(own) AS BIGINT) AS saved_tokens
  FROM (SELECT *, unnest(range(0, d + 1)) AS k FROM told) GROUP BY path[1:k])
SELECT t.conv_id, t.d AS depth, up.conv_id AS parent_conv_id, t.n_convs, t.n_children, n_leaves, saved_tokens, sha256(coalesce(t.ends, '')) AS ends_sha256
FROM told t JOIN sums s ON t.path = s.path LEFT JOIN nodes up ON t.d > 0 AND up.path = t.path[1:t.d - 1]
"""


@query
def op13_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    return html_extraction.extract(documents(spark, sf_dir, "pages"))
