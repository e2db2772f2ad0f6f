"""Secret scan with multipart credential linking, in DataFrame functions only.

Strong patterns are reported wherever they stand. Weak ones (an identifier, a random-looking string, an endpoint) are
reported only where parts that complete them stand within `scope` code points: an interval join of the parts of a
text on their places, as a range window.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F


def either(words: str) -> str:
    """The pattern with each letter in either case, of ASCII only."""
    return "".join(f"[{c.upper()}{c.lower()}]" if c.isalpha() else c for c in words)


GIVEN = r"""["']?\x20*[:=]\x20*["']?"""
#: Kind -> (pattern, group that must have 8 characters or 0), in the order in which kinds are listed.
#: access and hex ask for their least length in the pattern: a shorter run holds no longer one.
STRONG = {
    "assign": (f"({either('password|passwd|secret|token|api_?key')}){GIVEN}([A-Za-z0-9+/_.=-]+)", 2),
    "access": (r"AKIA[A-Z0-9]{12,}", 0),
    "hex": (r"[0-9a-f]{32,}", 0),
}
WEAK = {
    "identifier": (f"({either('user|username|login|account|client_?id|key_?id')}){GIVEN}([A-Za-z0-9+/_.@=-]+)", 0),
    "random": (r"[A-Za-z0-9+/_=-]{20,}", 0),
    "endpoint": (rf"{either('http')}[Ss]?://[^\x20\x09-\x0D\"'<>]+|({either('host|server|endpoint')}){GIVEN}([A-Za-z0-9.:/_-]+)", 0),
}
KINDS = {**STRONG, **WEAK}


def parts_of(text: Column, kind: str) -> Column:
    """An array of (kind, i, gap, size, good) of the kind's leftmost non-overlapping matches: gap is the code points
    since the match before. A text without a match is searched once."""
    pattern, group = KINDS[kind]
    gaps = F.split(text, pattern, -1)
    found = F.regexp_extract_all(text, F.lit(pattern), F.lit(0))
    value = F.regexp_extract_all(text, F.lit(pattern), F.lit(group))
    mixed = lambda x: x.rlike("[0-9]") & x.rlike("[a-z]") & x.rlike("[A-Z]")
    good = lambda m, v: F.length(v) >= 8 if group else mixed(m) if kind == "random" else F.lit(True)
    each = F.transform(
        F.arrays_zip(gaps.alias("gap"), found.alias("found"), value.alias("value")),
        lambda x, i: F.struct(F.lit(kind).alias("kind"), i.alias("i"), F.length(x["gap"]).cast("long").alias("gap"), F.length(x["found"]).cast("long").alias("size"), good(x["found"], x["value"]).alias("good")),
    )
    matches = F.slice(each, 1, F.size(each) - 1)  # the last gap has no match after it
    return F.when(text.rlike(pattern), matches).otherwise(F.expr("array()").cast("array<struct<kind:string,i:int,gap:bigint,size:bigint,good:boolean>>"))


def scan(docs: DataFrame, *, scope: int = 200) -> DataFrame:
    """doc_id, n_assign, n_access, n_hex, n_linked, base (string), spans (string) for every row of docs(doc_id, text, ...).

    base has kind:start:end of the strong matches by start, then kind as listed, comma-joined, in code points, the end
    exclusive; spans has the linked weak ones too. A weak match that overlaps a strong one isn't reported. An
    identifier needs a secret (assign, hex, random) in scope, a random string an identifier (access, identifier) or an
    endpoint, an endpoint both an identifier and a secret. A null text counts as empty and has none. A null doc_id is
    kept; rows that repeat are each returned; other columns are ignored; an empty table gives no rows. Texts are read
    whole, however long; a text's matches, not its words, are sorted together.
    """
    text = F.coalesce("text", F.lit(""))
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), text.alias("text"))
    found = rows.select("doc_id", F.xxhash64("text").alias("hash"), F.explode_outer(F.concat(*(parts_of(F.col("text"), k) for k in KINDS))).alias("m")).select("doc_id", "hash", "m.*")
    # rows that repeat have the same matches, which are taken once and given back as often; a row is known by what it
    # holds and not by a running number, which a task that runs again would give anew
    row = ["doc_id", "hash"]
    found = found.groupBy(*row, "kind", "i", "gap", "size", "good").agg(F.count("*").alias("copies"))
    own = Window.partitionBy(*row, "kind").orderBy("i")
    before = F.coalesce(F.sum("size").over(own.rowsBetween(Window.unboundedPreceding, -1)), F.lit(0))
    placed = found.repartition(*row).withColumn("start", F.sum("gap").over(own.rowsBetween(Window.unboundedPreceding, 0)) + before)
    placed = placed.withColumn("end", F.col("start") + F.col("size")).withColumn("strong", F.coalesce(F.col("kind").isin(*STRONG), F.lit(False)))
    # a match that fails its test counts for nothing, but its row stays for its document
    placed = placed.withColumn("kind", F.when(F.col("good"), F.col("kind")))
    by_start = Window.partitionBy(*row).orderBy("start")
    near = by_start.rangeBetween(-scope, scope)
    has = lambda *kinds: F.max(F.col("kind").isin(*kinds)).over(near)
    strong = F.col("strong") & F.col("kind").isNotNull()
    overlaps = (F.coalesce(F.max(F.when(strong, F.col("end"))).over(by_start.rowsBetween(Window.unboundedPreceding, 0)), F.lit(0)) > F.col("start")) | (
        F.coalesce(F.min(F.when(strong, F.col("start"))).over(by_start.rowsBetween(0, Window.unboundedFollowing)) < F.col("end"), F.lit(False))
    )
    linked = placed.withColumns({"an_id": has("access", "identifier"), "a_secret": has("assign", "hex", "random"), "a_place": has("endpoint"), "covered": overlaps})
    completes = F.expr("CASE kind WHEN 'identifier' THEN a_secret WHEN 'random' THEN an_id OR a_place WHEN 'endpoint' THEN an_id AND a_secret END")
    linked = linked.withColumn("weak", F.coalesce(completes & ~F.col("covered"), F.lit(False))).withColumn("base", strong)
    order = F.array_position(F.array(*map(F.lit, KINDS)), F.col("kind"))
    span = F.struct("start", order.alias("order"), "end", F.concat_ws(":", "kind", "start", "end").alias("s"))
    spans = lambda which: F.array_join(F.transform(F.sort_array(F.collect_list(F.when(which, span))), lambda x: x["s"]), ",")
    counts = [F.count(F.when(F.col("base") & (F.col("kind") == k), 1)).alias(f"n_{k}") for k in STRONG]
    out = linked.groupBy(*row).agg(F.max("copies").alias("copies"), *counts, F.count(F.when(F.col("weak"), 1)).alias("n_linked"), spans(F.col("base")).alias("base"), spans(F.col("base") | F.col("weak")).alias("spans"))
    return out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), F.col("copies")))).drop("hash", "copies", "copy")
