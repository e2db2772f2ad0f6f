"""Benchmark decontamination by template canonicalisation, in DataFrame functions only.

Numbers (in digits or words), units after numbers and names (runs of capitalised words) become typed placeholders.
Windows of the resulting templates are matched by hash; matches of one document and item at one offset, and at offsets close to each
other, are put together in order, and the values that their placeholders stand for must agree: windows with a value of
the item that stands for several values of the document count for nothing.
So a question whose numbers or names were exchanged is caught, and two texts that share a pattern by chance aren't.
"""
from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeforge.llm.common import cut, let

#: Words that are units where a number comes before them.
UNITS = "mm cm m km in ft mi mg g kg t oz lb ml l s sec second seconds min minute minutes h hour hours day days week weeks month months year years usd eur dollar dollars euro euros cent cents percent mph kmh km/h m/s am pm kwh w kw v hz mb gb tb"
#: Numbers in words; two of them with a hyphen are one, too.
COUNTS = "zero one two three four five six seven eight nine ten eleven twelve thirteen fourteen fifteen sixteen seventeen eighteen nineteen twenty thirty forty fifty sixty seventy eighty ninety hundred thousand million"
TENS, ONES = COUNTS.split()[20:28], COUNTS.split()[1:10]
NUMBER, NAME, UNIT = "<num>", "<name>", "<unit>"
BLANK = r"[\x20\x09-\x0D]"
WORD = r"[^\x20\x09-\x0D]"
END = rf"(?=[.,;:!?)\"']*(?:{BLANK}|$))"
CAPITALISED = rf"(?:^|{BLANK})(?:\p{{Lu}}{WORD}*{BLANK}+){{2}}\p{{Lu}}"  # three such words in a row


def readings(text: Column) -> Column:
    """The text, and where words in a row are capitalised, as in titles and capitals, its letters in lower case, too."""
    return F.when(text.rlike(CAPITALISED), F.array(text, F.lower(text))).otherwise(F.array(text))


def with_whole_names(text: Column) -> Column:
    """The text with a blank between a number and a unit that follows it at once, and with \\x01 for the blank between two
    capitalised words, so that a name of several words is one word."""
    apart = F.regexp_replace(text, rf"\d(?=(?i:{'|'.join(UNITS.split())}){END})", "$0 ")
    return F.regexp_replace(apart, rf"\x20(?=\p{{Lu}}[\p{{L}}'-])(?<=(?:^|{BLANK})\p{{Lu}}[\p{{L}}'-]{{1,30}}\x20)", "\x01")


def canonical(text: Column) -> Column:
    """The words of a text with whole names in lower case without marks after them, names and numbers of digits replaced;
    one word stays one word. Patterns begin with the character they look for, as few places have it."""
    unit = "|".join(f"(?<={u[0]}){u[1:]}" for u in UNITS.upper().split())  # after a number, these aren't names
    out = F.regexp_replace(text, rf"\p{{Lu}}(?<!{WORD}.)(?!(?<=\d\x20.)(?:{unit}){END})[\p{{L}}\x01'-]*{END}", NAME)
    out = F.regexp_replace(F.lower(out), rf"[\d$€£+-](?<!{WORD}.)(?:(?<=\d)|(?=\d))\d*(?:[.,:/]\d+)*%?{END}", NUMBER)
    return F.regexp_replace(out, rf"[.,;:!?](?<=[\p{{L}}\p{{N}}>].)[.,;:!?]*(?={BLANK}|$)", "")


def words(text: Column) -> Column:
    return F.array_remove(F.split(text, rf"{BLANK}+", -1), "")


def with_template(df: DataFrame) -> DataFrame:
    """Adds t, the template's words, of column text with whole names."""
    counts = [*COUNTS.split(), *(f"{x}-{y}" for x in TENS for y in ONES)]
    df = df.withColumn("t", F.transform(words(canonical(F.col("text"))), lambda x: F.when(x.isin(counts), NUMBER).otherwise(x)))
    unit = lambda x, i: x.isin(UNITS.split()) & (i > 0) & (F.element_at("t", F.greatest(i, F.lit(1))) == NUMBER)
    return df.withColumn("t", F.transform("t", lambda x, i: F.when(unit(x, i), UNIT).otherwise(x)))


def with_values(df: DataFrame) -> DataFrame:
    """Adds t (template words) and v (the word where t has a placeholder, else empty) of column text."""
    df = with_template(df.withColumn("text", with_whole_names(F.col("text")))).withColumn("w", words(F.col("text")))
    holder = lambda c: c.isin(NUMBER, NAME, UNIT)
    value = F.when(F.exists("t", holder), F.zip_with("w", "t", lambda w, c: F.when(holder(c), F.regexp_replace(w, r"[.,;:!?]+$", "")).otherwise("")))
    return df.withColumn("v", value).drop("w")


def starts(width: int) -> Column:
    return F.when(F.size("t") >= width, F.sequence(F.lit(1), F.size("t") - width + 1)).otherwise(F.array().cast("array<int>"))


def blocks(length: int, step: int) -> Column:
    """The hashes of the runs of `length` template words that start at every `step`-th word."""
    at = F.when(F.size("t") >= length, F.sequence(F.lit(1), F.size("t") - length + 1, F.lit(step))).otherwise(F.array().cast("array<int>"))
    return F.transform(at, lambda i: F.xxhash64(F.slice("t", i, length)))


def block_of(n: int) -> tuple[int, int]:
    """(length, step) of blocks of which any n words in a row hold a whole one: length + step = n + 1."""
    return n // 2 + 1, n - n // 2


def windows(width: int, literal: int) -> Column:
    """(h, at, v) of each window of `width` template words; v is null where the text has no placeholder. A window with
    fewer than `literal` words that aren't placeholders is known by its values too."""
    low = lambda i: F.col("v").isNotNull() & (F.size(F.array_remove(F.slice("v", i, width), "")) > width - min(literal, width))
    h = lambda i: F.when(low(i), F.xxhash64(F.slice("t", i, width), F.slice("v", i, width))).otherwise(F.xxhash64(F.slice("t", i, width)))
    return F.transform(starts(width), lambda i: F.struct(h(i).alias("h"), i.alias("at"), F.array_join(F.slice("v", i, width), " ").alias("v")))


def sized_windows(width: int, literal: int) -> Column:
    return F.transform(windows(width, literal), lambda x: F.struct(F.lit(width).alias("size"), x["h"].alias("h"), x["at"].alias("at"), x["v"].alias("v")))


def suspects(docs: DataFrame, items: DataFrame, lengths: list[int], broadcast_rows: int) -> DataFrame:
    """The rows of docs(doc_id, text) whose doc_id may have a window of an item's template, whatever its values: those with a
    block of one. Of a document only blocks at every few words are hashed; as any window holds such a block whole and
    items give theirs from every word on, none is missed. What else has a block is judged in vain.

    explode_outer(), as Spark lets explode() be preceded by a filter on its array's size, which would make the array twice
    and its parts once for each of their uses; a null hash meets nothing."""
    known = None
    for n in lengths:
        own = items.where(F.col("size") == n).select(F.explode_outer(blocks(block_of(n)[0], 1)).alias("h"))
        known = own if known is None else known.union(own)
    known = known.distinct()
    if known.count() <= broadcast_rows:
        known = F.broadcast(known)
    rows = with_template(docs.withColumn("text", with_whole_names(F.col("text")))).select("doc_id", "t")
    kinds = sorted({block_of(n) for n in lengths})
    found = rows.select("doc_id", F.explode_outer(F.concat(*(blocks(*x) for x in kinds)) if len(kinds) > 1 else blocks(*kinds[0])).alias("h")).join(known, "h", "left_semi")
    ids = cut(found.select("doc_id").distinct())
    return docs.join(F.broadcast(ids) if ids.count() <= broadcast_rows else ids, "doc_id", "left_semi")


def consistent(hits: Column) -> Column:
    """The hits, in order, that have no value of the item that stands for several values of the document."""
    pairs = F.array_distinct(F.flatten(F.transform(hits, lambda x: x["p"])))
    several = lambda names: F.filter(F.array_distinct(names), lambda a: F.size(F.filter(names, lambda x: x == a)) > 1)
    odd = let(F.transform(pairs, lambda x: x["a"]), several)
    return let(odd, lambda o: F.array_sort(F.filter(hits, lambda x: ~F.exists(x["p"], lambda y: F.array_contains(o, y["a"])))))


def contaminated(docs: DataFrame, benchmark: DataFrame, *, width: int = 8, literal: int = 4, coverage: float = 0.5, broadcast_rows: int = 500_000) -> DataFrame:
    """doc_id, item_id, n_windows, coverage, reworded of each pair of a document and a benchmark item that it holds.

    docs(doc_id, text, ...), benchmark(item_id, text, ...). A document holds an item when at least `coverage` of the
    item's windows of `width` template words match in the item's order with consistent values, at one offset or, where
    words came in or went, at offsets that differ by less than the item's length. Windows with fewer than `literal`
    words that aren't placeholders match by their values too; an item with fewer words is one window. reworded says that
    some value differs. A value of the item must stand for one value of the document; two of the item's values may stand
    for one, as numbers may meet by chance. A capitalised word is a name wherever it stands, also at a sentence's start; where
    three or more are in a row (titles, capitals) text and item are compared in lower case, too, in which nothing is a name.
    A unit may follow its number at once.

    Null or empty texts hold and match nothing, nor do rows with a null id; rows that repeat give one pair; other columns
    are ignored; empty tables give no pairs. Texts are read whole, however long. Of alignments that hold an item, the one
    with most windows tells n_windows and coverage; reworded is false if any of them is.

    A first pass finds the documents that have a block of a window of an item's template; values, offsets and order are judged for
    those. Item windows (hashes, places and values of `width` words each) and the documents' ids are broadcast where there
    are at most broadcast_rows, else both sides are shuffled.
    """
    items = benchmark.where("item_id is not null and text is not null").select("item_id", F.col("text").rlike(CAPITALISED).alias("titled"), F.posexplode(F.array("text", F.lower("text"))).alias("item_reading", "text"))
    items = with_values(items).where(F.size("t") > 0).drop("text")
    items = items.withColumn("size", F.least(F.size("t"), F.lit(width)))
    lengths = [r["size"] for r in items.select("size").distinct().collect()]  # width of them at most
    own_item, known = ["item_id", "item_reading", "titled"], None
    for n in lengths:
        own = items.where(F.col("size") == n).withColumn("x", F.explode(windows(n, literal))).select(*own_item, "size", "x.*")
        known = own if known is None else known.union(own)
    if known is None:
        return docs.sparkSession.createDataFrame([], "doc_id long, item_id long, n_windows long, coverage double, reworded boolean")
    total = known.groupBy("item_id", "item_reading").agg(F.count("*").alias("total"))
    known = known.join(total, ["item_id", "item_reading"]).select("h", "size", *own_item, F.col("at").alias("item_at"), F.col("v").alias("item_v"), "total")
    if known.count() <= broadcast_rows:
        known = F.broadcast(known)
    docs = docs.where("doc_id is not null and text is not null").select(F.col("doc_id").cast("long").alias("doc_id"), F.posexplode_outer(readings(F.col("text"))).alias("reading", "text"))
    rows = with_values(suspects(docs, items, lengths, broadcast_rows)).drop("text")
    if len(lengths) == 1:
        found = rows.select("doc_id", "reading", F.explode_outer(windows(lengths[0], literal)).alias("x")).select("doc_id", "reading", F.lit(lengths[0]).alias("size"), "x.*")
    else:
        found = rows.select("doc_id", "reading", F.explode_outer(F.concat(*(sized_windows(n, literal) for n in lengths))).alias("x")).select("doc_id", "reading", "x.*")
    pairs = F.arrays_zip(F.split(F.coalesce("item_v", F.lit("")), " ").alias("a"), F.split(F.coalesce("v", F.lit("")), " ").alias("b"))
    hit = F.struct("item_at", (-F.col("at")).alias("back"), F.filter(pairs, lambda x: F.coalesce(x["a"], F.lit("")) != "").alias("p"))
    hits = found.join(known, ["h", "size"]).where("reading = item_reading OR titled").select("doc_id", "reading", "item_id", "item_reading", "total", (F.col("at") - F.col("item_at")).alias("shift"), (F.col("total") + F.col("size")).alias("span"), hit.alias("hit"))

    # alignments: each offset, and offsets in ranges of twice the item's length that overlap by half; the latter hold an
    # item with words put in or left out, the former whole copies that lie side by side with other values
    near = F.floor(F.col("shift") / F.col("span"))
    ways = F.array(*(F.struct(F.lit(one).alias("one"), x.cast("long").alias("way")) for one, x in ((True, F.col("shift")), (False, near), (False, near - 1))))
    held = hits.withColumn("x", F.explode(ways)).groupBy("doc_id", "reading", "item_id", "item_reading", "x").agg(F.collect_set("hit").alias("hits"), F.max("total").alias("total"))
    held = held.where(F.size(F.array_distinct("hits.item_at")) >= F.col("total") * coverage)
    held = held.withColumn("hits", consistent(F.col("hits"))).where(F.size("hits") >= F.col("total") * coverage)
    # the longest run of windows in the order of both: last places of runs of 1, 2, ... windows, the least possible each
    put = lambda acc, at, k: F.concat(F.slice(acc, 1, k), F.array(at), F.slice(acc, k + 2, F.size(acc)))
    runs = F.aggregate(F.col("hits"), F.array().cast("array<int>"), lambda acc, x: put(acc, -x["back"], F.size(F.filter(acc, lambda y: y < -x["back"]))))
    held = held.withColumn("n_windows", F.size(runs).cast("long")).withColumn("share", F.col("n_windows") / F.col("total")).where(F.col("share") >= coverage)
    held = held.withColumn("reworded", F.exists(F.flatten("hits.p"), lambda x: ~x["a"].eqNullSafe(x["b"])))
    return held.groupBy("doc_id", "item_id").agg(F.max("n_windows").alias("n_windows"), F.max("share").alias("coverage"), F.min("reworded").alias("reworded"))
