"""Spelling variants by anagram hashing.

A word's key is the sum of a power of each of its letters' numbers, so anagrams share it, and a letter added, taken
away or exchanged changes it by one letter's value or by the difference of two. Each word is filed under its own key and
under its key less each of its letters: words whose keys differ by one letter's value meet at the shorter one's key, and
words that differ by an exchange meet at the key of what they have in common. Whether the letters left are in the same
order is verified where they meet. As one key may have very many anagrams, rows of a key are dealt on by a hash of the
order, so no pair is written that isn't near and no group holds more than the near words of one gap.
"""
from __future__ import annotations

import re
import zlib
from collections import Counter, defaultdict
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.llm.common import cut, slices

RUNS = "[a-zÀ-ÿ]{%d,}"
POWER = 5
PRIMES = (2147483647, 2147483629)  # of the hash of the letters' order
COUNTED = 1 << 17  # distinct words that a task counts before it passes them on
COUNTED_BYTES = 16 << 20


def count_words(docs: DataFrame, *, shortest: int, every: int) -> DataFrame:
    """word, n of each task's share of docs(doc_id, text); a run whose crc32 `every` divides has lost a letter."""
    find = re.compile(RUNS % shortest).findall

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total: Counter[str] = Counter()
        size = 0

        def counted() -> pa.RecordBatch:
            return pa.record_batch([pa.array(total.keys(), pa.string()), pa.array(total.values(), pa.int64())], ["word", "n"])

        for batch in slices(batches, "text"):
            for doc_id, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.large_binary()).to_pylist()):
                if not text:
                    continue
                begin = zlib.crc32(b"%s:" % (b"" if doc_id is None else str(doc_id).encode()))
                for word, n in Counter(find(text.lower().decode())).items():  # lower() of bytes is of A-Z alone
                    h = zlib.crc32(word.encode(), begin)
                    if h % every == 0:
                        k = h % len(word)
                        word = word[:k] + word[k + 1 :]
                        if len(word) < shortest:
                            continue
                    if word not in total:
                        size += len(word)
                    total[word] += n
                if len(total) >= COUNTED or size >= COUNTED_BYTES:
                    yield counted()
                    total, size = Counter(), 0
        if total:
            yield counted()

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "word string, n long")


def powers(base: int, prime: int, n: int) -> np.ndarray:
    out = np.ones(1, np.int64)
    while len(out) < n:
        out = np.concatenate((out, out * pow(base, len(out), prime) % prime))
    return out[:n]


def filed(words: pa.Array) -> dict[str, np.ndarray]:
    """For each word, a row with gap -1 for itself and one for each of its letters left out (gap: its place): row (of
    words), key and order (of the letters that stay), gap."""
    lengths = np.asarray(pc.utf8_length(words), np.int64)
    letters = np.frombuffer("".join(words.to_pylist()).encode("utf-32-le"), "<u4").astype(np.int64)
    row = np.repeat(np.arange(len(lengths)), lengths)
    begin = np.cumsum(lengths) - lengths
    gap = np.arange(len(letters)) - begin[row]
    value = (letters - 96).astype(np.uint64) ** np.uint64(POWER)
    key = np.add.reduceat(value, begin) if len(begin) else value
    own, less = np.zeros(len(lengths), np.int64), np.zeros(len(letters), np.int64)
    for prime, base, factor in zip(PRIMES, (1103515245, 1566083941), (48271, 69621)):
        term = letters * factor % prime * powers(base, prime, int(lengths.max(initial=0)))[gap] % prime
        upto = np.cumsum(term)
        before = upto - term
        before -= before[begin][row]
        total = np.add.reduceat(term, begin) if len(begin) else term
        after = (total[row] - before - term) % prime * pow(base, -1, prime) % prime
        own, less = own << 31 | total % prime, less << 31 | (before + after) % prime
    return {"row": np.concatenate((np.arange(len(lengths)), row)), "key": np.concatenate((key, key[row] - value)).view(np.int64), "order": np.concatenate((own, less)), "gap": np.concatenate((np.full(len(lengths), -1), gap))}


def file_words(words: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "word", 1 << 17):
            at = filed(batch.column("word"))
            row = pa.array(at["row"])
            yield pa.record_batch([pa.array(at["key"]), pa.array(at["order"]), pa.array(at["gap"]), batch.column("id").take(row), batch.column("n").take(row)], ["key", "order", "gap", "id", "n"])

    return words.select("word", "id", "n").mapInArrow(run, "key long, order long, gap long, id binary, n long")


def near_words(met: list[dict], ratio: int) -> Iterator[tuple[bytes, int, bytes | None, int | None]]:
    """Of the rows that share key and order: id, how many near words it has here, and each near word of largest n, if that is
    `ratio` times its own n (the number is in the first such row alone)."""
    at: dict[int, list[tuple[bytes, int]]] = defaultdict(list)
    for m in met:
        at[m["gap"]].append((m["id"], m["n"]))
    whole = at.pop(-1, [])
    near: dict[tuple[bytes, int], list[tuple[bytes, int]]] = defaultdict(list)
    for longer in {x for xs in at.values() for x in xs}:
        for w in whole:
            near[w].append(longer)
            near[longer].append(w)
    count = {w: len(xs) for w, xs in near.items()}
    for xs in at.values():
        if len(xs) > 1:
            most = max(n for _, n in xs)
            top = [x for x in xs if x[1] == most]
            for w in xs:
                count[w] = count.get(w, 0) + len(xs) - 1
                if most >= ratio * w[1]:  # w isn't among them
                    near[w] += top
    for w, k in count.items():
        most = max((n for _, n in near[w]), default=0)
        best = sorted({i for i, n in near[w] if n == most}) if most >= ratio * w[1] else []
        yield w[0], k, *((best[0], most) if best else (None, None))
        yield from ((w[0], 0, i, most) for i in best[1:])


def meet(rows: DataFrame, ratio: int) -> DataFrame:
    """id, n_near, near, near_n; a word has rows for each place where it met others."""
    groups = rows.groupBy("key", "order").agg(F.collect_list(F.struct("gap", "id", "n")).alias("met")).where(F.size("met") > 1)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for lo in range(0, len(batch), 1000):
                found = [x for met in batch.column("met").slice(lo, 1000).to_pylist() for x in near_words(met, ratio)]
                kinds = (pa.binary(), pa.int64(), pa.binary(), pa.int64())
                if found:
                    yield pa.record_batch([pa.array(x, kind) for x, kind in zip(zip(*found), kinds)], ["id", "n_near", "near", "near_n"])

    return groups.select("met").mapInArrow(run, "id binary, n_near long, near binary, near_n long")


def follow(links: DataFrame) -> DataFrame:
    """word, root from links(word, form): each round doubles the steps taken, until nobody moves. n grows along a link, so
    there is no circle, and with a ratio of 5 between them 27 links in a row lead past the largest long."""
    at = cut(links.select("word", F.col("form").alias("root")))
    while True:
        up = at.select(F.col("word").alias("root"), F.col("root").alias("far"))
        at = cut(at.select("word", "root").join(up, "root", "left").select("word", F.coalesce("far", "root").alias("root"), F.col("far").isNotNull().alias("moved")))
        if at.where("moved").isEmpty():
            return at.drop("moved")


def group_variants(docs: DataFrame, *, shortest: int = 6, least: int = 5, ratio: int = 5, every: int = 199) -> DataFrame:
    """word, form, root, n, n_near, form_n of every word of docs(doc_id, text, ...).

    Words are the runs of letters (A-Z lower-cased), some with a letter dropped as their crc32 says, that have at least
    `shortest` code points and occur `least` times or more. Near words differ by exactly one inserted, deleted or replaced
    code point. form is the near word of largest n, if that is `ratio` times the word's n or more (ties: the smallest in
    order of code points), else null, with form_n null; root is where following forms ends, the word itself without one.

    A null text has no words; a null doc_id counts as an empty one; rows that repeat are counted each; other columns are
    ignored; an empty docs gives no rows. Texts are read whole. A word of m letters is filed in m + 1 short rows that
    don't hold it, so very long words are no special case. Orders are compared by hashes of 62 bits within a key.
    """
    counts = count_words(docs, shortest=shortest, every=every).groupBy("word").agg(F.sum("n").alias("n")).where(F.col("n") >= least)
    words = cut(counts.withColumn("id", F.unhex(F.md5("word"))))
    met = cut(meet(file_words(words), ratio))
    numbers = met.groupBy("id").agg(F.sum("n_near").alias("n_near"))
    best = met.where("near IS NOT NULL").join(words.select(F.col("id").alias("near"), F.col("word").alias("form")), "near")
    best = best.groupBy("id").agg(F.min(F.struct((-F.col("near_n")).alias("less"), "form")).alias("best"))
    told = cut(words.join(numbers, "id", "left").join(best, "id", "left").select("word", "n", F.coalesce("n_near", F.lit(0)).alias("n_near"), F.col("best.form").alias("form"), (-F.col("best.less")).alias("form_n")))
    roots = follow(told.where("form IS NOT NULL"))
    return told.join(roots, "word", "left").select("word", "form", F.coalesce("root", "word").alias("root"), "n", "n_near", "form_n")
