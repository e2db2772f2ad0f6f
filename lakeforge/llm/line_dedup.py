"""Line dedup with two Bloom filters, for hashes seen once and hashes seen twice.

The hashes of lines' keys are dealt to partitions, 8 bytes for each distinct line of a slice of documents. A partition
puts its hashes in a filter of once-seen ones, as large as they ask for; a hash whose bits are all set there goes to the
filter of twice-seen ones. So the filters grow with the input and no key that two documents hold can be missing from the
twice-seen one, which is broadcast, up to a bounded size. Only lines in that filter are shuffled, with their text: exact
counts of documents confirm them and choose the document that keeps them. With a full filter more lines are suspected
and shuffled; results stay exact.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from lakeforge.llm.common import cut, dealt_out, once_per_worker, parts, slices, text_size

ONCE_BITS = 16  # of the once-seen filter, for each hash that a partition gets


def key_of(line: bytes, least: int) -> bytes | None:
    """The line without white space at its ends, A-Z lower-cased; None if it has fewer than `least` code points."""
    key = line.strip(b" \t\n\x0b\x0c\r").lower()
    return key if len(key) >= least and (key.isascii() or len(key.decode()) >= least) else None


def text_keys(text: bytes, least: int) -> list[bytes | None]:
    return [key_of(x, least) for x in text.split(b"\n")]


def slice_keys(batch: pa.RecordBatch, least: int) -> tuple[list[bytes], np.ndarray, np.ndarray]:
    """The distinct keys of each text of a slice, their 64-bit hashes and their rows."""
    keys: list[bytes] = []
    count = []
    for text in batch.column("text").cast(pa.large_binary()).to_pylist():
        own = set(text_keys(text or b"", least)) - {None}
        keys += own
        count.append(len(own))
    return keys, np.array([xxhash.xxh3_64_intdigest(k) for k in keys], np.uint64), np.repeat(np.arange(len(count)), count)


def places(h: np.ndarray, bits: int) -> np.ndarray:
    """Two places in a filter for each hash."""
    return np.stack((h % np.uint64(bits), (h >> np.uint64(32)) * np.uint64(0x9E3779B1) % np.uint64(bits)), 1).astype(np.int64)


def within(held: np.ndarray, h: np.ndarray, bits: int) -> np.ndarray:
    at = places(h, bits)
    return (held[at >> 3] >> (at & 7).astype(np.uint8) & 1).all(1)


def put(held: np.ndarray, h: np.ndarray, bits: int) -> None:
    at = places(h, bits).ravel()
    np.bitwise_or.at(held, at >> 3, np.uint8(1) << (at & 7).astype(np.uint8))


def twice_seen(docs: DataFrame, least: int, deal: int, side: int) -> dict[int, bytes]:
    """By partition that hashes are dealt to: its filter of twice-seen ones, of `side` bits, compressed."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
        for batch in slices(batches, "text"):
            h, n = np.unique(slice_keys(batch, least)[1], return_counts=True)
            yield {"t": h, "m": (n > 1).astype("u1")}

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return dealt_out(pieces(batches), deal)

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells, part = [], 0
        for batch in batches:
            part = batch.column("p")[0].as_py() if len(batch) else part
            cells += zip(batch.column("t").to_pylist(), batch.column("m").to_pylist())
        bits = max(64, ONCE_BITS * sum(len(t) // 8 for t, _ in cells))
        once, twice = np.zeros(-(-bits // 8), np.uint8), np.zeros(-(-side // 8), np.uint8)
        for t, m in cells:
            h, back = np.unique(np.frombuffer(t, np.uint64), return_inverse=True)
            again = within(once, h, bits) | (np.bincount(back, np.frombuffer(m, "u1").astype(float) + 1) > 1)
            put(once, h, bits)
            put(twice, h[again], side)
        if twice.any():
            yield pa.record_batch([pa.array([part], pa.int32()), pa.array([zlib.compress(twice.tobytes(), 1)], pa.binary())], ["p", "twice"])

    dealt_rows = docs.select("text").mapInArrow(spread, "p int, t binary, m binary").repartitionById(deal, "p")
    return {r["p"]: bytes(r["twice"]) for r in dealt_rows.mapInArrow(merge, "p int, twice binary").collect()}


def suspected(docs: DataFrame, least: int, deal: int, bits: int) -> DataFrame:
    """doc_id, key of the lines whose keys may occur in two documents or more; once for each document."""
    side = max(bits // deal, 64)
    shared = docs.sparkSession.sparkContext.broadcast(twice_seen(docs, least, deal, side))
    tag, width = ("twice", shared._jbroadcast.id()), -(-side // 8)

    def unpacked() -> np.ndarray:
        out = np.zeros((deal, width), np.uint8)
        for p, x in shared.value.items():
            out[p] = np.frombuffer(zlib.decompress(x), np.uint8)
        return out

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        twice = once_per_worker(tag, unpacked)
        for batch in slices(batches, "text"):
            keys, h, row = slice_keys(batch, least)
            at, part = places(h, side), ((h >> np.uint64(24)) % np.uint64(deal)).astype(np.int64)
            hit = np.flatnonzero((twice[part[:, None], at >> 3] >> (at & 7).astype(np.uint8) & 1).all(1))
            yield pa.record_batch([batch.column("doc_id").take(pa.array(row[hit])), pa.array([keys[k] for k in hit.tolist()], pa.binary())], ["doc_id", "key"])

    return docs.where(F.col("doc_id").isNotNull()).select("doc_id", "text").mapInArrow(probe, "doc_id long, key binary")


def rewritten(text: bytes, drop, least: int) -> tuple[int, int, str]:
    lines = text.split(b"\n")
    keep = [x for x in lines if not ((k := key_of(x, least)) is not None and drop(k))]
    return len(lines), len(lines) - len(keep), b"\n".join(keep).decode()


def drop_repeated_lines(docs: DataFrame, *, min_chars: int = 40, min_docs: int = 5, bits: int | None = None, broadcast_bytes: int = 16 << 20, carry: bool = False) -> DataFrame:
    """doc_id, n_lines, n_dropped, kept (text) for every row of docs(doc_id, text, ...).

    A key of min_chars code points or more that at least min_docs documents (distinct doc_ids) hold loses all its
    lines except in the largest doc_id holding it; rows that share that doc_id all keep it. A null or empty text is
    one empty line. Rows with a null doc_id are returned as they are and count for nothing; rows that repeat are each
    returned; other columns are ignored; an empty table gives none. Whole texts are read, however long.

    There are no ties: the largest doc_id keeps its lines, at all their places. With carry, the struct `carried` holds the
    row's other columns. The confirmed keys are broadcast where they take at most broadcast_bytes, else joined. bits: size
    of the twice-seen filter; by default one for each byte of text, from 2^24 to 2^29 (64 MB).
    """
    spark = docs.sparkSession
    others = [F.col(f"`{c}`") for c in docs.columns if c not in ("doc_id", "text")] if carry else []
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.struct(*others or [F.lit(0).alias("none")]).alias("carried"))
    n_bytes = text_size(rows)[1]
    bits = bits or 1 << min(29, max(24, n_bytes.bit_length()))
    found = suspected(rows, min_chars, parts(rows, n_bytes), bits)
    # distinct pairs first, then counts: no task gets all documents of a frequent key
    pairs = found.distinct()
    confirmed = cut(pairs.groupBy("key").agg(F.count("*").alias("n"), F.max("doc_id").alias("keeper")).where(F.col("n") >= min_docs).select("key", "keeper"))
    schema = T.StructType([T.StructField(n, T.LongType()) for n in ("doc_id", "n_lines", "n_dropped")] + [T.StructField("kept", T.StringType()), rows.schema["carried"]])
    names = schema.names
    kinds = [pa.int64(), pa.int64(), pa.int64(), pa.string()]
    size = confirmed.agg(F.sum(F.length("key") + 64).alias("n")).first()["n"] or 0

    if size <= broadcast_bytes:
        known = spark.sparkContext.broadcast({bytes(r["key"]): r["keeper"] for r in confirmed.collect()})

        def by_table(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
            keeper = known.value
            for batch in slices(batches, "text"):
                out = []
                for doc, text in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.large_binary()).to_pylist()):
                    drop = (lambda k: False) if doc is None else (lambda k: keeper.get(k, doc) != doc)
                    out.append((doc, *rewritten(text or b"", drop, min_chars)))
                yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, kinds)] + [batch.column("carried")], names)

        done = rows.mapInArrow(by_table, schema)
        return done if carry else done.drop("carried")

    lost = found.distinct().join(confirmed, "key").where("doc_id <> keeper").groupBy("doc_id").agg(F.collect_list("key").alias("lost"))

    def by_list(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            out = []
            for doc, text, gone in zip(batch.column("doc_id").to_pylist(), batch.column("text").cast(pa.large_binary()).to_pylist(), batch.column("lost").to_pylist()):
                out.append((doc, *rewritten(text or b"", set(gone or ()).__contains__, min_chars)))
            yield pa.record_batch([pa.array(c, t) for c, t in zip(zip(*out) if out else [[]] * 4, kinds)] + [batch.column("carried")], names)

    done = rows.join(lost, "doc_id", "left").mapInArrow(by_list, schema)
    return done if carry else done.drop("carried")
