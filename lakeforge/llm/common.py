"""Small helpers that several operators share."""
from __future__ import annotations

import ctypes
import sys
import tempfile
from collections.abc import Callable, Iterable, Iterator
from typing import Any

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

#: What counts as white space in all word and line rules here: space and \t \n \v \f \r.
SPACE = b" \t\n\x0b\x0c\r"
PART_BYTES = 64 << 20  # bytes of text for each partition of dealt arrays, at most on average
HELD_BYTES = 8 << 20  # of arrays that a task gathers before it deals them


def let(value: Column, body: Callable[[Column], Column]) -> Column:
    """body of a value that is computed once. An array stays as it was made, so that slice() takes no longer for a long
    one: of a column's array, each slice() copies all of it first."""
    return F.element_at(F.transform(F.array(value), body), 1)


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def held_out(doc_id: str = "doc_id") -> Column:
    """True for the quarter of documents that no model may learn from."""
    return F.coalesce(F.crc32(F.col(doc_id).cast("string")) % 4 == 2, F.lit(False))


def cut(df: DataFrame) -> DataFrame:
    """The same rows from a reliable checkpoint in the cluster's shared folder; a temporary folder only where
    the session names none and all of it runs on this machine. Shuffle files of the way there go once it is written, and
    not when the driver happens to collect its garbage; the session's setting for that is put back."""
    sc = df.sparkSession.sparkContext
    if not sc.getCheckpointDir():
        shared = df.sparkSession.conf.get("spark.checkpoint.dir", None)
        if not shared and not sc.master.startswith("local["):
            raise ValueError("spark.checkpoint.dir must name a folder that all executors share")
        sc.setCheckpointDir(shared or tempfile.mkdtemp(prefix="lakeforge-"))
    conf, name = df.sparkSession.conf, "spark.sql.classic.shuffleDependency.fileCleanup.enabled"
    held = conf.get(name, "false")
    conf.set(name, "true")
    try:
        return df.select("*").checkpoint(eager=True)  # a plan of its own: df may be run again
    finally:
        conf.set(name, held)


def without(docs: DataFrame, ids: DataFrame, *, broadcast_rows: int = 1_000_000) -> DataFrame:
    """docs without the rows whose doc_id is among ids(doc_id), which are broadcast where there are at most
    broadcast_rows (8 bytes each), else shuffled. A null doc_id is never among them."""
    ids = cut(ids.select("doc_id").distinct())
    if ids.count() <= broadcast_rows:
        return docs.join(F.broadcast(ids), "doc_id", "left_anti").select(docs.columns)
    kept = docs.where("doc_id IS NOT NULL").join(ids, "doc_id", "left_anti").select(docs.columns)
    return kept.unionByName(docs.where("doc_id IS NULL"))


def parts(df: DataFrame, size: int = 0) -> int:
    """How many partitions to deal rows of numpy arrays to: as many as the session's shuffles have, and more where
    `size` bytes of input would give one more than PART_BYTES."""
    return max(int(df.sparkSession.conf.get("spark.sql.shuffle.partitions")), -(-size // PART_BYTES))


def text_size(docs: DataFrame) -> tuple[int, int]:
    """Rows and bytes of text, from a scan of the one column inside the JVM; filters and partitions are sized by them."""
    r = docs.agg(F.count("*").alias("n"), F.coalesce(F.sum(F.octet_length("text")), F.lit(0)).alias("size")).first()
    return int(r["n"]), int(r["size"])


def once_per_worker(key: tuple, make: Callable[[], Any]) -> Any:
    """make()'s value, kept in the Python worker for its later tasks. A worker holds one value: another key's goes
    before the new one is made, so that what stages before needed doesn't add up."""
    held = sys.__dict__.setdefault("_lakeforge_held", {})
    if key not in held:
        held.clear()
        tidy()
        held[key] = make()
    return held[key]


def tidy() -> None:
    """Gives freed memory back to the system, as workers live on between tasks; for the end of a task, not for each slice,
    as pages that are given back are zeroed again when they are next needed."""
    pa.default_memory_pool().release_unused()
    try:
        ctypes.CDLL(None).malloc_trim(0)
    except (AttributeError, OSError):  # only this C library has it
        pass


def slices(batches: Iterator[pa.RecordBatch], column: str, most: int = 1 << 20) -> Iterator[pa.RecordBatch]:
    """The batches in pieces of about `most` bytes of text at most (one row at least), to bound a worker's memory."""
    for batch in batches:
        text = batch.column(column)
        if not len(text):
            continue
        ends = np.cumsum(np.asarray(pc.binary_length(text).fill_null(0), dtype=np.int64) + 8)
        lo = 0
        while lo < len(text):
            hi = max(lo + 1, int(np.searchsorted(ends, (ends[lo - 1] if lo else 0) + most, side="right")))
            yield batch.slice(lo, hi - lo)
            lo = hi
    tidy()


def text_bytes(text: pa.Array) -> tuple[np.ndarray, np.ndarray]:
    """UTF-8 of all rows one after another, each followed by one newline, and where each row starts (n + 1 places).
    A null is an empty text."""
    kind = pa.large_string()
    joined = pc.binary_join_element_wise(text.cast(kind).fill_null(""), pa.scalar("", kind), pa.scalar("\n", kind))
    joined = joined.combine_chunks() if isinstance(joined, pa.ChunkedArray) else joined
    offsets = np.frombuffer(joined.buffers()[1], dtype=np.int64)[joined.offset : joined.offset + len(joined) + 1]
    data = np.frombuffer(joined.buffers()[2], dtype=np.uint8) if joined.buffers()[2] else np.zeros(0, np.uint8)
    return data[offsets[0] : offsets[-1]], offsets - offsets[0]


def mix(x: np.ndarray) -> np.ndarray:
    """A bijective mixer of 64-bit values (the finaliser of splitmix64)."""
    x = x ^ (x >> np.uint64(30))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    x = x ^ (x >> np.uint64(27))
    x = x * np.uint64(0x94D049BB133111EB)
    return x ^ (x >> np.uint64(31))


def word_spans(data: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Starts and ends (exclusive) of the maximal runs of bytes that aren't SPACE."""
    blank = np.zeros(256, bool)
    blank[list(SPACE)] = True
    edge = np.diff(np.concatenate(([True], blank[data], [True])).view(np.int8))
    return np.flatnonzero(edge == -1), np.flatnonzero(edge == 1)


def lower_ascii(data: np.ndarray) -> np.ndarray:
    to = np.arange(256, dtype=np.uint8)
    to[65:91] += 32
    return to[data]


def word_hashes(data: np.ndarray, start: np.ndarray, end: np.ndarray) -> np.ndarray:
    """A 64-bit hash of each word's bytes, eight bytes a step."""
    eights = np.ndarray((len(data) + 1,), "<u8", np.concatenate((data, np.zeros(16, np.uint8))).data, 0, (1,))
    length = (end - start).astype(np.uint64)
    out = mix(length + np.uint64(0x9E3779B97F4A7C15))
    left, at, rows = length.astype(np.int64), start.copy(), np.arange(len(start))
    while len(rows):
        part = eights[at[rows]]
        short = np.minimum(left[rows], 8).astype(np.uint64) * np.uint64(8)
        part = np.where(short == 64, part, part & ((np.uint64(1) << (short % np.uint64(64))) - np.uint64(1)))
        out[rows] = mix(out[rows] * np.uint64(0x9E3779B97F4A7C15) + part)
        at[rows] += 8
        left[rows] -= 8
        rows = rows[left[rows] > 0]
    return out


def gram_hashes(words: np.ndarray, n: int) -> np.ndarray:
    """Hash of each n consecutive word hashes; len(words) - n + 1 of them."""
    if len(words) < n:
        return np.zeros(0, np.uint64)
    out = np.full(len(words) - n + 1, n, np.uint64)
    for k in range(n):
        out = out * np.uint64(0xD1342543DE82EF95) + words[k : len(words) - n + 1 + k]
    return mix(out)


def dealt(token: np.ndarray, columns: dict[str, np.ndarray], deal: int, key: np.ndarray | None = None, runs: dict[str, np.ndarray] | None = None) -> pa.RecordBatch:
    """One row for each of `deal` partitions: the hashes that belong to it, by themselves or by a key beside them, and
    their columns, as bytes. runs: arrays that have, for each hash, as many values as its column n says (none below 0)."""
    part = ((token if key is None else key) >> np.uint64(24)) % np.uint64(deal)
    order = np.argsort(part, kind="stable")
    ends = np.searchsorted(part[order], np.arange(deal + 1, dtype=np.uint64))
    full = np.flatnonzero(np.diff(ends)).tolist()
    cells = {k: [v[order[ends[i] : ends[i + 1]]].tobytes() for i in full] for k, v in ({"t": token} | columns).items()}
    if runs:
        size = np.maximum(columns["n"].astype(np.int64), 0)
        begin, own = (np.cumsum(size) - size)[order], size[order]
        stop = np.cumsum(own)
        at = np.arange(stop[-1] if len(stop) else 0) + np.repeat(begin - (stop - own), own)
        edge = np.concatenate(([0], stop))[ends]
        cells |= {k: [v[at[edge[i] : edge[i + 1]]].tobytes() for i in full] for k, v in runs.items()}
    return pa.record_batch([pa.array(full, pa.int32()), *(pa.array(x, pa.binary()) for x in cells.values())], ["p", *cells])


def dealt_out(pieces: Iterable[dict[str, np.ndarray]], deal: int, runs: tuple[str, ...] = ()) -> Iterator[pa.RecordBatch]:
    """dealt() of arrays (t, its columns, runs and, if they are dealt by another hash, key) that come in pieces:
    they are gathered up to HELD_BYTES first, so that the rows are few and long however many partitions there are."""
    held: list[dict[str, np.ndarray]] = []
    size = 0

    def flushed() -> Iterator[pa.RecordBatch]:
        if held:
            all_of = {k: np.concatenate([x[k] for x in held]) for k in held[0]}
            held.clear()
            yield dealt(all_of.pop("t"), all_of, deal, all_of.pop("key", None), {k: all_of.pop(k) for k in runs})

    for piece in pieces:
        if len(piece["t"]):
            held.append(piece)
            size += sum(v.nbytes for v in piece.values())
        if size >= HELD_BYTES:
            yield from flushed()
            size = 0
    yield from flushed()
    tidy()


def gathered(batches: Iterator[pa.RecordBatch], kinds: dict[str, str]) -> dict[str, np.ndarray]:
    """The columns of all rows that reached this partition; each batch is let go once its bytes are copied."""
    cells: dict[str, list[np.ndarray]] = {k: [np.zeros(0, np.uint8)] for k in kinds}
    for b in batches:
        for k in kinds:
            cells[k].append(all_bytes(b.column(k)))
    return {k: np.concatenate(cells.pop(k)).view(kind) for k, kind in kinds.items()}


def all_bytes(column: pa.Array) -> np.ndarray:
    """A copy of the bytes of all rows of a binary column, one after another; a null has none."""
    whole = column.cast(pa.large_binary())
    if not len(whole) or whole.buffers()[2] is None:
        return np.zeros(0, np.uint8)
    ends = np.frombuffer(whole.buffers()[1], np.int64)[whole.offset : whole.offset + len(whole) + 1]
    return np.frombuffer(whole.buffers()[2], np.uint8)[ends[0] : ends[-1]].copy()
