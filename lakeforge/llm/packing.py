"""Mixture-controlled packing by deficit round-robin over source queues.

Documents become token ids plus an end id and wait in one queue for each source. Time runs in rounds; a round is a
sequence, of `window` tokens, unless `mixture` asks for another size. Each token is due at a time that its number in
its queue and the queue's share tell; a round sends those due first, exactly as many as it holds, each queue's in one
run. So every sequence has the shares, and what rounding kept from a queue in one round it gets in a later one,
whichever task or partition holds the next document. The place of a token follows from its number in its queue alone,
so tasks place their documents independently: they need the queues' totals and the number of tokens that tasks before
them put in each queue.

By default each source's share is its share of all tokens; all queues then end together. With other targets a
queue that ends leaves its share to those that remain.
"""
from __future__ import annotations

import hashlib
import json
import re
import warnings
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from lakeforge.llm.common import cut, once_per_worker, slices

#: White space of Unicode; a text is split only before a space that none of these follows.
BLANKS = "".join(c for c in map(chr, range(0x3001)) if c.isspace())


class Ids(dict):
    """Chunk -> its ids as bytes; full, it stays as it is."""

    def __init__(self, encode, most, before):
        self.encode, self.most, self.before = encode, most, before

    def __missing__(self, chunk):
        ids = self.encode(self.before + chunk)
        if len(self) < self.most and len(chunk) <= 64:
            self[chunk] = ids
        return ids


def byte_ranks(spec: dict) -> dict[bytes, int] | None:
    """The vocabulary as ranks of byte strings, where merges come in the order of their ids; else None."""
    codes = [*range(33, 127), *range(161, 173), *range(174, 256)]
    byte_of = {chr(c): c for c in codes} | {chr(256 + k): c for k, c in enumerate(c for c in range(256) if c not in codes)}
    vocab = spec["model"]["vocab"]
    pairs = [m.split(" ") if isinstance(m, str) else m for m in spec["model"]["merges"]]
    first = len(byte_of)
    if sorted(vocab.get(c, -1) for c in byte_of) != list(range(first)) or any(vocab.get(a + b) != first + k for k, (a, b) in enumerate(pairs)):
        return None
    return {bytes(byte_of[c] for c in w): i for w, i in vocab.items() if i < first + len(pairs)}


def id_encoder(file: bytes, kind: str, cache: int):
    """text -> ids as bytes. Byte-level BPE is encoded by chunks that a space begins, through a cache: its rule for
    pre-tokens always begins one at a space that no white space follows. All else is encoded whole."""
    held: list = []

    def whole():
        """The library's own tokenizer, made when a text asks for it."""
        if not held:
            from tokenizers import Tokenizer

            held.append(Tokenizer.from_str(file.decode()))
            held[0].no_padding(), held[0].no_truncation()
        return held[0]

    encode = lambda text: np.array(whole().encode(text, add_special_tokens=False).ids, kind).tobytes()
    spec = json.loads(file)
    pre = spec.get("pre_tokenizer") or {}
    if spec["model"]["type"] != "BPE" or spec.get("normalizer") or pre.get("type") != "ByteLevel" or pre.get("add_prefix_space") or not pre.get("use_regex", True):
        return encode
    special = [x["content"] for x in spec.get("added_tokens", [])]
    ranks, short = byte_ranks(spec), encode
    if ranks:
        import tiktoken

        rule = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""
        same = tiktoken.Encoding("same", pat_str=rule, mergeable_ranks=ranks, special_tokens={}).encode_ordinary
        short = lambda text: np.array(same(text), kind).tobytes() if len(text) < 500 else encode(text)
    first, later = Ids(short, cache // 8, ""), Ids(short, cache, " ")

    def run(text: str) -> bytes:
        if any(s in text for s in special):
            return encode(text)
        odd = text[-1:] == " " or any(" " + b in text for b in BLANKS)
        chunks = re.split(r" (?=\S)", text) if odd else text.split(" ")
        return first[chunks[0]] + b"".join(map(later.__getitem__, chunks[1:]))

    return run


def phases(totals: list[int], weights: list[int], mixture: int) -> dict:
    """How the queues are served: {n: tokens by queue, rate: tokens by unit of time, start: time of the first one, early:
    by queue, what its tokens are ahead, so that equal queues don't all wait for the same moment; at, served: tokens
    that have been due by a time, between these times in proportion; mixture}. Queues without a weight follow the
    others, in proportion to what they hold; a queue that ends leaves its share to those that remain."""
    n, w = np.array(totals, np.int64), np.array([w if t else 0 for t, w in zip(totals, weights)], np.float64)
    late = (w == 0) & (n > 0)
    end = (n[w > 0] / w[w > 0]).max(initial=0.0)
    rate, start = np.where(w > 0, w, np.maximum(n, 1)), np.where(late, end, 0.0)
    stop = start + n / rate
    at, slope, place = [0.0], float(rate[(n > 0) & ~late].sum()), [0.0]
    order = np.argsort(stop, kind="stable")
    for q in order[n[order] > 0].tolist():
        if late[q]:
            break
        place.append(place[-1] + slope * (stop[q] - at[-1]))
        at.append(float(stop[q]))
        slope = max(slope - float(rate[q]), 0.0)
    if late.any():
        at.append(float(end) + 1.0)
        place.append(float(n.sum()))
    return {"n": n, "rate": rate, "start": start, "early": (np.arange(len(n)) + 0.5) / max(len(n), 1), "at": np.array(at), "served": np.array(place), "mixture": mixture}


def due(plan: dict, time: np.ndarray) -> np.ndarray:
    """Tokens of each queue (column) that are due before each time (row)."""
    x = np.ceil((time[:, None] - plan["start"]) * plan["rate"] - plan["early"])
    return np.clip(x, 0, plan["n"]).astype(np.int64)


def quotas(plan: dict, rounds: np.ndarray) -> np.ndarray:
    """Tokens of each queue (column) that the rounds before each of `rounds` (row) send: those due first, of tokens due
    at once those of lower queues. All but the last round send exactly `mixture` tokens."""
    want, room = np.minimum(rounds * plan["mixture"], plan["n"].sum()), len(plan["n"]) + 1
    when = lambda x: np.interp(x, plan["served"], plan["at"])
    lo, hi = when(want - room), when(want + room)
    lo[due(plan, lo).sum(1) > want] = 0.0
    hi[due(plan, hi).sum(1) < want] = 2 * plan["at"][-1] + 1
    sent = due(plan, lo)
    todo = np.flatnonzero(sent.sum(1) < want)
    while len(todo):
        mid = (lo[todo] + hi[todo]) / 2
        todo, mid = todo[fresh := (mid > lo[todo]) & (mid < hi[todo])], mid[fresh]
        got = due(plan, mid)
        fits = got.sum(1) <= want[todo]
        lo[todo[fits]], hi[todo[~fits]], sent[todo[fits]] = mid[fits], mid[~fits], got[fits]
        todo = todo[~fits | (got.sum(1) < want[todo])]
    tied = np.flatnonzero(sent.sum(1) < want)
    if len(tied):
        more = due(plan, hi[tied]) - sent[tied]
        sent[tied] += np.clip((want[tied] - sent[tied].sum(1))[:, None] - (np.cumsum(more, 1) - more), 0, more)
    return sent


def runs(plan: dict, queue: np.ndarray, first: np.ndarray, n: np.ndarray, cells: int = 1 << 17) -> Iterator[tuple[np.ndarray, ...]]:
    """(document, start in it, length, place among all tokens) of the runs of documents whose first tokens are their
    queues' tokens number `first`; at most about `cells` counts of queues are held at a time."""
    mixture, slack = plan["mixture"], 2 * len(plan["n"]) // plan["mixture"] + 2
    near = lambda x: (np.interp(plan["start"][queue] + x / plan["rate"][queue], plan["at"], plan["served"]) // mixture).astype(np.int64)
    last = max(-(-int(plan["n"].sum()) // mixture) - 1, 0)
    lo, hi = np.maximum(near(first) - slack, 0), np.minimum(near(first + n) + slack, last)
    size = np.maximum(hi - lo + 1, 0)
    doc = np.repeat(np.arange(len(n)), size)
    rounds = np.arange(len(doc)) - np.repeat(np.cumsum(size) - size, size) + lo[doc]
    order = np.argsort(rounds, kind="stable")
    doc, rounds = doc[order], rounds[order]
    each, begin = np.unique(rounds, return_index=True)
    begin, step = np.append(begin, len(rounds)), max(cells // max(len(plan["n"]), 1), 1)
    for k in range(0, len(each), step):
        some = each[k : k + step]
        edges = np.unique(np.concatenate((some, some + 1)))
        sent = quotas(plan, edges)
        at = np.searchsorted(edges, some)
        low, high = sent[at], sent[at + 1]
        ahead = np.cumsum(high - low, 1) - (high - low)
        here = slice(begin[k], begin[min(k + step, len(each))])
        d, row = doc[here], np.searchsorted(some, rounds[here])
        q = queue[d]
        a, b = np.maximum(low[row, q], first[d]), np.minimum(high[row, q], first[d] + n[d])
        kept = b > a
        place = rounds[here] * mixture + ahead[row, q] + a - low[row, q]
        yield d[kept], (a - first[d])[kept], (b - a)[kept], place[kept]


def places(plan: dict, mixture: int, queue: int, start: int, n: int) -> Iterator[tuple[int, int, int]]:
    """(start in the document, length, place among all tokens) of the runs of a document whose first token is the
    queue's token number `start`; mixture is the plan's."""
    for _, at, length, place in runs(plan | {"mixture": mixture}, np.array([queue]), np.array([start]), np.array([n])):
        yield from zip(at.tolist(), length.tolist(), place.tolist())


def pack(docs: DataFrame, tokenizer: bytes, *, window: int = 1024, mixture: int | None = None, end_id: int = 0, targets: dict[str, int] | None = None, max_queues: int = 1024, cache: int = 1 << 16, broadcast_rows: int = 100_000) -> DataFrame:
    """Pieces of the packed sequences: doc_id, start, length, ids_crc32, doc_tokens, sequence_id, offset, ids (binary,
    little-endian, of 2 bytes for vocabularies up to 65,536, else of 4).

    docs has doc_id, text and source. tokenizer: the bytes of a tokenizers file. A null text counts as empty: its
    piece has the end id alone. Each source has a queue of its own, however many there are, and documents with a null
    source share one; beyond max_queues a warning tells that CPU grows with their number. targets(source -> share; ""
    is the null source's) raise where no document has the source. Null doc_ids are kept; rows that repeat are packed as often;
    other columns are ignored; an empty table gives no pieces. A long text fills as many sequences as it needs. Of tokens
    due at once, those of the source that is first by name (the null source before all) go first.
    """
    spark = docs.sparkSession
    most = max([*json.loads(tokenizer)["model"]["vocab"].values(), end_id])
    kind = "<u2" if most < 65536 else "<u4"
    shared = spark.sparkContext.broadcast(tokenizer)
    tag = ("ids", hashlib.sha256(tokenizer).hexdigest(), kind, cache)
    queue = F.when(F.col("source").isNull(), "").otherwise(F.concat(F.lit("="), F.col("source").cast("string")))

    def encoded(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        encode = once_per_worker(tag, lambda: id_encoder(shared.value, kind, cache))
        task, end, width = TaskContext.get().partitionId(), np.array([end_id], kind).tobytes(), int(kind[-1])
        ahead: dict[str, int] = {}
        for batch in slices(batches, "text"):
            names = batch.column("queue").to_pylist()
            ids = [encode(t or "") + end for t in batch.column("text").to_pylist()]
            counts, before = [len(x) // width for x in ids], []
            for q, n in zip(names, counts):
                before.append(ahead.get(q, 0))
                ahead[q] = before[-1] + n
            cols = [batch.column("doc_id"), pa.array(names, pa.string()), pa.array([task] * len(ids), pa.int32()), pa.array(before, pa.int64()), pa.array(counts, pa.int64()), pa.array(ids, pa.binary())]
            yield pa.record_batch(cols, ["doc_id", "queue", "task", "before", "n", "ids"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), queue.alias("queue"), "text")
    tokens = cut(rows.mapInArrow(encoded, "doc_id long, queue string, task int, before long, n long, ids binary"))
    by_task = tokens.groupBy("queue", "task").agg(F.sum("n").alias("n"))
    sizes = cut(by_task.groupBy("queue").agg(F.sum("n").alias("total")).withColumn("number", F.row_number().over(Window.orderBy("queue")) - 1))
    totals = np.asarray(sizes.orderBy("number").select("total").toArrow().column("total")).tolist()
    if len(totals) > max_queues:
        warnings.warn(f"{len(totals)} sources are mixed: CPU seconds a sequence grow with their number")
    weights = totals
    if targets is not None:
        asked = sizes.where(F.substring("queue", 2, 1 << 30).isin(list(targets))).select("queue", "number").collect()
        lost = set(targets) - {r["queue"][1:] for r in asked}
        if totals and lost:
            raise ValueError(f"no document has the sources {sorted(lost)} of targets")
        weights = [0] * len(totals)
        for r in asked:
            weights[r["number"]] = int(targets[r["queue"][1:]])
    plan = spark.sparkContext.broadcast(phases(totals, weights, mixture or window))
    ahead = Window.partitionBy("queue").orderBy("task").rowsBetween(Window.unboundedPreceding, -1)
    starts = by_task.withColumn("first", F.coalesce(F.sum("n").over(ahead), F.lit(0))).drop("n").join(sizes.select("queue", "number"), "queue")
    if by_task.count() <= broadcast_rows:
        starts = F.broadcast(starts)

    def packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        width = int(kind[-1])
        for batch in slices(batches, "ids"):
            doc, ids = batch.column("doc_id"), batch.column("ids").to_pylist()
            n, queue = np.asarray(batch.column("n")), np.asarray(batch.column("number")).astype(np.int64)
            for d, at, length, place in runs(plan.value, queue, np.asarray(batch.column("first")), n):
                times = (place + length - 1) // window - place // window + 1  # a run may cross windows where rounds aren't windows
                d, at, length, place = (np.repeat(x, times) for x in (d, at, length, place))
                cuts = (np.arange(len(d)) - np.repeat(np.cumsum(times) - times, times) + place // window) * window
                begin, end = np.maximum(place, cuts), np.minimum(place + length, cuts + window)
                at, length, place = at + begin - place, end - begin, begin
                for lo in range(0, len(d), 20_000):
                    p = slice(lo, lo + 20_000)
                    parts = [ids[k][x * width : y * width] for k, x, y in zip(d[p].tolist(), at[p].tolist(), (at[p] + length[p]).tolist())]
                    sums = [zlib.crc32(x) for x in parts] if width == 4 else [zlib.crc32(np.frombuffer(x, kind).astype("<u4").tobytes()) for x in parts]
                    cols = [doc.take(pa.array(d[p])), pa.array(at[p]), pa.array(length[p]), pa.array(sums, pa.int64()), pa.array(n[d[p]]), pa.array(place[p] // window), pa.array(place[p] % window), pa.array(parts, pa.binary())]
                    yield pa.record_batch(cols, ["doc_id", "start", "length", "ids_crc32", "doc_tokens", "sequence_id", "offset", "ids"])

    joined = tokens.join(starts, ["queue", "task"]).select("doc_id", "number", (F.col("first") + F.col("before")).alias("first"), "n", "ids")
    return joined.mapInArrow(packed, "doc_id long, start long, length long, ids_crc32 long, doc_tokens long, sequence_id long, offset long, ids binary")
