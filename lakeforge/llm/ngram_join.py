"""Exact n-gram Jaccard join by a token-group matrix.

Documents with equal shingle sets are one node. Nodes that share rare shingles and are of like size form groups; the
matrix holds, for each group and shingle, whether one or more members have it (the group's token union). A query
node's overlap with a group's union bounds its overlap with every member, so only groups whose bound reaches the
threshold are opened. In an opened group all members are compared: sets become rows of a 0/1 matrix, whose product with
its transpose has every overlap. Large groups are cut into blocks of bounded rows and shingles, each block against each,
which go to tasks of their own. A block gives each node's number of links and a spanning forest of them, never the
pairs; so no link is lost and what is written grows with the nodes.

Which groups a query meets at all follows from prefix filtering: two sets of Jaccard `percent` share one of each
other's n - ceil(n * percent / 100) + 1 first shingles in any common order. The order puts shingles last that many
documents have; it comes from a sketch of fixed size, less what most of its cells hold by chance, which affects speed only.

Arrays of shingles are dealt to partitions by hash, many in one row, and matched there with numpy. Sets have 64-bit
hashes as members; a node is known by a 64-bit hash of its set.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.llm.common import cut, dealt_out, gathered, gram_hashes, lower_ascii, mix, once_per_worker, parts, slices, text_bytes, text_size, tidy, word_hashes, word_spans

SKETCH = 1 << 22  # counters of the sketch, whatever the input
CELLS = 1 << 16  # of them in one row
SLOTS = 1 << 24  # bits of the map that picks the documents whose sets are fetched
BLOCK_NODES, BLOCK_SHINGLES = 512, 1 << 20  # of each side of a block of comparisons, about
COLUMNS = 4096  # of a block's matrix that are made at a time


def least_overlap(n, percent: int):
    """ceil(n * percent / 100): what a set of n must share with any partner."""
    return (percent * n + 99) // 100


def document_sets(text: pa.Array, width: int) -> tuple[np.ndarray, np.ndarray]:
    """All documents' distinct shingles, by document and value, and the place where each document's begin (n + 1)."""
    data, offsets = text_bytes(text)
    data = lower_ascii(data)
    start, end = word_spans(data)
    words = word_hashes(data, start, end)
    bounds = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(len(text)), np.diff(bounds))
    grams = gram_hashes(words, width)
    whole = doc[: len(grams)] == doc[len(doc) - len(grams) :]
    token, owner = grams[whole], doc[: len(grams)][whole]
    few = np.flatnonzero((np.diff(bounds) > 0) & (np.diff(bounds) < width)).tolist()
    if few:
        token = np.concatenate((token, *(gram_hashes(words[bounds[i] : bounds[i + 1]], int(bounds[i + 1] - bounds[i])) for i in few)))
        owner = np.concatenate((owner, few))
    order = np.lexsort((token, owner))
    token, owner = token[order], owner[order]
    new = np.ones(len(token), bool)
    new[1:] = (token[1:] != token[:-1]) | (owner[1:] != owner[:-1])
    token, owner = token[new], owner[new]
    return token, np.searchsorted(owner, np.arange(len(text) + 1))


def node_keys(token: np.ndarray, bounds: np.ndarray) -> np.ndarray:
    """A hash of each document's set."""
    total = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(token ^ np.uint64(0x5851F42D4C957F2D)))))
    return mix(total[bounds[1:]] - total[bounds[:-1]] + np.diff(bounds).astype(np.uint64)).view(np.int64)


def frequency_levels(docs: DataFrame, width: int) -> np.ndarray:
    """For each cell of the sketch, twice the binary logarithm of the number of documents' shingles in it beyond the median
    cell's, which is what rare shingles that share a cell add up to: in a large table that is a lot, but all cells have it."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        cells = np.zeros(SKETCH, np.int32)
        for batch in slices(batches, "text"):
            cell, n = np.unique((document_sets(batch.column("text"), width)[0] % np.uint64(SKETCH)).astype(np.int32), return_counts=True)
            cells[cell] += n.astype(np.int32)
        packed = np.minimum(cells, 65535).astype("<u2").reshape(-1, CELLS)
        full = np.flatnonzero(packed.any(1)).tolist()
        yield pa.record_batch([pa.array(full, pa.int32()), pa.array([zlib.compress(packed[i].tobytes(), 1) for i in full], pa.binary())], ["part", "cells"])

    def total(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, x in zip(batch.column("part").to_pylist(), batch.column("cells").to_pylist()):
                held[i] = held.get(i, 0) + np.frombuffer(zlib.decompress(x), "<u2").astype(np.int64)
        for i, x in held.items():
            yield pa.record_batch([pa.array([i], pa.int32()), pa.array([np.floor(2 * np.log2(np.maximum(x - np.median(x), 0) + 1)).astype(np.uint8).tobytes()], pa.binary())], ["part", "cells"])

    dealt = docs.select("text").mapInArrow(count, "part int, cells binary").repartitionById(min(SKETCH // CELLS, parts(docs)), "part")
    out = np.zeros((SKETCH // CELLS, CELLS), np.uint8)
    for r in dealt.mapInArrow(total, "part int, cells binary").collect():
        out[r["part"]] = np.frombuffer(r["cells"], np.uint8)
    return out.ravel()


def nodes_and_prefixes(docs: DataFrame, levels: np.ndarray, width: int, percent: int) -> DataFrame:
    """doc_id, n, c (node; null without words or doc_id), prefix (its first shingles in the common order)."""
    shared = docs.sparkSession.sparkContext.broadcast(levels)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = shared.value
        for batch in slices(batches, "text"):
            token, bounds = document_sets(batch.column("text"), width)
            n, node = np.diff(bounds), node_keys(token, bounds)
            doc = np.repeat(np.arange(len(n)), n)
            ranked = token[np.argsort(doc * 256 + level[(token % np.uint64(SKETCH)).astype(np.int64)], kind="stable")]
            size = np.where(n > 0, n - least_overlap(n, percent) + 1, 0)
            prefix = [ranked[b : b + k].tobytes() for b, k in zip(bounds.tolist(), size.tolist())]
            gone = (n == 0) | np.asarray(batch.column("doc_id").is_null())
            yield pa.record_batch([batch.column("doc_id"), pa.array(n.astype(np.int64)), pa.array(node, mask=gone), pa.array(prefix, pa.binary())], ["doc_id", "n", "c", "prefix"])

    return docs.select("doc_id", "text").mapInArrow(run, "doc_id long, n long, c long, prefix binary")


def shared_prefixes(nodes: DataFrame, levels: np.ndarray, percent: int, deal: int, hot_docs: int) -> DataFrame:
    """t, c, n, leader: the places where nodes of like size share a shingle of their prefixes. leader is the least of
    the nodes that meet there through a chain of like sizes.

    Nodes of a shingle that about hot_docs documents or more have don't meet in one task: they are dealt by shingle and
    node, and their leader is the least node with the shingle, from partial minima; those that no other node has go."""
    met = cut(met_by_shingle(nodes, levels, percent, deal, hot_docs))
    hot = met.where("leader IS NULL").drop("leader")
    shared = hot.groupBy("t").agg(F.min("c").alias("leader"), F.max("c").alias("last")).where("leader < last").drop("last")
    return met.where("leader IS NOT NULL").unionByName(cut(hot.join(shared, "t")))


def met_by_shingle(nodes: DataFrame, levels: np.ndarray, percent: int, deal: int, hot_docs: int) -> DataFrame:
    """The rows of shared_prefixes(), as the tasks give them; of hot shingles without a leader."""
    shared, least = nodes.sparkSession.sparkContext.broadcast(levels), int(2 * np.log2(hot_docs + 1))

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        level = shared.value

        def pieces() -> Iterator[dict[str, np.ndarray]]:
            sent: set[int] = set()  # nodes that this task has dealt, so that a node of many copies is dealt once
            for batch in batches:
                c, first = np.unique(np.asarray(batch.column("c")), return_index=True)
                new = np.array([x not in sent for x in c.tolist()], bool)
                c, first = c[new], first[new]
                if len(sent) > 1_000_000:
                    sent.clear()
                sent.update(c.tolist())
                prefix, n = batch.column("prefix").take(pa.array(first)).to_pylist(), np.asarray(batch.column("n"))[first]
                length = np.array([len(x) // 8 for x in prefix], np.int64)
                token, node = np.frombuffer(b"".join(prefix), np.uint64), np.repeat(c, length)
                # a hot shingle's copies of itself, one for about hot_docs / 2 documents, take a share of the nodes each
                over = level[(token % np.uint64(SKETCH)).astype(np.int64)].astype(np.int64)
                hot = over >= least
                ways = np.where(hot, np.exp2(over / 2) * 2 / hot_docs, 1).astype(np.uint64) + np.uint64(1)
                key = np.where(hot, mix(token + mix(node.view(np.uint64)) % ways), token)
                yield {"t": token, "c": node, "n": np.repeat(n, length).astype("<i8"), "h": hot.astype("i1"), "key": key}

        yield from dealt_out(pieces(), deal)

    def meet(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = gathered(batches, {"t": "<u8", "c": "<i8", "n": "<i8", "h": "i1"})
        order = np.lexsort((x["c"], x["n"], x["t"]))
        t, c, n, h = (x.pop(k)[order] for k in ("t", "c", "n", "h"))
        once = np.ones(len(t), bool)
        once[1:] = (t[1:] != t[:-1]) | (c[1:] != c[:-1])
        t, c, n, h = t[once], c[once], n[once], h[once].astype(bool)
        alike = (t[1:] == t[:-1]) & (100 * n[:-1] >= percent * n[1:])
        chain = np.cumsum(np.concatenate(([True], ~alike))[: len(t)])
        more = h.copy()
        more[1:] |= alike
        more[:-1] |= alike
        t, c, n, h, chain = t[more], c[more], n[more], h[more], chain[more]
        if len(t):
            begin = np.flatnonzero(np.concatenate(([True], chain[1:] != chain[:-1])))
            leader = np.repeat(np.minimum.reduceat(c, begin), np.diff(np.append(begin, len(t))))
            del order, once, alike, chain, more
            tidy()
            for lo in range(0, len(t), 100_000):
                p = slice(lo, lo + 100_000)
                yield pa.record_batch([pa.array(t[p].view(np.int64)), pa.array(c[p]), pa.array(n[p]), pa.array(leader[p], mask=h[p])], ["t", "c", "n", "leader"])

    rows = nodes.where("c is not null").select("c", "n", "prefix").mapInArrow(spread, "p int, t binary, c binary, n binary, h binary")
    return rows.repartitionById(deal, "p").mapInArrow(meet, "t long, c long, n long, leader long")


def slot_map(ids: DataFrame) -> dict[int, bytes]:
    """A bit for each id's hash, in compressed parts; of fixed size."""
    side = 1 << 19

    def local(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        bits = np.zeros(SLOTS, bool)
        for batch in batches:
            bits[slots(np.asarray(batch.column(0)))] = True
        for i in np.flatnonzero(bits.reshape(-1, side).any(1)).tolist():
            yield pa.record_batch([pa.array([i], pa.int32()), pa.array([zlib.compress(np.packbits(bits[i * side : (i + 1) * side]).tobytes(), 1)], pa.binary())], ["part", "bits"])

    def merge(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, np.ndarray] = {}
        for batch in batches:
            for i, x in zip(batch.column("part").to_pylist(), batch.column("bits").to_pylist()):
                held[i] = held.get(i, 0) | np.frombuffer(zlib.decompress(x), np.uint8)
        for i, x in held.items():
            yield pa.record_batch([pa.array([i], pa.int32()), pa.array([zlib.compress(x.tobytes(), 1)], pa.binary())], ["part", "bits"])

    kind = "part int, bits binary"
    return {r["part"]: bytes(r["bits"]) for r in ids.mapInArrow(local, kind).repartitionById(SLOTS // side, "part").mapInArrow(merge, kind).collect()}


def slots(ids: np.ndarray) -> np.ndarray:
    return (mix(ids.astype(np.int64).view(np.uint64)) % np.uint64(SLOTS)).astype(np.int64)


def fetched_sets(docs: DataFrame, wanted: DataFrame, width: int) -> DataFrame:
    """wanted(rep, c, ...) with its nodes' sets, as bytes. The documents are picked on the map side by a map of bits,
    so that only sets that are (nearly all) wanted are shuffled."""
    shared = docs.sparkSession.sparkContext.broadcast(slot_map(wanted.select("rep")))
    tag = ("slots", shared._jbroadcast.id())

    def unpacked() -> np.ndarray:
        out = np.zeros(SLOTS, bool)
        for i, x in shared.value.items():
            out[i << 19 : (i + 1) << 19] = np.unpackbits(np.frombuffer(zlib.decompress(x), np.uint8))
        return out

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        wants = once_per_worker(tag, unpacked)

        def picked() -> Iterator[pa.RecordBatch]:
            for batch in batches:
                yield batch.filter(pa.array(wants[slots(np.asarray(batch.column("doc_id")))]))

        for batch in slices(picked(), "text"):
            token, bounds = document_sets(batch.column("text"), width)
            sets = [token[a:b].tobytes() for a, b in zip(bounds[:-1].tolist(), bounds[1:].tolist())]
            yield pa.record_batch([batch.column("doc_id"), pa.array(node_keys(token, bounds)), pa.array(sets, pa.binary())], ["rep", "c", "tokens"])

    found = docs.where("doc_id is not null").select("doc_id", "text").mapInArrow(run, "rep long, c long, tokens binary")
    return found.dropDuplicates(["rep", "c"]).join(wanted, ["rep", "c"])


def group_hits(queries: DataFrame, deal: int) -> DataFrame:
    """c, g, hits: how many of node c's shingles another member of group g has, from queries(c, g, own, tokens, ways); a
    row with own is a member's row of its own group. A group's shingles go to `ways` partitions at most, so that small
    groups give few counts and large ones aren't matched in one task."""

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
        for batch in slices(batches, "tokens"):
            tokens = batch.column("tokens").to_pylist()
            length = np.array([len(x) // 8 for x in tokens], np.int64)
            cols = {k: np.repeat(np.asarray(batch.column(k).cast(pa.int8()) if k == "own" else batch.column(k)), length) for k in ("c", "g", "own")}
            token, ways = np.frombuffer(b"".join(tokens), np.uint64), np.repeat(np.asarray(batch.column("ways")), length).astype(np.uint64)
            yield {"t": token} | cols | {"key": mix(mix(cols["g"].view(np.uint64)) + (token >> np.uint64(8)) % ways)}

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return dealt_out(pieces(batches), deal)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = gathered(batches, {"t": "<u8", "c": "<i8", "g": "<i8", "own": "i1"})
        order = np.lexsort((x["t"], x["g"]))
        t, c, g, own = (x[k][order] for k in ("t", "c", "g", "own"))
        if not len(t):
            return
        begin = np.flatnonzero(np.concatenate(([True], (t[1:] != t[:-1]) | (g[1:] != g[:-1]))))
        members = np.repeat(np.add.reduceat(own.astype(np.int64), begin), np.diff(np.append(begin, len(t))))
        hit = members - own >= 1
        order = np.lexsort((g[hit], c[hit]))
        c, g = c[hit][order], g[hit][order]
        if len(c):
            begin = np.flatnonzero(np.concatenate(([True], (c[1:] != c[:-1]) | (g[1:] != g[:-1]))))
            yield pa.record_batch([pa.array(c[begin]), pa.array(g[begin]), pa.array(np.diff(np.append(begin, len(c))))], ["c", "g", "hits"])

    rows = queries.mapInArrow(spread, "p int, t binary, c binary, g binary, own binary").repartitionById(deal, "p")
    return rows.mapInArrow(match, "c long, g long, hits long").groupBy("c", "g").agg(F.sum("hits").alias("hits"))


def linked(sets: list[bytes], n: np.ndarray, weight: np.ndarray, left: np.ndarray, right: np.ndarray, percent: int) -> tuple[np.ndarray, np.ndarray]:
    """Of a block's sets: how many documents link to each one, by the partners' weights, and the first of the block that
    links reach from it. Those of `left` are compared with those of `right` (places in the block, in order)."""
    token, owner = np.frombuffer(b"".join(sets), np.uint64), np.repeat(np.arange(len(n), dtype=np.int32), n)
    order = np.argsort(token, kind="stable")
    token, owner = token[order], owner[order]
    begin = np.flatnonzero(np.concatenate((np.ones(min(len(token), 1), bool), token[1:] != token[:-1])))
    count = np.diff(np.append(begin, len(token)))
    shared = np.repeat(count > 1, count)
    owner, column = owner[shared], np.repeat(np.arange((count > 1).sum()), count[count > 1])
    both = np.zeros((len(left), len(right)), np.float64)
    for lo in range(0, int(column[-1]) + 1 if len(column) else 0, COLUMNS):
        a, b = np.searchsorted(column, [lo, lo + COLUMNS])
        part = np.zeros((len(n), min(COLUMNS, int(column[-1]) + 1 - lo)), np.float32)
        part[owner[a:b], column[a:b] - lo] = 1
        both += part[left] @ part[right].T
    link = 100 * both >= percent * (n[left][:, None] + n[right][None, :] - both)
    same = left[:, None] == right[None, :]
    link &= ~same
    degree, first = np.zeros(len(n), np.int64), np.arange(len(n))
    np.add.at(degree, left, link @ weight[right])
    if not same.any():
        np.add.at(degree, right, link.T @ weight[left])
    while link.any():
        before = first.copy()
        first[left] = np.minimum(first[left], np.where(link, first[right][None, :], len(n)).min(1))
        first[right] = np.minimum(first[right], np.where(link, first[left][:, None], len(n)).min(0))
        if (first == before).all():
            break
    return degree, first


def compared(opened: DataFrame, sets: DataFrame, percent: int, deal: int, most_nodes: int, most_shingles: int) -> DataFrame:
    """c, links, other: for each node and block in which it has links, how many documents they lead to, and the block's
    first node that they reach. A link between two groups is counted once, in the pair of groups, where both nodes have
    opened the other's group; nodes of a group are compared in the group's pair with itself."""
    pair = opened.select("c", "n", F.least("own", "g").alias("lo"), F.greatest("own", "g").alias("hi"), (F.col("own") == F.greatest("own", "g")).alias("high"))
    of = lambda side, x: F.sum(F.when(F.col("high") == side, x).otherwise(0))
    ways = lambda side: F.ceil(F.greatest(of(side, F.lit(1)) / most_nodes, of(side, F.col("n")) / most_shingles)).cast("int")
    blocks = pair.groupBy("lo", "hi").agg(ways(False).alias("lows"), ways(True).alias("highs"))
    blocks = blocks.where("lo = hi or lows > 0")  # a group's own pair has one side, the high one
    rows = pair.join(blocks.where("highs > 0"), ["lo", "hi"])
    block = F.pmod(F.xxhash64("c"), F.when(F.col("high"), F.col("highs")).otherwise(F.col("lows"))).cast("int")
    others = F.sequence(F.lit(0), F.when((F.col("lo") == F.col("hi")) | ~F.col("high"), F.col("highs")).otherwise(F.col("lows")) - 1)
    rows = rows.withColumn("x", block).withColumn("y", F.explode(others))
    one, two = F.when(F.col("lo") == F.col("hi"), F.least("x", "y")).when(F.col("high"), F.col("y")).otherwise(F.col("x")), F.when(F.col("lo") == F.col("hi"), F.greatest("x", "y")).when(F.col("high"), F.col("x")).otherwise(F.col("y"))
    # side: 0 and 1 are compared with each other, 2 among themselves
    side = F.when((F.col("lo") == F.col("hi")) & (F.col("x") == F.col("y")), 2).when(F.when(F.col("lo") == F.col("hi"), F.col("x") > F.col("y")).otherwise(F.col("high")), 1).otherwise(0)
    rows = rows.select("c", F.xxhash64("lo", "hi").alias("pair"), one.alias("i"), two.alias("j"), side.alias("side")).join(sets.select("c", "n", "weight", "tokens"), "c")
    key = ["pair", "i", "j"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: list[dict] = []

        def done() -> Iterator[pa.RecordBatch]:
            rows = sorted(held, key=lambda r: r["c"])
            held.clear()
            n, weight, side = (np.array([r[k] for r in rows], np.int64) for k in ("n", "weight", "side"))
            degree, first = linked([r["tokens"] for r in rows], n, weight, np.flatnonzero(side != 1), np.flatnonzero(side > 0), percent)
            c, some = np.array([r["c"] for r in rows], np.int64), degree > 0
            if some.any():
                yield pa.record_batch([pa.array(c[some]), pa.array(degree[some]), pa.array(c[first[some]])], ["c", "links", "other"])

        at = None
        for batch in slices(batches, "tokens"):
            for r in batch.to_pylist():
                if at != (at := (r["pair"], r["i"], r["j"])) and held:
                    yield from done()
                held.append(r)
        if held:
            yield from done()

    sorted_rows = rows.repartition(deal, *key).sortWithinPartitions(*key)
    return sorted_rows.mapInArrow(run, "c long, links long, other long")


def components(links: DataFrame) -> DataFrame:
    """c, root for every node of links(a, b): the least node it reaches. Labels go along links and then jump to their
    label's label, so a component takes about as many rounds as the logarithm of its diameter. Minima are taken in parts
    first; the joins are by hub and by label, whose many rows are on one side only, where Spark splits skewed
    partitions."""
    edges = cut(links.select("a", "b").union(links.select("b", "a")).distinct().toDF("a", "b"))
    labels = cut(edges.groupBy(F.col("a").alias("c")).agg(F.least(F.col("a"), F.min("b")).alias("root")))
    while True:
        near = edges.join(labels.select(F.col("c").alias("b"), "root"), "b").groupBy(F.col("a").alias("c")).agg(F.min("root").alias("near"))
        moved = labels.join(near, "c").select("c", "root", F.least("root", "near").alias("new"))
        jump = labels.select(F.col("c").alias("new"), F.col("root").alias("far"))
        after = cut(moved.join(jump, "new", "left").select("c", "root", F.least("new", "far").alias("new")))
        labels = after.select("c", F.col("new").alias("root"))
        if after.where("root <> new").isEmpty():
            return labels


def labelled(nodes: DataFrame, label: DataFrame, *, hot_rows: int = 100_000, most_hot: int = 10_000) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links from label(c, component_id, n_links). Nodes with over hot_rows copies are
    dealt to several partitions; at most most_hot nodes are taken as such, so that their list can be broadcast. Rows
    without a node aren't dealt at all."""
    rows = nodes.select("doc_id", F.col("n").alias("n_shingles"), "c")
    sizes = rows.where("c IS NOT NULL").groupBy("c").count()
    least = max(hot_rows, nodes.count() // most_hot)
    hot = F.broadcast(cut(sizes.where(F.col("count") > least).select("c", F.ceil(F.col("count") / least).alias("ways"))))
    ways = F.coalesce("ways", F.lit(1).cast("long"))
    dealt_rows = rows.where("c IS NOT NULL").join(hot, "c", "left").withColumn("way", F.pmod(F.xxhash64("doc_id"), ways)).drop("ways")
    copies = label.join(hot, "c", "left").select("c", "component_id", "n_links", F.explode(F.sequence(F.lit(0).cast("long"), ways - 1)).alias("way"))
    found = dealt_rows.join(copies, ["c", "way"]).select("doc_id", "n_shingles", "component_id", "n_links")
    return found.unionByName(rows.where("c IS NULL").select("doc_id", "n_shingles", F.col("doc_id").alias("component_id"), F.lit(0).cast("long").alias("n_links")))


def jaccard_components(docs: DataFrame, *, width: int = 5, percent: int = 80, hot_docs: int = 256, block_nodes: int = BLOCK_NODES, block_shingles: int = BLOCK_SHINGLES) -> DataFrame:
    """doc_id, n_shingles, component_id, n_links for every row of docs(doc_id, text, ...).

    A-Z are lower-cased, words are runs without white space; a set holds the distinct shingles of `width` words, or
    the whole sequence where there are fewer words. Documents link whose sets have a Jaccard similarity of percent/100
    or more; component_id is the smallest doc_id that links reach, n_links the number of other rows that a row links
    with, copies included. A text that is null or has no words has an empty set, its own doc_id and no links. A row
    with a null doc_id links with nothing and has a null component; rows that repeat link with each other and are each
    returned, in one component; other columns are ignored; an empty table gives no rows. Texts are read whole.

    Ties: of shingles of one frequency level, those with smaller hashes come first; of leaders that a node meets as
    often, the larger one counts. They decide what is compared where, not the result. All nodes of an opened pair of
    groups are compared, in blocks of about block_nodes nodes and block_shingles shingles: a group of m nodes of
    different texts takes (m / block_nodes)^2 / 2 blocks, as each of its links is counted; copies are one node.
    """
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    deal = parts(docs, text_size(docs)[1])
    levels = frequency_levels(docs, width)
    nodes = cut(nodes_and_prefixes(docs, levels, width, percent))
    meetings = shared_prefixes(nodes, levels, percent, deal, hot_docs)

    # groups: by the leader that a node meets most often, and by size to a tenth
    best = meetings.groupBy("c", "n", "leader").count().groupBy("c", "n").agg(F.max_by("leader", F.struct("count", "leader")).alias("leader"))
    grouped = best.select("c", F.xxhash64("leader", F.floor(F.log("n") / F.log(F.lit(1.1)))).alias("own"))

    # candidate groups: of the set whose prefix ends first, what it has there and the other one lacks is bounded, so
    # two sets meet at least overlap - least_overlap(larger) + 1 times; one less allows for rounding between sizes
    here = meetings.join(grouped, "c")
    there = here.groupBy("t", "leader", F.col("own").alias("g")).agg(F.min("n").alias("low"), F.max("n").alias("high"), F.count("*").alias("others"))
    fitting = (F.col("high") * 100 >= F.col("n") * percent) & (F.col("low") * percent <= F.col("n") * 100)
    met = here.join(there, ["t", "leader"]).where(fitting & ((F.col("g") != F.col("own")) | (F.col("others") > 1)))
    met = met.groupBy("c", "n", "own", "g").agg(F.count("*").alias("times"), F.greatest(F.min("low"), F.ceil(F.col("n") * percent / 100)).alias("low"), F.least(F.max("high"), F.floor(F.col("n") * 100 / percent)).alias("high"))
    times = lambda m: F.ceil((F.col("n") + m) * percent / (100 + percent) - 1e-6) - F.ceil(F.greatest("n", m) * percent / 100 - 1e-6)
    met = cut(met.where(F.col("times") >= F.least(times(F.col("low")), times(F.col("high")))).select("c", "n", "own", "g"))
    reps = nodes.where("c is not null").groupBy("c").agg(F.min("doc_id").alias("rep"), F.count("*").alias("weight"))
    sets = cut(fetched_sets(docs, met.select("c", "n", "own").distinct().join(reps, "c"), width))  # rep, c, tokens, n, own, weight
    members = sets.select("c", "n", "own")
    asked = met.where("g <> own").select("c", "g", F.lit(False).alias("own")).union(members.select("c", "own", F.lit(True)))
    ways = asked.groupBy("g").agg(F.ceil(F.count("*") / 32).alias("ways"))
    queries = asked.join(ways, "g").join(sets.select("c", "tokens"), "c")

    # the bound: what c shares with the union of g, against what it must share with g's smallest fitting member
    sizes = members.groupBy(F.col("own").alias("g")).agg(F.min("n").alias("low"))
    smallest = F.greatest(F.col("low"), F.ceil(F.col("n") * percent / 100))
    needed = F.ceil((F.col("n") + smallest) * F.lit(percent) / F.lit(100 + percent) - F.lit(1e-6))
    opened = cut(group_hits(queries, deal).join(members, "c").join(sizes, "g").where(F.col("hits") >= needed).select("c", "g", "n", "own"))

    found = cut(compared(opened, sets, percent, deal, block_nodes, block_shingles))
    roots = components(found.where("c <> other").select(F.col("c").alias("a"), F.col("other").alias("b")))
    known = cut(reps.join(roots, "c").select("c", "rep", "root"))
    least = known.groupBy("root").agg(F.min("rep").alias("least"))
    reached = known.join(least, "root").select("c", "least").join(found.groupBy("c").agg(F.sum("links").alias("links")), "c", "left")
    label = reps.join(reached, "c", "left").select("c", F.coalesce("least", "rep").alias("component_id"), (F.coalesce("links", F.lit(0)) + F.col("weight") - 1).alias("n_links"))
    return labelled(nodes, cut(label))
