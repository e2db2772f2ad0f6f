"""Prefix trie of conversations, built from partial tries.

Each task makes a trie of its own range of conversations: a node is known by a hash of its path, has the hashes of its
ancestors 1, 2, 4, ... turns up, its number of members and the least of them, and lists of members that end there. The
tries' tables are merged by hash, several tasks' at a time, until one is left. Sums over subtrees then come from below: in
round k each node hands what it holds to its ancestor 2^k turns up, so that a trie of depth d takes log2(d) rounds.
"""
from __future__ import annotations

import hashlib
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from lakeforge.llm.common import cut, parts

FAN = 64  # tries merged at a time
NODES = 1 << 15  # of a task's trie, before it is passed on
ENDS_BYTES = 1 << 16  # of a list of members, likewise
ROOT = bytes(16)


def turns(conversations: DataFrame) -> DataFrame:
    """A row for each turn: its conversation, place and, in place of its text, a hash and the number of code points."""
    role, text = F.coalesce(F.col("role").cast("string"), F.lit("")), F.coalesce(F.col("text").cast("string"), F.lit(""))
    what = F.unhex(F.md5(F.concat(F.octet_length(role).cast("string"), F.lit(":"), role, text)))
    return conversations.where("conv_id IS NOT NULL").select(F.col("conv_id").cast("long").alias("conv_id"), F.col("turn").cast("long").alias("turn"), what.alias("what"), F.length(text).cast("long").alias("size"))


def base_of(conv_id: Column, group: int) -> Column:
    return conv_id - F.pmod(conv_id, F.lit(group))


class PartialTrie:
    """A task's nodes until they are passed on. path holds the hashes of the conversation that is being added."""

    def __init__(self, part: int):
        self.part = part
        self.nodes: dict[bytes, list] = {}
        self.ends: dict[bytes, list[int]] = {}
        self.listed = 0
        self.path = [ROOT]

    def visit(self, size: int, conv_id: int) -> None:
        """The conversation is a member of the path's last node."""
        node = self.nodes.get(self.path[-1])
        if node is None:
            depth = len(self.path) - 1
            up = [self.path[depth - (1 << k)] for k in range(depth.bit_length())]
            node = self.nodes[self.path[-1]] = [depth, size, up, 0, conv_id]
        node[3] += 1
        node[4] = min(node[4], conv_id)

    def begin(self, conv_id: int) -> None:
        del self.path[1:]
        self.visit(0, conv_id)

    def add(self, what: bytes, size: int, conv_id: int) -> None:
        self.path.append(hashlib.blake2b(self.path[-1] + what, digest_size=16).digest())
        self.visit(size, conv_id)

    def end(self, conv_id: int) -> None:
        self.ends.setdefault(self.path[-1], []).append(conv_id)
        self.listed += len(str(conv_id)) + 1

    def full(self) -> bool:
        return len(self.nodes) >= NODES or self.listed >= ENDS_BYTES

    def passed_on(self) -> pa.RecordBatch:
        """Nodes and lists of ends; a list starts with its least member, by which lists are put in order."""
        n, e = self.nodes, self.ends
        blank = [None] * len(e)
        cells = [[*n, *e], *([*(v[i] for v in n.values()), *blank] for i in range(5)), [*[None] * len(n), *(v[0] for v in e.values())], [*[None] * len(n), *(",".join(map(str, v)) for v in e.values())], [self.part] * (len(n) + len(e))]
        self.nodes, self.ends, self.listed = {}, {}, 0
        return pa.record_batch([pa.array(c, k) for c, k in zip(cells, ARROW)], NAMES)


NAMES = ["node", "depth", "size", "up", "n_convs", "conv_id", "first", "ends", "part"]
ARROW = (pa.binary(), pa.int64(), pa.int64(), pa.list_(pa.binary()), pa.int64(), pa.int64(), pa.int64(), pa.string(), pa.int64())
SCHEMA = "node binary, depth long, size long, up array<binary>, n_convs long, conv_id long, first long, ends string, part long"


def partial_tries(conversations: DataFrame, group: int, spread: int, tries: int) -> DataFrame:
    """Tables of the tasks' tries, over ranges of conversations; a group of conversations that share a base is in one
    range. Turns are streamed in order, none but the base's first ones are kept."""
    rows = turns(conversations).withColumn("base", base_of(F.col("conv_id"), group))
    shared = F.crc32(F.col("conv_id").cast("string")) % spread
    ranges = rows.repartitionByRange(tries, "base").sortWithinPartitions("base", "conv_id", F.col("turn").asc_nulls_first(), "what")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trie, base, conv_id, kept, seen, left = None, None, None, [], 0, 0
        for batch in batches:
            for own, b, what, size, h, part in zip(*(batch.column(c).to_pylist() for c in ("conv_id", "base", "what", "size", "shared", "part"))):
                trie = trie or PartialTrie(part)
                if own != conv_id:
                    if conv_id is not None:
                        trie.end(conv_id)
                        if trie.full():
                            yield trie.passed_on()
                    if b != base:
                        base, kept = b, []
                    conv_id, seen, left = own, 0, h
                    trie.begin(own)
                    if own != base:
                        for w, s in kept[:left]:
                            trie.add(w, s, own)
                if own == base and len(kept) < spread:
                    kept.append((what, size))
                if own == base or seen >= left:
                    trie.add(what, size, own)
                    if len(trie.nodes) >= 2 * NODES:  # one very long conversation
                        yield trie.passed_on()
                seen += 1
        if trie:
            trie.end(conv_id)
            yield trie.passed_on()

    return ranges.select("conv_id", "base", "what", "size", shared.alias("shared"), F.spark_partition_id().cast("long").alias("part")).mapInArrow(run, SCHEMA)


def merged(nodes: DataFrame, fan: int, tries: int) -> DataFrame:
    """One table of the tries' tables: each round sums those of `fan` tries by node."""
    while True:
        tries = -(-tries // fan)
        nodes = nodes.withColumn("part", (F.col("part") / fan).cast("long")).groupBy("node", "part", "depth", "size", "up").agg(F.sum("n_convs").alias("n_convs"), F.min("conv_id").alias("conv_id"))
        if tries <= 1:
            return nodes.drop("part")


def digests(ends: DataFrame) -> DataFrame:
    """node, ends_sha256 from lists of ends: the lists of a node come in order and are read one after another."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        node, told = None, None
        for batch in batches:
            out = []
            for key, ids in zip(batch.column("node").to_pylist(), batch.column("ends").to_pylist()):
                if key != node:
                    if node is not None:
                        out.append((node, told.hexdigest()))
                    node, told = key, hashlib.sha256(ids.encode())
                else:
                    told.update(b"," + ids.encode())
            yield pa.record_batch([pa.array([x[i] for x in out], k) for i, k in enumerate((pa.binary(), pa.string()))], ["node", "ends_sha256"])
        if node is not None:
            yield pa.record_batch([pa.array([node], pa.binary()), pa.array([told.hexdigest()])], ["node", "ends_sha256"])

    lists = ends.repartition(parts(ends), "node").sortWithinPartitions("node", "first")
    return lists.select("node", "ends").mapInArrow(run, "node binary, ends_sha256 string")


def rolled_up(nodes: DataFrame) -> DataFrame:
    """nodes with n_children and, over their subtrees, n_leaves and saved. Between rounds only the sums and the ancestors that
    are still to be asked are kept."""
    deepest = nodes.agg(F.max("depth")).first()[0] or 0
    children = nodes.where("depth > 0").groupBy(F.element_at("up", 1).alias("node")).agg(F.count("*").alias("n_children"))
    nodes = nodes.join(children, "node", "left").withColumn("n_children", F.coalesce("n_children", F.lit(0)))
    at = nodes.select("node", "up", (F.col("n_children") == 0).cast("long").alias("n_leaves"), ((F.col("n_convs") - 1) * F.col("size")).alias("saved"))
    for _ in range(int(deepest).bit_length()):
        below = at.where(F.size("up") > 0).groupBy(F.element_at("up", 1).alias("node")).agg(F.sum("n_leaves").alias("l"), F.sum("saved").alias("s"))
        with_below = {"n_leaves": F.col("n_leaves") + F.coalesce("l", F.lit(0)), "saved": F.col("saved") + F.coalesce("s", F.lit(0)), "up": F.slice("up", F.lit(2), F.size("up"))}
        at = cut(at.join(below, "node", "left").withColumns(with_below).drop("l", "s"))
    return nodes.join(at.drop("up"), "node")


def prefix_trie(conversations: DataFrame, *, group: int = 100, spread: int = 6, fan: int = FAN) -> DataFrame:
    """A row for each distinct sequence of first turns (role, text) of the rebuilt conversations(conv_id, turn, role, text, ...).

    Conversation c is rebuilt: of conversation c - c % group the first h = crc32(c) % spread turns, then c's own after its
    first h. node (a hash of the path), conv_id (the least member), depth, parent_conv_id (the least member of the parent;
    the root has none), n_convs, n_children, n_leaves, saved_tokens, ends_sha256 as the query's contract has them.

    A null role or text is empty; a null turn comes first; rows of one turn come in order of a hash of role and text, and
    rows that repeat are turns each; rows without conv_id belong to no conversation; other columns are ignored; an empty
    table gives no rows, not even a root. Of negative ids the base is the next multiple of group below. Texts of any length
    are shuffled as 16 bytes each. A conversation is streamed through one task, however long; a node's members are
    listed in pieces and only their digest is made in one task, which reads them one after another.
    """
    tries = parts(conversations)
    tables = cut(partial_tries(conversations, group, spread, tries))
    nodes = cut(merged(tables.where("depth IS NOT NULL").drop("first", "ends"), fan, tries))
    at = rolled_up(nodes)
    at = at.join(digests(tables.where("ends IS NOT NULL")), "node", "left")
    above = nodes.select(F.col("node").alias("parent"), F.col("conv_id").alias("parent_conv_id"))
    at = at.withColumn("parent", F.when(F.col("depth") > 0, F.element_at("up", 1))).join(above, "parent", "left")
    return at.select("node", "conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", F.col("saved").alias("saved_tokens"), F.coalesce("ends_sha256", F.sha2(F.lit("").cast("binary"), 256)).alias("ends_sha256"))
