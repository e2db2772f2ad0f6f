"""Substring dedup by suffix automata: words covered by windows that also start in a document with a smaller doc_id.

Every window of 13 words has an anchor, the least hash of its 7-word grams, so equal windows have equal anchors. About
a quarter of the places are anchors. Those are dealt to partitions by hash, which tells the anchors that two documents
have (a map of bits, broadcast) and the most frequent ones.

What can't repeat is let go at once; the rest is streamed through suffix automata of reference shards, in two tiers:

* Broadcast: the passages around the most frequent anchors, in the first document that has each, up to a bounded number
  of words. Each worker builds their automata and streams the documents' passages with such anchors through them; what
  matches goes. These would be hot keys; they are never shuffled.
* Dealt: automata of everything else that repeats would grow with the input, and every document would have to be
  streamed through every shard. So each passage (the words of consecutive windows with one anchor) goes to the one shard
  of its anchor. A shard streams its passages in order of doc_id through an automaton of what smaller documents have
  there: matching statistics of 13 words or more give the maximal spans to remove, and the words of windows that are new
  are added. Passages of an anchor that is frequent, but not in the reference, are dealt by longer grams.

Dealt passages are spelt in 7-word grams, 40 bits of hash each, so that a window of 13 words is 7 letters in a row, one
of them its anchor; they are shorter than words that way. Of passages that are the same throughout one is streamed, in a
slice of documents and in a shard: once before its document's words are added, which answers for that document, and, where
larger documents have it, once after, which answers for all of those. So that they are equal saves work; what goes is what
an automaton matched. Spans go back to their documents. Beyond the map's size more passages are dealt, results stay the same.
"""
from __future__ import annotations

import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.llm.common import cut, dealt_out, gathered, gram_hashes, mix, once_per_worker, parts, slices, text_bytes, text_size, word_hashes, word_spans

SHARD_WORDS = 1 << 14  # words of passages that one automaton is made for, about
PASSAGE = {"t": "<u8", "d": "<i8", "r": "<i8", "s": "<u4", "n": "<i4"}


class Automaton:
    """Suffix automaton of sequences of words, each of a document: for every window of `width` words of a text, the
    least document that has it."""

    NONE = np.iinfo(np.int64).max

    def __init__(self, segments: list[tuple[int, list[int]]], width: int):
        self.next, self.link, self.size, self.first = [{}], [-1], [0], [self.NONE]
        for doc, words in segments:
            last = 0
            for w in words:
                last = self.added(last, w)
                self.first[last] = min(self.first[last], doc)
        order = sorted(range(1, len(self.size)), key=self.size.__getitem__)
        for v in reversed(order):
            self.first[self.link[v]] = min(self.first[self.link[v]], self.first[v])
        # of each state, the first document with its suffix of `width` words
        self.width, self.held, top = width, [self.NONE] * len(self.size), list(range(len(self.size)))
        for v in order:
            if self.size[self.link[v]] >= width:
                top[v] = top[self.link[v]]
            self.held[v] = self.first[top[v]]

    def state(self, size: int, link: int, following: dict) -> int:
        self.next.append(following)
        self.link.append(link)
        self.size.append(size)
        self.first.append(self.NONE)
        return len(self.size) - 1

    def split(self, p: int, w: int) -> int:
        """The state that follows p by w, cut so that its longest sequence is p's with w."""
        q = self.next[p][w]
        if self.size[q] == self.size[p] + 1:
            return q
        copy = self.state(self.size[p] + 1, self.link[q], dict(self.next[q]))
        self.link[q] = copy
        while p >= 0 and self.next[p].get(w) == q:
            self.next[p][w] = copy
            p = self.link[p]
        return copy

    def added(self, last: int, w: int) -> int:
        if w in self.next[last]:
            return self.split(last, w)
        new, p = self.state(self.size[last] + 1, 0, {}), last
        while p >= 0 and w not in self.next[p]:
            self.next[p][w] = new
            p = self.link[p]
        if p >= 0:
            self.link[new] = self.split(p, w)
        return new

    def add(self, words: list[int]) -> None:
        """One more sequence, of no document; least() isn't for such automata."""
        last = 0
        for w in words:
            last = self.added(last, w)

    def matched(self, words: list[int]) -> list[int]:
        """Matching statistics: for each place, how many words that end there the automaton has in a row, at most."""
        following, link, size = self.next, self.link, self.size
        v = length = 0
        out = []
        for w in words:
            while w not in following[v] and v:
                v = link[v]
                length = size[v]
            to = following[v].get(w)
            v, length = (0, 0) if to is None else (to, length + 1)
            out.append(length)
        return out

    def least(self, words: list[int]) -> list[int]:
        """By window: the least document that has it, or NONE."""
        following, link, size, held, width = self.next, self.link, self.size, self.held, self.width
        v = length = 0
        out = []
        for w in words:
            while w not in following[v] and v:
                v = link[v]
                length = size[v]
            to = following[v].get(w)
            v, length = (0, 0) if to is None else (to, length + 1)
            out.append(held[v] if length >= width else self.NONE)
        return out[width - 1 :]


class Reference:
    """Automata of the broadcast shards, and the frequent anchors."""

    def __init__(self, anchors: np.ndarray, segments: list[tuple[int, list[bytes]]], width: int, automaton: type[Automaton], shard: int = 1 << 14):
        self.anchors, self.width, self.automata = np.sort(anchors), width, []
        held: list[tuple[int, list[int]]] = []
        size = 0
        for doc, runs in segments:
            for words in runs:
                held.append((doc, np.frombuffer(words, np.uint64).tolist()))
                size += len(held[-1][1])
            if size >= shard:
                self.automata.append(automaton(held, width))
                held, size = [], 0
        if held:
            self.automata.append(automaton(held, width))

    def frequent(self, least: np.ndarray) -> np.ndarray:
        """Whether each window's anchor is among the frequent ones."""
        if not len(self.anchors):
            return np.zeros(len(least), bool)
        return self.anchors[np.minimum(np.searchsorted(self.anchors, least), len(self.anchors) - 1)] == least

    def known(self, words: np.ndarray, at: np.ndarray, hot: np.ndarray) -> np.ndarray:
        """By window: the least document of the reference that has it, or NONE; for the windows that are hot."""
        out = np.full(len(at), Automaton.NONE, np.int64)
        hot = np.flatnonzero(hot)
        for run in np.split(hot, np.flatnonzero(np.diff(at[hot]) != 1) + 1) if len(hot) and self.automata else ():
            part = words[at[run[0]] : at[run[-1]] + self.width].tolist()
            out[run] = np.minimum.reduce([x.least(part) for x in self.automata])
        return out


def windows(text: pa.Array, width: int, anchor: int) -> tuple[np.ndarray, ...]:
    """Hash, anchor, row and first word's place of every window of `width` words of one text, in order; all words; the
    place of each row's first word; the hash of the `anchor` words from each place on."""
    data, offsets = text_bytes(text)
    start, end = word_spans(data)
    words = word_hashes(data, start, end)
    bounds = np.searchsorted(start, offsets)
    doc = np.repeat(np.arange(len(text)), np.diff(bounds))
    if len(words) < width:
        return np.zeros(0, np.uint64), np.zeros(0, np.uint64), np.zeros(0, np.int64), np.zeros(0, np.int64), words, bounds, words[:0]
    whole = doc[: len(doc) - width + 1] == doc[width - 1 :]
    grams = gram_hashes(words, anchor)
    return gram_hashes(words, width)[whole], least_grams(grams, len(words), width, anchor)[whole], doc[: len(doc) - width + 1][whole], np.flatnonzero(whole), words, bounds, grams


def least_grams(grams: np.ndarray, words: int, width: int, n: int) -> np.ndarray:
    """The least hash of n words in a row, in each window of `width` of so many words."""
    least = grams[: words - width + 1].copy()
    for k in range(1, width - n + 1):
        np.minimum(least, grams[k : k + len(least)], out=least)
    return least


def repeated_anchors(docs: DataFrame, deal: int, width: int, anchor: int, bits: int, frequent: int, most: int) -> tuple[int, dict[int, bytes], np.ndarray]:
    """Bits for each partition that anchors are dealt to, and by partition those of the anchors that two documents
    have; the anchors that most documents have, `most` of them at most, with the most frequent first."""
    side = max(bits // deal, 64)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
        for batch in slices(batches, "text"):
            _, least, doc, *_ = windows(batch.column("text"), width, anchor)
            ids = np.asarray(batch.column("doc_id"))[doc]
            order = np.lexsort((ids, least))
            least, ids = least[order], ids[order]
            new = np.ones(len(least), bool)
            new[1:] = least[1:] != least[:-1]
            other = new.copy()
            other[1:] |= ids[1:] != ids[:-1]
            begin = np.flatnonzero(new)
            count = np.add.reduceat(other.astype(np.int64), begin) if len(begin) else begin
            # an anchor once for each slice of documents, with the number of documents there
            yield {"t": least[begin], "n": np.minimum(count, 65535).astype("<u2")}

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return dealt_out(pieces(batches), deal)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        part = 0

        def seen() -> Iterator[pa.RecordBatch]:
            nonlocal part
            for batch in batches:
                part = batch.column("p")[0].as_py() if len(batch) else part
                yield batch

        x = gathered(seen(), {"t": "<u8", "n": "<u2"})
        order = np.argsort(x["t"], kind="stable")
        t, n = x["t"][order], x["n"][order].astype(np.int64)
        begin = np.flatnonzero(np.concatenate((np.ones(min(len(t), 1), bool), t[1:] != t[:-1])))
        count = np.add.reduceat(n, begin) if len(begin) else begin
        begin, count = begin[count > 1], count[count > 1]
        held = np.zeros(side, bool)
        held[(mix(t[begin]) % np.uint64(side)).astype(np.int64)] = True
        hot = np.argsort(-count, kind="stable")[: min(-(-most // deal) * 4, int((count >= frequent).sum()))]
        if len(begin):
            cells = zlib.compress(np.packbits(held).tobytes(), 1), t[begin[hot]].tobytes(), count[hot].astype("<i8").tobytes()
            yield pa.record_batch([pa.array([part], pa.int32()), *(pa.array([x], pa.binary()) for x in cells)], ["p", "bits", "anchors", "docs"])

    dealt_rows = docs.mapInArrow(spread, "p int, t binary, n binary").repartitionById(deal, "p")
    found = dealt_rows.mapInArrow(match, "p int, bits binary, anchors binary, docs binary").collect()
    join = lambda name, kind: np.frombuffer(b"".join(bytes(r[name]) for r in found), kind)
    anchors, count = join("anchors", "<u8"), join("docs", "<i8")
    return side, {r["p"]: bytes(r["bits"]) for r in found}, anchors[np.lexsort((anchors, -count))[:most]]


def reference_segments(docs: DataFrame, width: int, anchor: int, anchors: np.ndarray, most_words: int) -> list[tuple[int, list[bytes]]]:
    """(doc_id, runs of words) of the passages around frequent anchors in each anchor's first document; of the most
    frequent ones that have most_words words together, so that what is broadcast is bounded."""
    order = np.argsort(anchors)
    ranked = anchors[order]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        first: dict[int, tuple[int, list[bytes]]] = {}
        for batch in slices(batches, "text"):
            _, least, doc, at, words, *_ = windows(batch.column("text"), width, anchor)
            number = np.minimum(np.searchsorted(ranked, least), len(ranked) - 1)
            keep = np.flatnonzero(ranked[number] == least)
            ids, number = np.asarray(batch.column("doc_id"))[doc[keep]], order[number[keep]]
            edge = np.ones(len(keep), bool)
            edge[1:] = (np.diff(at[keep]) != 1) | (np.diff(number) != 0) | (np.diff(ids) != 0)
            begin = np.flatnonzero(edge)
            for a, b in zip(begin.tolist(), np.append(begin[1:], len(keep)).tolist()):
                k, d = int(number[a]), int(ids[a])
                if k not in first or d < first[k][0]:
                    first[k] = (d, [])
                if d == first[k][0]:
                    first[k][1].append(words[at[keep[a]] : at[keep[b - 1]] + width].tobytes())
        yield pa.record_batch([pa.array(list(first), pa.int64()), pa.array([d for d, _ in first.values()], pa.int64()), pa.array([sorted(set(x)) for _, x in first.values()], pa.list_(pa.binary()))], ["number", "doc_id", "runs"])

    rows = docs.mapInArrow(run, "number long, doc_id long, runs array<binary>")
    found = cut(rows.groupBy("number").agg(F.min("doc_id").alias("doc_id"), F.min_by("runs", "doc_id").alias("runs")))
    size = F.aggregate("runs", F.lit(0).cast("long"), lambda n, x: n + F.octet_length(x))
    sizes = sorted((r["number"], r["size"]) for r in found.select("number", size.alias("size")).collect())
    fitting = [k for (k, _), total in zip(sizes, np.cumsum([n for _, n in sizes]).tolist()) if total <= 8 * most_words]
    return [(r["doc_id"], [bytes(x) for x in r["runs"]]) for r in found.where(F.col("number") <= max(fitting, default=-1)).orderBy("number").collect()]


def edges_of(*columns: np.ndarray) -> np.ndarray:
    """Where a new run begins: at the first of rows whose places (the first column) go on and whose others are equal."""
    edge = np.ones(len(columns[0]), bool)
    edge[1:] = np.diff(columns[0]) != 1
    for x in columns[1:]:
        edge[1:] |= x[1:] != x[:-1]
    return np.flatnonzero(edge)


def passages(docs: DataFrame, deal: int, width: int, anchor: int, side: int, found: dict[int, bytes], reference: tuple, automaton: type[Automaton]) -> DataFrame:
    """Rows of dealt passages: t (what they are dealt by), d (doc_id), r (the row's text), s (first word's place), n (grams),
    lo and hi (the grams). n below 0: -n grams that automata of the reference, or of smaller documents of the same slice, have
    matched; those are dealt by document."""
    shared = docs.sparkSession.sparkContext.broadcast((found, reference))
    tag, longer = ("anchors", shared._jbroadcast.id()), (width + anchor + 1) // 2

    def made() -> tuple[np.ndarray, Reference]:
        held, ref = shared.value
        out = np.zeros((deal, -(-side // 8)), np.uint8)
        for p, x in held.items():
            out[p] = np.frombuffer(zlib.decompress(x), np.uint8)
        return out, Reference(*ref, width, automaton)

    def pieces(batches: Iterator[pa.RecordBatch]) -> Iterator[dict[str, np.ndarray]]:
        held, ref = once_per_worker(tag, made)
        for batch in slices(batches, "text"):
            own, least, doc, at, words, first_word, grams = windows(batch.column("text"), width, anchor)
            if not len(own):
                continue
            ids, rows = np.asarray(batch.column("doc_id")), np.asarray(batch.column("r"))
            slot, part = (mix(least) % np.uint64(side)).astype(np.int64), ((least >> np.uint64(24)) % np.uint64(deal)).astype(np.int64)
            keep = (held[part, slot >> 3] >> (7 - (slot & 7)).astype(np.uint8) & 1).astype(bool)
            hot = ref.frequent(least)
            known = ref.known(words, at, hot)
            row = lambda k: {"d": ids[doc[k]], "r": rows[doc[k]], "s": (at[k] - first_word[doc[k]]).astype("<u4")}
            none = {"lo": np.zeros(0, "<u4"), "hi": np.zeros(0, "u1")}
            gone = np.flatnonzero(known < ids[doc])
            begin = edges_of(at[gone], doc[gone])
            length = np.diff(np.append(begin, len(gone))) + width - anchor
            yield {"t": mix(ids[doc[gone[begin]]].view(np.uint64)), "n": -length.astype("<i4")} | row(gone[begin]) | none

            key = least.copy()
            if hot.any():
                finer = np.zeros(len(words) - width + 1, np.uint64)
                finer[:] = least_grams(gram_hashes(words, longer), len(words), width, longer)
                key[hot] = mix(finer[at[hot]])
            rest = np.flatnonzero(keep & (known > ids[doc]))
            begin = edges_of(at[rest], doc[rest], key[rest])
            if not len(begin):
                continue
            windows_in = np.diff(np.append(begin, len(rest)))
            nth = np.arange(len(rest)) - np.repeat(begin, windows_in)
            same = np.add.reduceat(mix(own[rest] + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)), begin) + windows_in.astype(np.uint64)
            start, length = rest[begin], windows_in + width - anchor
            order = np.lexsort((ids[doc[start]], same))
            lead = np.concatenate(([True], same[order][1:] != same[order][:-1]))
            leader = np.empty(len(start), np.int64)
            leader[order] = order[lead][np.cumsum(lead) - 1]
            later = ids[doc[start]] > ids[doc[start[leader]]]

            def codes_of(which: np.ndarray) -> np.ndarray:
                taken = length[which]
                ends = np.cumsum(taken)
                return grams[np.arange(ends[-1] if len(ends) else 0) + np.repeat(at[start[which]] - (ends - taken), taken)] >> np.uint64(24)

            again = np.unique(leader[later])
            again = again[np.argsort(ids[doc[start[again]]], kind="stable")]
            told: dict[int, list[tuple[int, int]]] = {}
            for k, a, b, after in streamed(ids[doc[start[again]]], length[again], codes_of(again), width - anchor + 1, np.ones(len(again), bool), automaton):
                if after:
                    told.setdefault(int(again[k]), []).append((a, b))
            which = np.flatnonzero(later)
            matched = np.array([(k, a, b) for k, of in zip(which.tolist(), leader[which].tolist()) for a, b in told.get(of, ())], np.int64).reshape(-1, 3).T
            holder = row(start[matched[0]])
            yield {"t": mix(holder["d"].view(np.uint64)), "n": (matched[1] - matched[2]).astype("<i4")} | holder | {"s": (holder["s"] + matched[1]).astype("<u4")} | none
            asked = np.flatnonzero(~later)
            codes = codes_of(asked)
            yield {"t": key[start[asked]], "n": length[asked].astype("<i4"), "lo": codes.astype("<u4"), "hi": (codes >> np.uint64(32)).astype("u1")} | row(start[asked])

    def spread(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return dealt_out(pieces(batches), deal, ("lo", "hi"))

    return docs.mapInArrow(spread, "p int, t binary, n binary, d binary, r binary, s binary, lo binary, hi binary")


def maximal(matched: list[int], width: int) -> list[tuple[int, int]]:
    """The maximal spans that windows of `width` letters cover, of matching statistics."""
    out: list[tuple[int, int]] = []
    for place, length in enumerate(matched):
        if length >= width:
            first = place - width + 1
            if out and first <= out[-1][1]:
                out[-1] = (out[-1][0], place + 1)
            else:
                out.append((first, place + 1))
    return out


def streamed(docs: np.ndarray, size: np.ndarray, codes: np.ndarray, width: int, again: np.ndarray, make: type[Automaton]) -> list[tuple[int, int, int, bool]]:
    """(passage, start in it, end, after) of the maximal spans whose windows of `width` letters smaller documents have, of
    passages in order of their documents; size: letters of each, which lie one after another in codes. after: those that
    documents up to its own have, for passages that are asked for `again`, on behalf of larger documents with the same."""
    automaton, out, new, waiting = make([], width), [], [], []
    ends, before = np.cumsum(size).tolist(), None

    def added() -> None:
        """What a document adds counts for larger ones."""
        for x in new:
            automaton.add(x)
        for k, words in waiting:
            out.extend((k, a, b, True) for a, b in maximal(automaton.matched(words), width))

    for k, (doc, n, end, more) in enumerate(zip(docs.tolist(), size.tolist(), ends, again.tolist())):
        if doc != before:
            added()
            new, waiting, before = [], [], doc
        words = codes[end - n : end].tolist()
        lengths = automaton.matched(words)
        out.extend((k, a, b, False) for a, b in maximal(lengths, width))
        fresh = None  # where a run of new windows began
        for place in range(width - 1, n):
            if lengths[place] >= width:
                if fresh is not None:
                    new.append(words[fresh:place])
                    fresh = None
            elif fresh is None:
                fresh = place - width + 1
        if fresh is not None:
            new.append(words[fresh:])
        if more:
            waiting.append((k, words))
    added()
    return out


def spans(dealt_rows: DataFrame, deal: int, width: int, anchor: int, shard_words: int, automaton: type[Automaton]) -> DataFrame:
    """doc_id, r, spans (bytes: first place and end of each) of the words that go, from passages()."""

    def found(x: dict[str, np.ndarray]) -> Iterator[dict[str, np.ndarray]]:
        answer = lambda k, a, b: {"t": mix(x["d"][k].view(np.uint64)), "d": x["d"][k], "r": x["r"][k], "a": a.astype("<u4"), "b": (b + anchor - 1).astype("<u4")}
        told = np.flatnonzero(x["n"] < 0)
        yield answer(told, x["s"][told], x["s"][told].astype(np.int64) - x["n"][told])
        asked = np.flatnonzero(x["n"] > 0)
        size = np.maximum(x["n"], 0).astype(np.int64)
        begin = np.cumsum(size) - size
        codes = x["lo"].astype(np.uint64) | x["hi"].astype(np.uint64) << np.uint64(32)
        # passages that are the same throughout, by key and document
        nth = np.arange(len(codes)) - np.repeat(begin, size)
        sums = np.concatenate((np.zeros(1, np.uint64), np.cumsum(mix(codes + nth.astype(np.uint64) * np.uint64(0x9E3779B97F4A7C15)))))
        same = sums[begin + size] - sums[begin] + size.astype(np.uint64)
        asked = asked[np.lexsort((x["d"][asked], same[asked], x["t"][asked]))]
        t, h, d = x["t"][asked], same[asked], x["d"][asked]
        lead = np.ones(len(asked), bool)
        lead[1:] = (t[1:] != t[:-1]) | (h[1:] != h[:-1])
        leader = np.flatnonzero(lead)[np.cumsum(lead) - 1] if len(asked) else np.zeros(0, np.int64)
        # the last one has the largest document: does any larger one than the leader's have it?
        last = np.concatenate((np.flatnonzero(lead)[1:], [len(asked)])) - 1 if len(asked) else np.zeros(0, np.int64)
        more = dict(zip(asked[lead].tolist(), (d[last] > d[lead]).tolist()))
        # shards: anchors one after another, until their passages have so many words
        one = asked[lead]
        group = np.cumsum(size[one]) // shard_words
        key = x["t"][one]
        starts = np.concatenate(([True], key[1:] != key[:-1])) if len(one) else np.zeros(0, bool)
        group = group[np.flatnonzero(starts)[np.cumsum(starts) - 1]] if len(one) else group
        spans_of: dict[tuple[int, bool], list[tuple[int, int]]] = {}
        for part in np.split(one, np.flatnonzero(np.diff(group)) + 1) if len(one) else ():
            part = part[np.argsort(x["d"][part], kind="stable")]
            own = size[part]
            ends = np.cumsum(own)
            words = codes[np.arange(ends[-1]) + np.repeat(begin[part] - (ends - own), own)]
            for k, a, b, after in streamed(x["d"][part], own, words, width - anchor + 1, np.array([more[int(k)] for k in part]), automaton):
                spans_of.setdefault((int(part[k]), after), []).append((a, b))
        # all that have a passage get what its one stream through the automaton told
        got = [(k, a, b) for k, of, after in zip(asked.tolist(), asked[leader].tolist(), (d > d[leader]).tolist()) for a, b in spans_of.get((of, after), ())]
        k, a, b = np.array(got, np.int64).reshape(-1, 3).T
        yield answer(k, x["s"][k] + a, x["s"][k] + b)

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        return dealt_out(found(gathered(batches, PASSAGE | {"lo": "<u4", "hi": "u1"})), deal)

    def by_document(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        x = gathered(batches, {"d": "<i8", "r": "<i8", "a": "<u4", "b": "<u4"})
        order = np.lexsort((x["a"], x["r"], x["d"]))
        d, r, both = x["d"][order], x["r"][order], np.stack((x["a"][order], x["b"][order]), 1)
        begin = np.flatnonzero(np.concatenate((np.ones(min(len(d), 1), bool), (d[1:] != d[:-1]) | (r[1:] != r[:-1]))))
        ends = np.append(begin[1:], len(d))
        for lo in range(0, len(begin), 2000):
            few = slice(lo, lo + 2000)
            yield pa.record_batch([pa.array(d[begin[few]]), pa.array(r[begin[few]]), pa.array([both[a:b].tobytes() for a, b in zip(begin[few], ends[few])], pa.binary())], ["doc_id", "r", "spans"])

    met = dealt_rows.repartitionById(deal, "p").mapInArrow(match, "p int, t binary, d binary, r binary, a binary, b binary")
    return met.select("p", "d", "r", "a", "b").repartitionById(deal, "p").mapInArrow(by_document, "doc_id long, r long, spans binary")


def remove_repeats(docs: DataFrame, *, width: int = 13, bits: int | None = None, frequent: int = 8, anchors: int = 2048, reference_words: int = 1 << 15, shard_words: int = SHARD_WORDS, automaton: type[Automaton] = Automaton) -> DataFrame:
    """doc_id, n_words, n_removed, kept (text) for every row of docs(doc_id, text, ...).

    Words are runs without white space, unchanged. A word goes if a window of `width` consecutive words covers it
    whose words also start, in the same order, in a document with a smaller doc_id; all windows are judged on the
    input. kept joins the other words by one space. A null or empty text has no words. Rows with a null doc_id lose
    nothing and count for nothing; rows that share a doc_id are one document to others and are each returned, judged by
    their own text; other columns are ignored; an empty table gives no rows. Texts are read whole. There are no ties: the
    smallest doc_id that has a window keeps it, at all its places.

    bits: size of the map of repeated anchors; by default 512 for each row, from 2^24 to 2^29 (64 MB). frequent,
    anchors, reference_words: how many documents an anchor of the broadcast reference has at least, and how many anchors
    and words the reference has at most. shard_words: words of passages that one automaton is made for, about. automaton:
    what is made for each shard; it alone decides what goes.
    """
    anchor = width // 2 + 1
    docs = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("r"))
    known = docs.where("doc_id is not null")
    n, size = text_size(docs)
    deal = parts(docs, size)
    if bits is None:
        bits = 1 << min(29, max(24, int(512 * max(n, 1)).bit_length()))
    side, found, hot = repeated_anchors(known, deal, width, anchor, bits, frequent, anchors)
    segments = reference_segments(known, width, anchor, hot, reference_words) if len(hot) else []
    repeats = spans(passages(known, deal, width, anchor, side, found, (hot, segments), automaton), deal, width, anchor, shard_words, automaton)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            n, removed, kept = [], [], []
            for text, gone in zip(batch.column("text").cast(pa.large_binary()).to_pylist(), batch.column("spans").to_pylist()):
                spelt = (text or b"").split()
                n.append(len(spelt))
                if gone:
                    cover = np.zeros(len(spelt) + 1, np.int32)
                    both = np.frombuffer(gone, "<u4").reshape(-1, 2)
                    np.add.at(cover, both[:, 0], 1)
                    np.add.at(cover, both[:, 1], -1)
                    stay = (np.cumsum(cover)[:-1] == 0).tolist()
                    removed.append(len(stay) - sum(stay))
                    kept.append(b" ".join([w for w, x in zip(spelt, stay) if x]).decode())
                else:
                    removed.append(0)
                    kept.append(b" ".join(spelt).decode())
            yield pa.record_batch([batch.column("doc_id"), pa.array(n, pa.int64()), pa.array(removed, pa.int64()), pa.array(kept, pa.string())], ["doc_id", "n_words", "n_removed", "kept"])

    # rows without a doc_id lose nothing, and aren't dealt by it
    without_id = docs.where("doc_id IS NULL").withColumn("spans", F.lit(None).cast("binary"))
    return known.join(repeats, ["doc_id", "r"], "left").unionByName(without_id).mapInArrow(finish, "doc_id long, n_words long, n_removed long, kept string")
