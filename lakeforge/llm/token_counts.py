"""Token counts of whole texts by a map-side two-tier lookup.

Tier one is a compact table of frequent pre-tokens and their token counts, broadcast to all tasks: those that the model
has as whole pieces, as its training gave pieces to what is frequent. So the table is known without a scan of the
documents, and its size is the vocabulary's at most. Tier two is a cache in each Python worker; a miss there is encoded
by the tokenizer's own library. No pre-token is ever shuffled; the documents are read once.

A pre-token is a run of spaces and the non-spaces after it. No piece of the vocabulary has a space after a
non-space, so merges never cross such a place and counts of pre-tokens add up to the count of the text. The driver
checks this of the model; a model for which it doesn't hold has whole texts encoded by its library.
"""
from __future__ import annotations

import hashlib
import re
from collections.abc import Iterator

import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.llm.common import once_per_worker, slices

MARK = "▁"  # a space, in this library's pieces


class Lengths(dict):
    """Pre-token -> token count; the broadcast table, then what this worker met. Full, it stays as it is."""

    def __init__(self, table, count, most):
        super().__init__(table)
        self.count, self.most = count, most

    def __missing__(self, word):
        n = self.count(word)
        if len(self) < self.most and len(word) <= 64:
            self[word] = n
        return n


def pre_tokens(text: str) -> list[str]:
    """Each pre-token without its first space (that stands for the library's dummy prefix)."""
    if MARK in text:
        text = text.replace(MARK, " ")
    if "  " in text or text[:1] == " " or text[-1:] == " ":
        return [x[1:] for x in re.findall(" +[^ ]*", " " + text)]
    return text.split(" ") if text else []


def piece_model(proto: bytes):
    import sentencepiece

    return sentencepiece.SentencePieceProcessor(model_proto=proto)


def separable(proto: bytes) -> bool:
    """Whether counts of pre-tokens add up, for this model."""
    model = piece_model(proto)
    pieces = [model.id_to_piece(i) for i in range(model.vocab_size())]
    odd = " a  b　ﬁ \t\n Á "
    same = "".join(map(model.id_to_piece, model.encode("x　ﬁ  y "))) == MARK + "x　ﬁ" + MARK * 2 + "y" + MARK
    plain = not any(re.search(f"[^{MARK}]{MARK}", p) for p in pieces)
    return plain and same and MARK in pieces and sum(map(piece_counter(model), pre_tokens(odd))) == len(model.encode(odd))


def piece_counter(model):
    lone = len(model.encode("a ")) - len(model.encode("a"))  # of a single space at the end
    return lambda word: len(model.encode(word)) if word else lone


def known_words(model) -> list[str]:
    """The pre-tokens that the model holds as whole pieces: those frequent enough to have got a piece of their own."""
    pieces = (model.id_to_piece(i) for i in range(model.vocab_size()))
    return [p[1:] for p in pieces if p[:1] == MARK and MARK not in p[1:] and 1 < len(p) <= 64]


def count_tokens(docs: DataFrame, model: bytes, *, kind: str = "model", limit: int = 4096, table_size: int = 32768, cache: int = 1 << 17) -> DataFrame:
    """doc_id, n_bytes, n_tokens, over_limit of every row of docs(doc_id, text, ...).

    model: the bytes of a sentencepiece file (kind "model") or of a tokenizers file (kind "json", encoded text by
    text). table_size: entries of tier one at most, in the order of the model's ids; cache: entries that a worker adds.
    Both decide about speed only. A null text counts as empty: 0 bytes, 0 tokens. A null doc_id stays null; rows that repeat are each
    returned; other columns are ignored; of an empty table nothing is returned. A very long text is encoded whole.
    """
    sc = docs.sparkSession.sparkContext
    split = kind == "model" and separable(model)
    table = {}
    if split:
        one = piece_model(model)
        count = piece_counter(one)
        table = {w: count(w) for w in known_words(one)[:table_size]}
    shared = sc.broadcast((model, table))
    tag = ("lengths", hashlib.sha256(model).hexdigest(), kind, table_size, cache)

    def counter():
        proto, known = shared.value
        if kind == "json":
            from tokenizers import Tokenizer

            whole = Tokenizer.from_str(proto.decode())
            whole.no_padding(), whole.no_truncation()
            return lambda text: len(whole.encode(text, add_special_tokens=False).ids)
        one = piece_model(proto)
        if not split:
            return lambda text: len(one.encode(text))
        lengths = Lengths(known, piece_counter(one), cache)
        return lambda text: sum(map(lengths.__getitem__, pre_tokens(text)))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        tokens = once_per_worker(tag, counter)
        for batch in slices(batches, "text"):
            text = batch.column("text").fill_null("")
            n = pa.array([tokens(x) for x in text.to_pylist()], pa.int64())
            size = pc.binary_length(text).cast(pa.int64())
            yield pa.record_batch([batch.column("doc_id"), size, n, pc.greater(n, limit)], ["doc_id", "n_bytes", "n_tokens", "over_limit"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, n_bytes long, n_tokens long, over_limit boolean")
