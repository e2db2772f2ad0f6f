"""Language ID by hyperdimensional profiles.

Each letter has a random vector of +1 and -1. An n-gram's vector binds the letters' vectors, each permuted (rolled)
by its place, by multiplying them; a text's vector bundles (sums) its n-grams' vectors; a language's prototype sums
the vectors of its learning texts, each scaled to length 1. A text gets the language whose prototype has the largest
cosine with its vector. Vectors follow from a seed, so executors make them themselves.
"""
from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.llm.common import once_per_worker, slices

CODES = 128  # 0: between words; 1-26: a-z; the other letters share the rest


def letter_codes(text: str) -> np.ndarray:
    """A code for each code point; letters are lower-cased and runs of other characters are one 0."""
    low = text.lower()
    points = np.frombuffer(low.encode("utf-32-le", "replace"), "<u4")
    plain = np.zeros(128, np.uint8)
    plain[97:123] = np.arange(1, 27)
    out = plain[np.minimum(points, 127)]
    if not low.isascii():
        wide = np.flatnonzero(points > 127)
        kinds, back = np.unique(points[wide], return_inverse=True)
        out[wide] = np.array([27 + int(c) * 2654435761 % 2**32 % (CODES - 27) if chr(c).isalpha() else 0 for c in kinds], np.uint8)[back]
    out = np.concatenate(([0], out, [0])).astype(np.uint8)
    return out[np.concatenate(([True], (out[1:] > 0) | (out[:-1] > 0)))]


def gram_counts(text: str) -> tuple[np.ndarray, np.ndarray]:
    """Codes of the distinct letter trigrams, and how often each occurs."""
    c = letter_codes(text).astype(np.int32)
    if len(c) < 3:
        return np.zeros(0, np.int64), np.zeros(0, np.int64)
    return np.unique(c[:-2] * CODES * CODES + c[1:-1] * CODES + c[2:], return_counts=True)


def letter_vectors(size: int, seed: int) -> list[np.ndarray]:
    """The letters' vectors, rolled for the first, second and third place of a trigram."""
    one = np.random.default_rng(seed).choice(np.array([-1, 1], np.int8), (CODES, size))
    return [np.roll(one, k, 1) for k in (2, 1, 0)]


def bundle(text: str, letters: list[np.ndarray]) -> np.ndarray:
    """The text's vector, of length 1; zeros without a trigram."""
    grams, counts = gram_counts(text)
    out = np.zeros(letters[0].shape[1], np.float32)
    for lo in range(0, len(grams), 2048):
        g = grams[lo : lo + 2048]
        bound = letters[0][g // CODES**2] * letters[1][g // CODES % CODES] * letters[2][g % CODES]
        out += counts[lo : lo + 2048].astype(np.float32) @ bound.astype(np.float32)
    size = float(np.sqrt(out @ out))
    return out / size if size else out


def has_letter(text: str | None) -> bool:
    return bool(text) and any(map(str.isalpha, text))


def learn_prototypes(learn: DataFrame, *, size: int, seed: int) -> tuple[list[str], np.ndarray]:
    """Languages (sorted) and their prototypes from learn(text, lang), over all its rows: each task sums the vectors
    of each language it met, the sums are added, and `size` numbers for each language come to the driver and go to each task:
    8 KB a language at 1024, so that some thousands of languages are what this is for."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = once_per_worker(("letters", size, seed), lambda: letter_vectors(size, seed))
        sums: dict[str, np.ndarray] = {}
        for batch in slices(batches, "text"):
            for text, lang in zip(batch.column("text").to_pylist(), batch.column("lang").to_pylist()):
                sums[lang] = sums.get(lang, 0) + bundle(text, letters).astype(np.float64)
        yield pa.record_batch([pa.array(list(sums), pa.string()), pa.array([np.round(v * 2**20).astype(np.int64).tolist() for v in sums.values()], pa.list_(pa.int64()))], ["lang", "v"])

    rows = learn.select("text", "lang").mapInArrow(run, "lang string, v array<long>")
    at = rows.select("lang", F.posexplode("v").alias("k", "x")).groupBy("lang", "k").agg(F.sum("x").alias("x"))
    got: dict[str, np.ndarray] = {}
    for r in at.collect():
        got.setdefault(r["lang"], np.zeros(size))[r["k"]] = r["x"]
    names = sorted(got)
    made = np.array([got[n] for n in names]).reshape(len(names), size)
    return names, (made / np.maximum(np.sqrt((made**2).sum(1, keepdims=True)), 1e-12)).astype(np.float32)


def identify(docs: DataFrame, learn: DataFrame, *, size: int = 1024, seed: int = 7) -> DataFrame:
    """doc_id, lang_pred, score for every row of docs(doc_id, text, ...), learnt from learn(text, lang).

    score is the cosine with the chosen prototype, 0 at least. A null text, or one without a letter, is `und` with
    score 0; so is every text when nothing could be learnt. Ties go to the first language in order of name. Rows of
    learn with a null text or lang, or without letters, teach nothing. A null doc_id is kept; rows that repeat are
    each returned; other columns are ignored; empty tables give no rows. Whole texts are read, however long.
    """
    taught = learn.where(F.col("lang").isNotNull() & F.col("text").rlike(r"\p{L}"))
    names, prototypes = learn_prototypes(taught, size=size, seed=seed)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        letters = once_per_worker(("letters", size, seed), lambda: letter_vectors(size, seed))
        for batch in slices(batches, "text"):
            langs, scores = [], []
            for text in batch.column("text").to_pylist():
                lang, score = "und", 0.0
                if names and has_letter(text):
                    near = prototypes @ bundle(text, letters)
                    lang, score = names[int(near.argmax())], float(min(1, max(0, near.max())))
                langs.append(lang)
                scores.append(score)
            yield pa.record_batch([batch.column("doc_id"), pa.array(langs, pa.string()), pa.array(scores, pa.float64())], ["doc_id", "lang_pred", "score"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, lang_pred string, score double")
