"""Quality classifier: regularised quadratic discriminant over transformed document statistics.

Each class is a Gaussian over the statistics, its covariance shrunk towards the pooled one and towards a multiple of
the identity. A score is the logistic of the difference of two log densities, each a Mahalanobis distance through a
Cholesky factor computed once, and of the log ratio of the classes' sizes.
"""
from __future__ import annotations

import operator
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.llm.common import cut, slices

STATISTICS = ("words", "word_length", "capitals", "digits", "sentence_marks", "other_marks", "lone_marks", "adjacent_repeats", "distinct_words", "words_a_line")
MARKS = bytes(c for c in range(33, 127) if not chr(c).isalnum())


def statistics(text: bytes) -> list[float]:
    """The text's statistics, each a logarithm so that classes look more like Gaussians."""
    count = np.bincount(np.frombuffer(text, np.uint8), minlength=256)
    words = text.split()
    n, size = len(words), max(len(text), 1)
    letters = count[65:91].sum() + count[97:123].sum() + count[128:].sum()
    ends = count[list(b".,;:?'\"-")].sum()
    marks = count[list(MARKS)].sum() - ends
    lone = sum(not w.strip(MARKS) for w in words if len(w) < 4)
    again = sum(map(operator.eq, words, words[1:]))
    share = lambda part, of: float(np.log(0.002 + part / max(of, 1)))
    return [float(np.log1p(n)), float(np.log((sum(map(len, words)) + 1) / (n + 1))), share(count[65:91].sum(), letters), share(count[48:58].sum(), size), share(ends, size),
            share(marks, size), share(lone, n), share(again, n), share(len(set(words)), n), float(np.log1p(n / (count[10] + 1)))]


def document_statistics(docs: DataFrame) -> DataFrame:
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "text"):
            x = [statistics(t or b"") for t in batch.column("text").cast(pa.large_binary()).to_pylist()]
            yield pa.record_batch([batch.column("doc_id"), pa.array(x, pa.list_(pa.float64()))], ["doc_id", "x"])

    return docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text").mapInArrow(run, "doc_id long, x array<double>")


def moments(learn: DataFrame) -> dict[int, tuple[int, np.ndarray, np.ndarray]]:
    """Rows, sums and sums of products of each class, from learn(x, label); one row for each class and task is
    shuffled, one for each class reaches the driver."""
    k = len(STATISTICS)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        total = {0: np.zeros(1 + k + k * k), 1: np.zeros(1 + k + k * k)}
        for batch in batches:
            x, label = np.array(batch.column("x").to_pylist(), float).reshape(-1, k), np.array(batch.column("label").to_pylist(), int)
            for c in total:
                own = x[label == c]
                total[c] += np.concatenate(([len(own)], own.sum(0), (own.T @ own).ravel()))
        yield pa.record_batch([pa.array([0, 1], pa.int32()), pa.array([total[0].tolist(), total[1].tolist()], pa.list_(pa.float64()))], ["label", "s"])

    sums = learn.select("x", "label").mapInArrow(run, "label int, s array<double>").groupBy("label")
    rows = sums.agg(F.array(*(F.sum(F.col("s")[i]) for i in range(1 + k + k * k))).alias("s")).collect()
    return {r["label"]: (int(r["s"][0]), np.array(r["s"][1 : 1 + k]), np.array(r["s"][1 + k :]).reshape(k, k)) for r in rows if r["s"][0]}


def fit(classes: dict[int, tuple[int, np.ndarray, np.ndarray]], to_pooled: float, to_identity: float) -> dict[int, tuple[float, np.ndarray, np.ndarray, float]]:
    """By class: log prior, mean, inverse Cholesky factor, log determinant of the covariance."""
    n = sum(c[0] for c in classes.values())
    cov = {c: xx / m - np.outer(x / m, x / m) for c, (m, x, xx) in classes.items()}
    pooled = sum(classes[c][0] * cov[c] for c in classes) / max(n, 1)
    out = {}
    for c, (m, x, _) in classes.items():
        s = (1 - to_pooled) * cov[c] + to_pooled * pooled
        s = (1 - to_identity) * s + to_identity * max(np.trace(s) / len(s), 1e-6) * np.eye(len(s))
        factor = np.linalg.cholesky(s)
        out[c] = (float(np.log(m / n)), x / m, np.linalg.inv(factor), float(2 * np.log(np.diag(factor)).sum()))
    return out


def log_odds(model: dict, x: np.ndarray) -> np.ndarray:
    """Of label 1; 0 when nothing was learnt, far to one side when one class only was."""
    if len(model) < 2:
        return np.full(len(x), 0.0 if not model else 20.0 if 1 in model else -20.0)
    density = {c: prior - 0.5 * (det + (((x - mean) @ inverse.T) ** 2).sum(1)) for c, (prior, mean, inverse, det) in model.items()}
    return density[1] - density[0]


def score_quality(docs: DataFrame, labels: DataFrame, *, threshold: float = 0.7, to_pooled: float = 0.3, to_identity: float = 0.03) -> DataFrame:
    """doc_id, score, predicted for every row of docs(doc_id, text, ...), learnt from labels(doc_id, quality).

    All label rows teach whose quality is 0 or 1 and whose doc_id occurs in docs. A null text counts as empty, which
    has statistics and so a score like any other. A null doc_id is kept (and learns nothing); rows that repeat are
    each returned and each teach; other columns are ignored; an empty docs gives no rows, without labels all scores
    are 0.5. Whole texts are read, however long.
    """
    x = cut(document_statistics(docs))
    known = labels.where(F.col("quality").isin(0, 1)).select(F.col("doc_id").cast("long").alias("doc_id"), F.col("quality").cast("int").alias("label"))
    model = fit(moments(x.join(known, "doc_id")), to_pooled, to_identity)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            odds = log_odds(model, np.array(batch.column("x").to_pylist(), float).reshape(-1, len(STATISTICS)))
            score = 1 / (1 + np.exp(-np.clip(odds, -40, 40)))
            yield pa.record_batch([batch.column("doc_id"), pa.array(score), pa.array((score >= threshold).astype(np.int32))], ["doc_id", "score", "predicted"])

    return x.mapInArrow(run, "doc_id long, score double, predicted int")
