"""Main text of web pages by a linear-chain conditional random field over their leaf blocks.

A block is text of the article or not. What is seen of it (its tag, its ancestors and what their class, id and role say,
its length, links and marks) gives each label a weight, and so does each pair of labels that follow each other; the best
sequence of labels for the whole page is found by Viterbi. The weights are those of greatest regularised likelihood on
labelled pages, made for the purpose, as the tables have none.
"""
from __future__ import annotations

from collections.abc import Iterator
from functools import lru_cache

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from lakeforge.llm.common import slices
from lakeforge.llm.labelled_pages import Page
from lakeforge.llm.page_blocks import blocks_of

Model = tuple[dict[str, float], list[list[float]]]


def examples(pages: int) -> list[tuple[list[list[str]], list[int]]]:
    out = []
    for seed in range(pages):
        page = Page(seed)
        names = [n for _, n in blocks_of("".join(page.html))]
        if len(names) != len(page.labels):
            raise ValueError(f"labelled page {seed} has {len(page.labels)} labels for {len(names)} blocks")
        if names:
            out.append((names, page.labels))
    return out


def expected(score: np.ndarray, move: np.ndarray, there: np.ndarray) -> tuple[float, np.ndarray, np.ndarray]:
    """Sum of log normalisers, probabilities of label 1 and expected numbers of moves, for pages (rows) of blocks (columns)
    with score for label 1 over label 0; there: which places hold a block."""
    n, length = score.shape
    both = np.stack((np.zeros_like(score), score), 2)
    ahead = np.zeros((n, length, 2))
    ahead[:, 0] = both[:, 0]
    for t in range(1, length):
        step = np.logaddexp.reduce(ahead[:, t - 1, :, None] + move, axis=1) + both[:, t]
        ahead[:, t] = np.where(there[:, t, None], step, ahead[:, t - 1])
    behind = np.zeros((n, length, 2))
    for t in range(length - 2, -1, -1):
        step = np.logaddexp.reduce(move + (both[:, t + 1] + behind[:, t + 1])[:, None, :], axis=2)
        behind[:, t] = np.where(there[:, t + 1, None], step, 0)
    norm = np.logaddexp.reduce(ahead[:, -1], axis=1)
    p = np.exp(ahead + behind - norm[:, None, None])[:, :, 1] * there
    pair = ahead[:, :-1, :, None] + move + (both[:, 1:] + behind[:, 1:])[:, :, None, :] - norm[:, None, None, None]
    return float(norm.sum()), p, (np.exp(pair) * there[:, 1:, None, None]).sum((0, 1))


@lru_cache(maxsize=4)
def train(pages: int, rounds: int = 120, penalty: float = 0.5) -> Model:
    """Weights by name and of moves, by steepest ascent of the penalised log likelihood with steps that adapt (Adam)."""
    known = examples(pages)
    index = {name: k for k, name in enumerate(sorted({x for names, _ in known for b in names for x in b}))}
    n, length = len(known), max(len(labels) for _, labels in known)
    x, y, there = np.zeros((n, length, len(index)), np.float32), np.zeros((n, length)), np.zeros((n, length), bool)
    for i, (names, labels) in enumerate(known):
        y[i, : len(labels)], there[i, : len(labels)] = labels, True
        for t, b in enumerate(names):
            x[i, t, [index[name] for name in b]] = 1
    flat = x.reshape(-1, len(index))
    seen = (y * there).ravel() @ flat
    now, then, both = y[:, 1:].astype(int), y[:, :-1].astype(int), there[:, 1:]
    moved = np.array([[(both & (then == a) & (now == b)).sum() for b in (0, 1)] for a in (0, 1)], float)
    w = np.zeros(len(index) + 4)
    first, second = np.zeros_like(w), np.zeros_like(w)
    for k in range(1, rounds + 1):
        _, p, pair = expected((flat @ w[:-4].astype(np.float32)).reshape(n, length).astype(float), w[-4:].reshape(2, 2), there)
        slope = np.concatenate((seen - p.ravel() @ flat, (moved - pair).ravel())) - penalty * w
        first, second = 0.9 * first + 0.1 * slope, 0.99 * second + 0.01 * slope**2
        w += 0.2 * (1 - k / (rounds + 1)) * (first / (1 - 0.9**k)) / (np.sqrt(second / (1 - 0.99**k)) + 1e-9)
    return {name: round(float(w[i]), 6) for name, i in index.items()}, [[round(float(v), 6) for v in row] for row in w[-4:].reshape(2, 2)]


def viterbi(scores: list[float], move: list[list[float]]) -> list[int]:
    """The best labels; of equally good ones, those with the later first 1."""
    if not scores:
        return []
    (stay0, rise), (fall, stay1) = move
    zero, one, back = 0.0, scores[0], []
    for s in scores[1:]:
        back.append((int(one + fall > zero + stay0), int(one + stay1 >= zero + rise)))
        zero, one = max(zero + stay0, one + fall), max(one + stay1, zero + rise) + s
    out = [int(one > zero)]
    for b in reversed(back):
        out.append(b[out[-1]])
    return out[::-1]


def main_text(html: str | None, model: Model) -> str:
    weights, move = model
    blocks = blocks_of(html)
    labels = viterbi([sum(weights.get(n, 0.0) for n in names) for _, names in blocks], move)
    return " ".join(text for (text, _), label in zip(blocks, labels) if label)


def extract(pages: DataFrame, *, training_pages: int = 600) -> DataFrame:
    """page_id, url, text, n_chars of every row of pages(page_id, url, html, ...), whatever the page's size.

    A null html counts as empty and has an empty text, as has a page without text of an article. Rows that repeat are each
    returned, null ids and urls stay, other columns are ignored, an empty table gives no rows. Of labels that are equally
    good the ones with less text win. The field is trained on `training_pages` made pages, by the driver, in seconds; a page
    is read in time linear in its length, and its features are of a fixed list, so a task holds one page and its blocks.
    """
    model = train(training_pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in slices(batches, "html"):
            text = [main_text(html, model) for html in batch.column("html").to_pylist()]
            yield pa.record_batch([batch.column("page_id"), batch.column("url"), pa.array(text, pa.string()), pa.array(map(len, text), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"), F.col("html").cast("string").alias("html")).mapInArrow(run, "page_id long, url string, text string, n_chars long")
