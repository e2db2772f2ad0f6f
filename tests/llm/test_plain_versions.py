"""Classifiers, packing and the whole pipeline against plain versions, row by row and piece by piece."""
import math
import random
from collections import defaultdict
from fractions import Fraction

import duckdb
import numpy as np
import pytest

import corpus_pipeline
from lakeforge.llm import language_id, packing, quality, queries
from tests.llm import brute
from tests.llm.test_operators import SF, check_packing, plainly_held

# --- 7 language ID ---


def letters_of(text):
    """Codes of letters, one 0 for whatever lies between them, at both ends, too."""
    out = [0]
    for c in text.lower():
        if "a" <= c <= "z":
            out.append(ord(c) - 96)
        elif ord(c) > 127 and c.isalpha():
            out.append(27 + ord(c) * 2654435761 % 2**32 % (language_id.CODES - 27))
        elif out[-1]:
            out.append(0)
    return out if not out[-1] else [*out, 0]


def vector(text, one):
    """The sum of the trigrams' vectors, each made of its letters' one by one, scaled to length 1."""
    out, codes, seen = np.zeros(len(one[0])), letters_of(text), {}
    for gram in zip(codes, codes[1:], codes[2:]):
        if gram not in seen:
            seen[gram] = np.roll(one[gram[0]], 2).astype(int) * np.roll(one[gram[1]], 1) * one[gram[2]]
        out += seen[gram]
    size = math.sqrt(sum(out * out))
    return out / size if size else out


def plain_languages(rows, size=1024, seed=7):
    one = np.random.default_rng(seed).choice(np.array([-1, 1], np.int8), (language_id.CODES, size))
    made = defaultdict(lambda: np.zeros(size))
    vectors = {k: vector(t, one) for k, (_, t, _) in enumerate(rows) if t and any(map(str.isalpha, t))}
    for k, (i, _, lang) in enumerate(rows):
        if k in vectors and lang is not None and brute.learns(i):
            made[lang] += vectors[k]
    names = sorted(made)
    out = {}
    for k, (i, _, _) in enumerate(rows):
        near = [vectors[k] @ made[n] / math.sqrt(made[n] @ made[n]) for n in names] if k in vectors else []
        best = max(range(len(near)), key=lambda j: near[j], default=None)
        out[i] = (not brute.learns(i), "und", 0.0) if best is None else (not brute.learns(i), names[best], min(1.0, max(0.0, near[best])))
    return out


def test_language_query_row_by_row(spark):
    want = plain_languages(duckdb.sql(f"SELECT doc_id, text, lang FROM '{SF}/documents.parquet'").fetchall())
    out = {r.doc_id: (r.held_out, r.lang_pred, r.score) for r in queries.op7_language_id(spark, SF).collect()}
    assert out.keys() == want.keys() and len({x[1] for x in out.values()}) >= 4
    for i, (held, lang, score) in want.items():
        assert out[i][:2] == (held, lang) and out[i][2] == pytest.approx(score, abs=1e-4)


# --- 8 quality ---


def plain_statistics(text):
    b = (text or "").encode()
    marks, ends = set(quality.MARKS), set(b".,;:?'\"-")
    words = b.split()
    count = lambda of: sum(c in of for c in b)
    letters = sum(65 <= c <= 90 or 97 <= c <= 122 or c > 127 for c in b)
    share = lambda part, of: math.log(0.002 + part / max(of, 1))
    lone = sum(len(w) < 4 and all(c in marks for c in w) for w in words)
    return [
        math.log(1 + len(words)), math.log((sum(map(len, words)) + 1) / (len(words) + 1)), share(count(range(65, 91)), letters), share(count(range(48, 58)), len(b)), share(count(ends), len(b)),
        share(count(marks) - count(ends), len(b)), share(lone, len(words)), share(sum(x == y for x, y in zip(words, words[1:])), len(words)), share(len(set(words)), len(words)), math.log(1 + len(words) / (b.count(b"\n") + 1)),
    ]


def test_quality_query_row_by_row(spark):
    texts = dict(duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall())
    labels = [(i, q) for i, q in duckdb.sql(f"SELECT doc_id, quality FROM '{SF}/labels.parquet'").fetchall() if i in texts and brute.learns(i) and q in (0, 1)]
    x = {i: np.array(plain_statistics(t)) for i, t in texts.items()}
    of = {c: np.array([x[i] for i, q in labels if q == c]) for c in (0, 1)}
    cov = {c: np.cov(v, rowvar=False, bias=True) for c, v in of.items()}
    pooled = sum(len(of[c]) * cov[c] for c in of) / len(labels)

    def density(c, v):
        s = 0.97 * (0.7 * cov[c] + 0.3 * pooled)
        s += 0.03 * np.trace(0.7 * cov[c] + 0.3 * pooled) / len(s) * np.eye(len(s))
        away = v - of[c].mean(0)
        return math.log(len(of[c]) / len(labels)) - 0.5 * (away @ np.linalg.solve(s, away) + np.linalg.slogdet(s)[1])

    out = queries.op8_quality(spark, SF).collect()
    assert len(out) == len(texts)
    for r in out:
        odds = density(1, x[r.doc_id]) - density(0, x[r.doc_id])
        assert r.score == pytest.approx(1 / (1 + math.exp(-max(-40, min(40, odds)))), abs=1e-6)
        assert r.predicted == (r.score >= 0.7) and r.held_out == (not brute.learns(r.doc_id))


# --- 9 packing ---


def round_robin(totals, weights, window):
    """Of each window, how many tokens each queue gives, when tokens are sent one by one in order of when they are due:
    token k of a queue after (k + early) / rate, queues without a weight after all others."""
    n = len(totals)
    live = [q for q in range(n) if totals[q] and weights[q]]
    end = max((Fraction(totals[q], weights[q]) for q in live), default=Fraction(0))
    line = []
    for q in range(n):
        rate, start = (weights[q], Fraction(0)) if q in live else (max(totals[q], 1), end)
        line += [(start + (k + Fraction(2 * q + 1, 2 * n)) / rate, q) for k in range(totals[q])]
    line = [q for _, q in sorted(line)]
    return [[line[k : k + window].count(q) for q in range(n)] for k in range(0, len(line), window)]


@pytest.mark.parametrize("seed", range(12))
def test_packing_is_deficit_round_robin(seed):
    r = random.Random(seed)
    n, window = r.choice([1, 2, 3, 7]), r.choice([5, 16, 64])
    totals = [r.randrange(0, 400) for _ in range(n)]
    weights = [totals, [r.randrange(1, 9) for _ in range(n)], [r.choice([0, 3, 1]) for _ in range(n)]][seed % 3]
    plan = packing.phases(totals, weights, window)
    want = round_robin(totals, weights, window)
    sent = packing.quotas(plan, np.arange(len(want) + 1))
    assert np.diff(sent, axis=0).tolist() == want
    for q, total in enumerate(totals):  # pieces: each window's queues one after another
        pieces = [(k * window + sum(x[:q]), x[q]) for k, x in enumerate(want) if x[q]]
        assert sorted((place, m) for _, m, place in packing.places(plan, window, q, 0, total)) == pieces


def test_packing_of_three_thousand_sources(spark):
    """Every window's tokens, of 3000 sources, are those that are due; the whole operator holds every token once."""
    r = random.Random(1)
    totals = [r.randrange(1, 9) for _ in range(2990)] + [500] * 10
    want = round_robin(totals, totals, 256)
    sent = packing.quotas(packing.phases(totals, totals, 256), np.arange(len(want) + 1))
    assert np.diff(sent, axis=0).tolist() == want
    docs = spark.createDataFrame([(k, "a b c" * (k % 3), f"s{k % 3000}") for k in range(4000)], "doc_id long, text string, source string").repartition(3)
    pieces = packing.pack(docs, queries.vocabulary("byte_bpe_50k.json"), window=1024)
    check_packing(pieces.collect(), [(r.doc_id, r.text) for r in docs.collect()], 1023)


# --- the pipeline ---


def plain_pipeline(docs, items):
    """(doc_id, text) of what is packed, by the stages' plain versions one after another."""
    docs = [(i, t) for i, t in docs if any(map(str.isalpha, t or ""))]
    lines = brute.lines(docs)
    keys, where = brute_line_keys(docs)
    docs = [(i, kept_lines(i, t, keys, where)) for i, t in docs]
    assert sorted((i, brute.sha(t)) for i, t in docs) == sorted((i, s) for i, _, _, s in lines)
    stay = {i for i, _, c, _ in brute.jaccard(docs) if i == c}
    docs = [x for x in docs if x[0] in stay]
    held = {x[0] for x in plainly_held(docs, items)}
    return [x for x in docs if x[0] not in held]


def brute_line_keys(docs):
    where = defaultdict(set)
    for i, t in docs:
        for line in (t or "").split("\n"):
            key = line.strip(brute.BLANK).translate(brute.LOWER)
            if len(key) >= 40:
                where[key].add(i)
    return {k for k, v in where.items() if len(v) >= 5}, where


def kept_lines(i, t, keys, where):
    key = lambda line: line.strip(brute.BLANK).translate(brute.LOWER)
    return "\n".join(x for x in (t or "").split("\n") if key(x) not in keys or max(where[key(x)]) == i)


def test_pipeline_against_plain_versions(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    items = duckdb.sql(f"SELECT item_id, text FROM '{SF}/benchmark.parquet'").fetchall()
    want = plain_pipeline(docs, items)
    assert 20 < len(want) < len(docs)
    pieces = corpus_pipeline.run(spark, SF).collect()
    assert {p.doc_id for p in pieces} == {i for i, _ in want}
    check_packing(pieces, want, 1023)
