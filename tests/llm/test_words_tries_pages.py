"""Operators 11 to 13, and the SQL of word rules, against plain versions and rows made to be awkward."""
import hashlib
import random
import re
import zlib
from collections import Counter
from html import unescape

import duckdb
import pytest

from lakeforge.llm import html_extraction, prefix_trie, queries, spelling
from lakeforge.llm.labelled_pages import Page
from lakeforge.llm.page_blocks import blocks_of
from tests.llm import brute
from tests.llm.test_operators import SF, frame
from tests.oracle import spark_rows, sql_rows

# --- 11 spelling variants ---


def variants(docs, every=199):
    n = Counter()
    for i, t in docs:
        for w in re.findall("[A-Za-zÀ-ÿ]+", t or ""):
            w = w.translate(brute.LOWER)
            h = zlib.crc32(f"{'' if i is None else i}:{w}".encode())
            if h % every == 0:
                w = w[: h % len(w)] + w[h % len(w) + 1 :]
            n[w] += 1
    words = {w: k for w, k in n.items() if len(w) >= 6 and k >= 5}
    near = {w: [x for x in words if one_edit(w, x)] for w in words}
    form = {w: best for w, xs in near.items() for best in sorted(xs, key=lambda x: (-words[x], x))[:1] if words[best] >= 5 * words[w]}

    def root(w):
        while w in form:
            w = form[w]
        return w

    return brute.multiset((w, form.get(w), root(w), k, len(near[w]), words[form[w]] if w in form else None) for w, k in words.items())


def one_edit(a, b):
    if abs(len(a) - len(b)) > 1 or a == b:
        return False
    if len(a) == len(b):
        return sum(x != y for x, y in zip(a, b)) == 1
    a, b = sorted((a, b), key=len)
    return any(b[:k] + b[k + 1 :] == a for k in range(len(b)))


NAMES11 = ("word", "form", "root", "n", "n_near", "form_n")


def told(df, names=NAMES11):
    return brute.multiset(tuple(r[c] for c in names) for r in df.collect())


def spelt(seed=5):
    """Few letters, so that anagrams and near words abound; runs of one letter; words of odd letters; chains of forms."""
    r = random.Random(seed)
    rows = [(1, None), (2, ""), (None, "Null Identity " * 6), (3, "short words only but a b c")]
    words = ["".join(r.choices("abÀé÷", k=r.randrange(5, 9))) for _ in range(150)] + ["aaaaaa", "aaaaaaa", "aaaabaa", "Aaaaaaaa", "abcdef", "badcfe"]
    rows += [(10 + k, " ".join(r.choices(words, k=300)) + "\n-x-") for k in range(8)]
    chain = ["colour", "colours", "coloursx", "coloursxy"]
    rows += [(40 + k, " ".join(w for j, w in enumerate(chain) for _ in range(700 // 6**j))) for k in range(6)]
    rows += [(60 + k, "y" * 20_000 + " " + "y" * 20_001) for k in range(5)] + [(70, "twice aaaaaa")] * 2
    return rows


def test_variants(spark):
    rows = spelt()
    short = [x for x in rows if not 60 <= (x[0] or 0) < 65]
    assert told(spelling.group_variants(frame(spark, short).repartition(3))) == variants(short)
    assert told(spelling.group_variants(frame(spark, short).repartition(3), every=3)) == variants(short, 3)
    long = {r.word: r for r in spelling.group_variants(frame(spark, rows), every=10**12).collect()}
    assert (long["y" * 20_000].n_near, long["y" * 20_001].n_near, long["y" * 20_000].form) == (1, 1, None)
    assert spelling.group_variants(frame(spark, rows[:2])).count() == 0


def test_variant_chain(spark):
    out = {r.word: r for r in spelling.group_variants(frame(spark, [(k, " ".join(w for j, w in enumerate(("colour", "colours", "coloursx", "coloursxy")) for _ in range(200 // 5**j))) for k in range(5)]), every=10**12).collect()}
    assert {w: (r.form, r.root) for w, r in out.items()} == {"colour": (None, "colour"), "colours": ("colour", "colour"), "coloursx": ("colours", "colour"), "coloursxy": ("coloursx", "colour")}


def test_anagrams_alone_are_not_near(spark):
    rows = [(k, "abcdef badcfe fedcba abcdeg") for k in range(6)]
    out = {r.word: r.n_near for r in spelling.group_variants(frame(spark, rows), every=10**12).collect()}
    assert out == {"abcdef": 1, "badcfe": 0, "fedcba": 0, "abcdeg": 1}


# --- 12 conversation prefix trie ---

NAMES12 = ("conv_id", "depth", "parent_conv_id", "n_convs", "n_children", "n_leaves", "saved_tokens", "ends_sha256")


def trie(rows):
    turns = {}
    for c, t, role, text in rows:
        if c is not None:
            turns.setdefault(c, []).append((t is not None, t or 0, role or "", text or ""))
    for xs in turns.values():
        xs.sort(key=lambda x: x[:2])
    members, ends = {}, {}
    for c, own in turns.items():
        h = zlib.crc32(str(c).encode()) % 6
        path = tuple(x[2:] for x in turns.get(c - c % 100, [])[:h] + own[h:])
        for d in range(len(path) + 1):
            members.setdefault(path[:d], []).append(c)
        ends.setdefault(path, []).append(c)
    children, leaves, saved = Counter(p[:-1] for p in members if p), Counter(), Counter()
    for p, cs in members.items():
        for d in range(len(p) + 1):
            leaves[p[:d]] += not children[p]
            saved[p[:d]] += (len(cs) - 1) * (len(p[-1][1]) if p else 0)
    digest = lambda p: hashlib.sha256(",".join(map(str, sorted(ends.get(p, [])))).encode()).hexdigest()
    return brute.multiset((min(cs), len(p), min(members[p[:-1]]) if p else None, len(cs), children[p], leaves[p], saved[p], digest(p)) for p, cs in members.items())


def talks(seed=6):
    r = random.Random(seed)
    says = [("user", f"text {k} é😀" * (k % 4)) for k in range(5)] + [(None, None), ("", ""), (None, "text"), ("user", None)]
    rows = [(c, t, *r.choice(says)) for c in [*range(0, 130, 3), *range(250, 260), 1000, 1001] for t in range(r.randrange(1, 9))]
    rows += [(c, None, "system", "first") for c in range(300, 340)] + [(c, t, "user", f"turn {t}") for c in range(300, 340) for t in range(40)]
    rows += [(700 + c, t, "user", f"long {t}") for c in (0, 7) for t in range(300)] + [(None, 0, "user", "nobody's")] * 3 + [(900, 0, "user", "same")] * 3
    return rows


SCHEMA12 = "conv_id long, turn long, role string, text string"


def test_trie(spark, monkeypatch):
    rows = talks()
    df = spark.createDataFrame(rows, SCHEMA12)
    clash = df.selectExpr("*", "'n' AS node", "'p' AS part", "'b' AS base", "1 AS size", "'w' AS what", "0 AS depth", "0 AS up", "0 AS ends")
    assert told(prefix_trie.prefix_trie(clash.repartition(5)), NAMES12) == trie(rows)
    assert told(prefix_trie.prefix_trie(df.repartition(5), fan=2), NAMES12) == trie(rows)
    assert prefix_trie.prefix_trie(df.limit(0)).count() == 0
    alone = prefix_trie.prefix_trie(df.where("conv_id is null"))
    assert alone.count() == 0


def test_partial_tries_are_passed_on():
    """A task's trie that is emptied again and again sums up to the same."""
    r = random.Random(2)
    paths = {c: [bytes([r.randrange(2)]) * 16 for _ in range(r.randrange(6))] for c in range(200)}

    def summed(every):
        made, nodes, ends = prefix_trie.PartialTrie(0), Counter(), {}
        for c, path in paths.items():
            made.begin(c)
            for what in path:
                made.add(what, 1, c)
            made.end(c)
            if c % every == 0 or c == 199:
                for x in made.passed_on().to_pylist():
                    if x["depth"] is None:
                        ends.setdefault(x["node"], []).append((x["first"], x["ends"]))
                    else:
                        nodes[(x["node"], x["depth"], tuple(x["up"]))] += x["n_convs"]
        return nodes, {k: ",".join(e for _, e in sorted(v)) for k, v in ends.items()}

    assert summed(1) == summed(7) == summed(10**9)
    assert all(len(up) == depth.bit_length() for _, depth, up in summed(3)[0])


# --- 13 main text of pages ---


def article(html):
    inner = re.sub(r"<br>|</?(p|h1)>", " ", re.search(r"<article>(.*?)</article>", html, re.S).group(1))
    return " ".join(unescape(re.sub(r"<[^>]*>", "", inner)).split())


def test_pages_query(spark):
    want = brute.multiset((i, u, article(h), len(article(h))) for i, u, h in duckdb.sql(f"SELECT page_id, url, html FROM '{SF}/pages.parquet'").fetchall())
    assert told(queries.op13_html_extraction(spark, SF), ("page_id", "url", "text", "n_chars")) == want


def test_held_out_pages():
    """Made pages that weren't trained on: blocks told rightly."""
    weights, move = html_extraction.train(600)
    wrong = blocks = 0
    for seed in range(20_000, 20_300):
        page = Page(seed)
        names = [n for _, n in blocks_of("".join(page.html))]
        labels = html_extraction.viterbi([sum(weights.get(x, 0.0) for x in n) for n in names], move)
        wrong += sum(a != b for a, b in zip(labels, page.labels))
        blocks += len(labels)
    assert blocks > 4000 and wrong < 0.01 * blocks


WRITTEN = """<html><head><title>A title</title></head><body><header><a href=/>Site name</a></header><div id=menu><a href=1>One</a> <a href=2>Two</a></div>
<div role="main"><h1>A title</h1><p>First &amp; foremost,
  a   text&nbsp;with &lt;marks&gt;.<p>Second text.<ul><li>An item<li>Another item</ul><div class="social-share"><a href=x>Share this</a></div>
<blockquote>Quoted words.</blockquote></div><aside><h3>Related</h3><p>Some other story told here.</p></aside>
<form><label>Your name</label><input><button>Send</button></form><section id="comments"><h3>2 comments</h3><div class="comment"><p>I don't agree with this at all.</p></div></section>
<div class="cookie-notice">We use cookies.</div><footer>&copy; 2020 Site name</footer></body></html>"""


def test_written_pages(spark):
    rows = [(1, "u", WRITTEN), (2, None, None), (3, "u", ""), (None, "u", "<p>Only this."), (None, "u", "<p>Only this."), (4, "u", "no markup at all"), (5, "u", "<nav><a href=x>menu</a></nav>"),
            (6, "u", "<article><p>" + "word " * 50_000 + "</article>"), (7, "u", "<" * 1000 + "<a b='<p>" + "<div>" * 5000), (8, "u", "<article>a<script>'</p>'</script> b<!-- c --><style>d</style> e</article>"), (9, "u", "<article><p>a &am<b>p; b</b> &lt;i&gt; &#233;&eacute;&copy c &nosuch; &#x1F600;")]
    df = spark.createDataFrame(rows, "page_id long, url string, html string").selectExpr("*", "'x' AS text", "1 AS n_chars")
    out = [(r.page_id, r.url, r.text, r.n_chars) for r in html_extraction.extract(df.repartition(2)).collect()]
    assert all(n == len(t) for _, _, t, n in out) and len(out) == len(rows)
    by = {i: t for i, _, t, _ in out if i is not None}
    assert by[1] == "A title First & foremost, a text with <marks>. Second text. An item Another item Quoted words."
    assert (by[2], by[3], by[4], by[5], by[8]) == ("", "", "no markup at all", "", "a b e") and by[6] == ("word " * 50_000).strip()
    assert by[9] == "a &amp; b <i> éé© c &nosuch; 😀"
    assert [t for i, _, t, _ in out if i is None] == ["Only this."] * 2


def test_viterbi_and_likelihood():
    """Against all sequences of labels of short pages."""
    import itertools

    import numpy as np

    r = random.Random(1)
    for _ in range(50):
        s = [r.uniform(-3, 3) for _ in range(r.randrange(1, 6))]
        move = [[r.uniform(-1, 1) for _ in range(2)] for _ in range(2)]
        value = lambda y: sum(v for v, l in zip(s, y) if l) + sum(move[a][b] for a, b in zip(y, y[1:]))  # noqa: B023, E731, E741
        every = list(itertools.product((0, 1), repeat=len(s)))
        assert value(html_extraction.viterbi(s, move)) == pytest.approx(max(map(value, every)))
        total = sum(np.exp(value(y)) for y in every)
        norm, p, pair = html_extraction.expected(np.array([s + [0.0]]), np.array(move), np.array([[True] * len(s) + [False]]))
        assert norm == pytest.approx(np.log(total))
        assert p[0, : len(s)] == pytest.approx(np.array([sum(np.exp(value(y)) for y in every if y[k]) / total for k in range(len(s))]))
        assert pair.sum() == pytest.approx(len(s) - 1)


# --- SQL of word rules ---


@pytest.mark.parametrize("name", ["op3_ngram_jaccard_join", "op6_substring_dedup"])
def test_sql_of_all_blanks(spark, tmp_path, name):
    """Every one of the six blanks ends a word, in the SQL as in the operator."""
    r = random.Random(3)
    words = [f"w{r.randrange(40)}" for _ in range(60)]
    joined = lambda blanks: "".join(w + r.choice(blanks) for w in words)
    rows = [(k, joined(b)) for k, b in enumerate([" ", "\t", "\n", "\x0b", "\x0c", "\r", " \t\n\x0b\x0c\r", "\xa0"])]
    spark.createDataFrame(rows, "doc_id long, text string").write.parquet(f"{tmp_path}/documents.parquet")
    con = duckdb.connect()
    con.execute(f"CREATE VIEW documents AS SELECT * FROM '{tmp_path}/documents.parquet/*.parquet'")
    assert spark_rows(queries.QUERIES[name](spark, str(tmp_path))) == sql_rows(con, queries.ORACLES[name])
