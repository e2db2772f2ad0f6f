"""Plain versions of the operators, over lists of (doc_id, text)."""
import hashlib
import re
import zlib
from collections import Counter, defaultdict

import regex
import xxhash

WORD = re.compile(r"[^\x20\x09-\x0D]+")
LOWER = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")
BLANK = " \t\n\x0b\x0c\r"
sha = lambda s: hashlib.sha256(s.encode()).hexdigest()


def learns(doc_id):
    return zlib.crc32(str(doc_id).encode()) % 4 != 2


def lines(docs, least=40, most=5):
    holders = defaultdict(set)
    key = lambda x: x.strip(BLANK).translate(LOWER)
    for i, t in docs:
        for x in (t or "").split("\n"):
            if i is not None and len(key(x)) >= least:
                holders[key(x)].add(i)
    out = []
    for i, t in docs:
        rows = (t or "").split("\n")
        keep = [x for x in rows if i is None or len(holders.get(key(x), ())) < most or max(holders[key(x)]) == i]
        out.append((i, len(rows), len(rows) - len(keep), sha("\n".join(keep))))
    return out


def shingles(t, n=5):
    w = WORD.findall((t or "").translate(LOWER))
    return frozenset(tuple(w[k : k + n]) for k in range(len(w) - n + 1)) if len(w) >= n else frozenset([tuple(w)] if w else [])


def jaccard(docs, percent=80):
    sets = [shingles(t) for _, t in docs]
    up, links = list(range(len(docs))), [0] * len(docs)

    def find(x):
        while up[x] != x:
            x = up[x]
        return x

    for a in range(len(docs)):
        for b in range(a):
            both = len(sets[a] & sets[b])
            if sets[a] and sets[b] and docs[a][0] is not None and docs[b][0] is not None and 100 * both >= percent * len(sets[a] | sets[b]):
                up[find(a)] = find(b)
                links[a] += 1
                links[b] += 1
    least = {}
    for a, (i, _) in enumerate(docs):
        if i is not None:
            least[find(a)] = min(least.get(find(a), i), i)
    return [(i, len(s), None if i is None else least[find(a)], links[a]) for a, ((i, _), s) in enumerate(zip(docs, sets))]


def secrets(t):
    t = t or ""
    assign = re.compile(r"""(password|passwd|secret|token|api_?key)["']?\x20*[:=]\x20*["']?([A-Za-z0-9+/_.=-]+)""", re.I | re.A)
    found = [(m.start(), 0, m.end(), "assign") for m in assign.finditer(t) if len(m[2]) >= 8]
    found += [(m.start(), 1, m.end(), "access") for m in re.finditer("AKIA[A-Z0-9]+", t) if len(m[0]) >= 16]
    found += [(m.start(), 2, m.end(), "hex") for m in re.finditer("[0-9a-f]+", t) if len(m[0]) >= 32]
    return sorted(found)


def repeats(docs, width=13):
    first = {}
    for i, t in docs:
        w = WORD.findall(t or "")
        for k in range(len(w) - width + 1):
            x = tuple(w[k : k + width])
            if i is not None:
                first[x] = min(first.get(x, i), i)
    out = []
    for i, t in docs:
        w = WORD.findall(t or "")
        gone = [False] * len(w)
        for k in range(len(w) - width + 1):
            if i is not None and first[tuple(w[k : k + width])] < i:
                gone[k : k + width] = [True] * width
        out.append((i, len(w), sum(gone), sha(" ".join(x for x, g in zip(w, gone) if not g))))
    return out


ALONE = "\u4e00-\u9fff\u3040-\u30ff\u0e00-\u0e7f"  # of the scripts written without blanks, those that tests use


def pieces(t):
    """Words; letters that stand alone and all characters of longer runs are words each."""
    out = []
    for w in re.findall(f"[{ALONE}]|[^\\x20\\x09-\\x0D{ALONE}]+", t):
        out += list(w) if len(w) > 32 else [w]
    return out


def winnow(t, k=5, window=8):
    w = [xxhash.xxh64_intdigest(x.encode(), seed=42) for x in pieces(t)]
    if not w:
        return []

    def run(words):
        h = 0
        for x in words:
            h = (h << 1 | h >> 63) & (1 << 64) - 1
            h ^= x
        return h

    g = [run(w[i : i + k]) for i in range(max(len(w) - k + 1, 1))]
    out = []
    for j in range(max(len(g) - window + 1, 1)):
        part = [x >> 31 for x in g[j : j + window]]
        i = j + max(q for q, v in enumerate(part) if v == min(part))
        if not out or out[-1][1] != i:  # places only grow
            out.append((g[i], i))
    return out


def fingerprints(docs):
    """docs with doc_ids, none null; equal ids by falling text."""
    rows = sorted(((i, t or "") for i, t in docs), reverse=True)
    like = lambda a, b: 1.0 if not a | b else len(a & b) / len(a | b)
    text = lambda f: ",".join(f"{h:x}:{i}" for h, i in f)
    out = []
    for q, (i, t) in enumerate(rows):
        after = rows[(q + 1) % len(rows)][1]
        m = len(t) // 3
        edited = t[: len(t) - m] + after[:m]
        a, b, c = winnow(t), winnow(edited), winnow(after)
        sets = [{h for h, _ in x} for x in (a, b, c)]
        out.append((i, len(t), sha(edited), text(a), text(b), round(like(sets[0], sets[1]), 9), round(like(sets[0], sets[2]), 9)))
    return out


BLANKS = r"[\x20\x09-\x0D]"
END = rf"""(?=[.,;:!?)"']*(?:{BLANKS}|$))"""


def template(t, units, counts):
    """Template words and, where one stands for a value, the value (else "")."""
    t = regex.sub(rf"[0-9](?=(?i:{units}){END})", lambda m: m[0] + " ", t)
    own, at, spelt = WORD.findall(t), 0, []
    name = regex.compile(r"\p{Lu}[\p{L}'-]+")
    while at < len(own):  # names of several words, a single blank between them
        last = at
        while last + 1 < len(own) and name.fullmatch(own[last]) and len(own[last]) <= 31 and name.match(own[last + 1]) and f"{own[last]} {own[last + 1]}" in t:
            last += 1
        spelt.append("\x01".join(own[at : last + 1]))
        at = last + 1
    out, before = [], ""
    tail = r"""[.,;:!?)"']*"""
    for k, w in enumerate(spelt):
        kind = ""
        counted = k > 0 and regex.search(r"[0-9]$", spelt[k - 1]) and f"{spelt[k - 1]} {w}" in t and regex.fullmatch(f"(?:{units.upper()})" + tail, w)
        if not counted and regex.fullmatch(r"\p{Lu}[\p{L}\x01'-]*" + tail, w):
            kind = "<name>"
        elif regex.fullmatch(r"[-+$€£]?[0-9]+(?:[.,:/][0-9]+)*%?" + tail, w.lower()):
            kind = "<num>"
        if kind:
            m = regex.search(tail + "$", w)
            rest = m[0] if kind != "<name>" or not m[0].startswith("'") else m[0].lstrip("'")
            t_word = regex.sub(r"[.,;:!?]+$", "", kind + rest)
        else:
            t_word = regex.sub(r"(?<=[\p{L}\p{N}>])[.,;:!?]+$", "", w.lower())
            t_word = "<num>" if regex.fullmatch(counts, t_word) else "<unit>" if before == "<num>" and regex.fullmatch(units, t_word) else t_word
        out.append((t_word, regex.sub(r"[.,;:!?]+$", "", w) if t_word in ("<name>", "<num>", "<unit>") else ""))
        before = t_word
    return out


def held_items(docs, items, units, counts, width=8, literal=4, coverage=0.5):
    """{(doc_id, item_id): (n_windows, share, reworded)}, by plain loops over all pairs."""
    def windows(t, size):
        for at in range(len(t) - size + 1):
            part = t[at : at + size]
            values = tuple(v for _, v in part)
            low = any(v for _, v in t) and sum(v != "" for v in values) > size - min(literal, size)
            yield at, (tuple(w for w, _ in part), values if low else None), values

    out = {}
    titled = regex.compile(rf"(?:^|{BLANKS})(?:\p{{Lu}}[^\x20\x09-\x0D]*{BLANKS}+){{2}}\p{{Lu}}")
    of = [(k, n, bool(titled.search(t)), template(x, units, counts)) for k, t in items if k is not None and t and WORD.search(t) for n, x in enumerate((t, t.lower()))]
    readings = [(i, n, x) for i, text in docs if i is not None and text for n, x in enumerate([text, text.lower()] if titled.search(text) else [text])]
    for i, reading, text in readings:
        mine = template(text, units, counts)
        by_size = {}
        for k, item_reading, caps, t in of:
            if reading != item_reading and not caps:
                continue
            size = min(len(t), width)
            if size not in by_size:
                by_size[size] = defaultdict(list)
                for at, key, values in windows(mine, size):
                    by_size[size][key].append((at, values))
            own = list(windows(t, size))
            total, ways = len(own), defaultdict(set)
            for item_at, key, values in own:
                for at, theirs in by_size[size].get(key, ()):
                    hit = (item_at, -at, tuple((a, b) for a, b in zip(values, theirs) if a))
                    near = (at - item_at) // (total + size)
                    for way in ((True, at - item_at), (False, near), (False, near - 1)):
                        ways[way].add(hit)
            for hits in ways.values():
                if len({h[0] for h in hits}) < total * coverage:
                    continue
                stands = defaultdict(set)
                for h in hits:
                    for a, b in h[2]:
                        stands[a].add(b)
                good = sorted(h for h in hits if all(len(stands[a]) == 1 for a, _ in h[2]))
                best = [0] * len(good)
                for x in range(len(good)):
                    best[x] = 1 + max((best[y] for y in range(x) if good[y][0] < good[x][0] and good[y][1] > good[x][1]), default=0)
                n = max(best, default=0)
                if n >= total * coverage and n:
                    reworded = any(a != b for h in good for a, b in h[2])
                    was = out.get((i, k), (0, 0, True))
                    out[i, k] = (max(n, was[0]), max(n / total, was[1]), was[2] and reworded)
    return out


def multiset(rows):
    return Counter(map(repr, rows))
