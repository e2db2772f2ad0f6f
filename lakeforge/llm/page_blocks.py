"""Leaf blocks of a page and what can be seen of each: its own tag, its ancestors and its text."""
from __future__ import annotations

import re
from html import unescape

#: Fixed values of HTML: elements that start a new line; those whose content isn't text of the page; what closes what.
BLOCK = frozenset(
    """address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form
    h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol p pre search section summary table tbody td tfoot th thead
    tr ul button select option optgroup""".split()
)
SILENT = frozenset("script style noscript template textarea title iframe noembed noframes svg math object canvas audio video head".split())
RAW = frozenset("script style noscript textarea title iframe noembed noframes template".split())
VOID = frozenset("br hr img input meta link area base col embed source track wbr param".split())
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SECTIONS = frozenset("article main section nav header footer aside form figure ul ol dl table blockquote dialog details pre button select fieldset address menu".split())

#: What words in class, id and role attributes tell of an element.
MEANINGS = {
    "advert": "ad ads advert advertisement adverts sponsor sponsored promo promotion banner adsense doubleclick affiliate".split(),
    "menu": "nav navigation navbar menu breadcrumb breadcrumbs toc pagination pager tabs skip sitemap".split(),
    "head": "header masthead topbar logo branding tagline hero".split(),
    "foot": "footer copyright colophon legal credits imprint bottom".split(),
    "side": "sidebar aside complementary side rail widget widgets related recommended recommendations trending popular teaser teasers more".split(),
    "notice": "cookie cookies consent gdpr notice notices alert popup modal overlay disclaimer paywall banner toast privacy warning".split(),
    "sign": "subscribe subscription newsletter signup login register form search contact".split(),
    "share": "share sharing social follow tags tools print".split(),
    "comment": "comment comments commentlist reply replies respond disqus discussion responses".split(),
    "body": "article content main post entry story body text prose".split(),
}
MEANING = {w: m for m, ws in MEANINGS.items() for w in ws}
#: Words by which notices, adverts and the like are often known.
SAYING = re.compile(r"cookie|privacy policy|all rights reserved|copyright|©|subscribe|newsletter|sign up|log ?in|advertisement|sponsored|read more|share this|\breply\b|comments?\b|terms of|accept", re.I)
ATTRIBUTE = re.compile(r"(?:^|[\s\"'/])(class|id|role|hidden|aria-hidden)(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s\"'>]+))?", re.I)
NAME = re.compile(r"[a-zA-Z][^\s/>]*")
PIECES = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
LENGTHS = (1, 3, 6, 12, 25, 60)


def tag_end(html: str, at: int) -> int:
    """The place of the > that ends the tag; one inside a quoted value doesn't. Without one, the page's end."""
    end = html.find(">", at)
    if end < 0:
        return len(html)
    inside = html[at:end]
    if inside.count('"') % 2 == 0 and inside.count("'") % 2 == 0:
        return end
    while True:
        equals, end = html.find("=", at), html.find(">", at)
        if end < 0 or equals < 0 or end < equals:
            return len(html) if end < 0 else end
        at = equals + 1
        while at < len(html) and html[at].isspace():
            at += 1
        if html[at : at + 1] in ('"', "'"):
            close = html.find(html[at], at + 1)
            if close < 0:
                return end
            at = close + 1


def meanings(attributes: str) -> list[str]:
    out = []
    for name, value in ATTRIBUTE.findall(attributes):
        if name.lower() in ("hidden", "aria-hidden"):
            out += ["is=hidden"] if value.strip("\"'").lower() != "false" else []
        else:
            out += [f"is={MEANING[w]}" for w in (p.lower() for p in PIECES.findall(value)) if w in MEANING]
    return out


class Blocks:
    """Reads a page into blocks: (text, names of features). Every step is linear in the page's length."""

    def __init__(self, html: str):
        self.blocks: list[tuple[str, list[str]]] = []
        self.stack: list[tuple[str, frozenset[str], str]] = [("", frozenset(), "")]
        self.open: dict[str, int] = {}
        self.pieces: list[str] = []
        self.linked = 0
        self.link = False
        self.title = ""
        self.headed = False
        self.read(html)
        self.flush()

    def read(self, html: str) -> None:
        at, low = 0, None
        while at < len(html):
            start = html.find("<", at)
            if start < 0:
                self.text(html[at:])
                return
            if start > at:
                self.text(html[at:start])
            following = html[start + 1 : start + 2]
            if following.isascii() and following.isalpha():
                name = NAME.match(html, start + 1)
                tag, end = name.group().lower(), tag_end(html, name.end())
                self.start(tag, html[name.end() : end])
                at = end + 1
                if tag in RAW:
                    low = low if low is not None else html.lower() if len(html.lower()) == len(html) else html
                    close = low.find(f"</{tag}", at)
                    if close < 0:
                        return
                    if tag == "title" and not self.title:
                        self.title = " ".join(unescape(html[at:close]).split())
                    at = tag_end(html, close) + 1
            elif following == "/" and (name := NAME.match(html, start + 2)):
                self.finish(name.group().lower())
                at = tag_end(html, name.end()) + 1
            elif html.startswith("<!--", start):
                if html.startswith((">", "->"), start + 4):
                    at = html.find(">", start) + 1
                    continue
                end = html.find("-->", start + 4)
                if end < 0:
                    return
                at = end + 3
            elif following in ("!", "?", "/"):
                at = tag_end(html, len(html) if html.find(">", start) < 0 else html.find(">", start)) + 1
            else:
                self.text("<")
                at = start + 1

    def text(self, text: str) -> None:
        if self.stack[-1][0] not in SILENT:
            self.pieces.append(unescape(text) if "&" in text else text)  # no reference goes on behind a tag
            self.linked += len(text) if self.link else 0

    def push(self, tag: str, names: list[str]) -> None:
        _, seen, near = self.stack[-1]
        nearest = names[-1] if names else near
        if seen.issuperset(names):
            self.stack.append((tag, seen, nearest))
        else:
            self.stack.append((tag, seen.union(names), nearest))
        self.open[tag] = self.open.get(tag, 0) + 1

    def pop(self) -> None:
        self.open[self.stack.pop()[0]] -= 1

    def start(self, tag: str, attributes: str) -> None:
        if tag in SILENT:
            if tag not in RAW and not attributes.endswith("/"):
                self.flush()
                self.push(tag, [])
        elif tag in BLOCK:
            if self.stack[-1][0] == "head":
                self.pop()
            self.flush()
            if self.stack[-1][0] == "p":
                self.pop()
            while self.stack[-1][0] in CLOSES.get(tag, ()):
                self.pop()
            if tag not in VOID:
                self.push(tag, ([f"in={tag}"] if tag in SECTIONS else []) + (meanings(attributes) if attributes else []))
        elif tag == "br":
            self.text(" ")
        elif tag == "a":
            self.link = True

    def finish(self, tag: str) -> None:
        if tag == "a":
            self.link = False
        elif self.open.get(tag):
            self.flush()
            while self.stack[-1][0] != tag:
                self.pop()
            self.pop()
            self.link = False
        elif tag in BLOCK:
            self.flush()

    def flush(self) -> None:
        text = " ".join("".join(self.pieces).split()) if self.pieces else ""
        linked = self.linked
        self.pieces, self.linked = [], 0
        if not text:
            return
        tag, seen, near = self.stack[-1]
        words = text.count(" ") + 1
        names = ["always", f"tag={tag}", f"near={near}", *seen, f"words={sum(words >= x for x in LENGTHS)}"]
        share = linked / max(len(text), 1)
        names.append("links=all" if share > 0.8 else "links=many" if share > 0.3 else "links=few" if share else "links=none")
        if text[-1] in ".!?…。！？\"'”»":
            names.append("ends")
        if ", " in text or ". " in text:
            names.append("prose")
        if SAYING.search(text) if words < 60 else SAYING.search(text[:40]):
            names.append("says")
        if tag == "h1" or self.title and text == self.title:
            self.headed = True
            names.append("title")
        else:
            names.append("after" if self.headed else "before")
        if any(x.startswith(("in=", "is=")) for x in seen):
            names += ["within"] if "in=article" in seen or "in=main" in seen or "is=body" in seen else ["outside"]
        else:
            names.append("bare")
        self.blocks.append((text, names))


def blocks_of(html: str | None) -> list[tuple[str, list[str]]]:
    return Blocks(html or "").blocks
