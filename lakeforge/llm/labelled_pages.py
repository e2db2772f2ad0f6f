"""Labelled pages to train on: layouts in use on the web, put together at random, with blocks known to be text or not.

Every part is a few ways to write it: by element, by class or id, or by neither. Sentences are of made-up words, so that
nothing is learnt from a language but the few phrases that notices share.
"""
from __future__ import annotations

import random

SYLLABLES = "an ber che da el fo ga hin ion ka la men no or pa que ra sen ti ung va wis ye zo ñe çu öl ée".split()
PHRASES = {
    "notice": ["We use cookies to improve this site.", "By continuing you accept our privacy policy.", "This site uses cookies. Accept all", "Subscribe to our newsletter", "Please log in to continue reading."],
    "foot": ["© 2021 {w} {w}. All rights reserved.", "Copyright {w}", "Terms of use · Privacy policy", "© {w}.example.org · {s}", "{s}"],
    "advert": ["Advertisement", "Sponsored: {s}", "{s}", "{s} {s}", "{s}\n{s}"],
    "comment": ["{s}", "{s} {s}", "{w} says:", "Reply", "{n} comments", "{s} {s} {s}"],
    "form": ["Your name", "Search", "Send", "Email address", "{w}", "Choose {w}"],
}


class Page:
    """html, and for each block whether it is text of the article, in order of the page."""

    def __init__(self, seed: int):
        self.of = random.Random(seed)
        self.html: list[str] = []
        self.labels: list[int] = []
        self.make()

    def word(self) -> str:
        return "".join(self.of.choice(SYLLABLES) for _ in range(self.of.choice((1, 1, 2, 2, 3))))

    def sentence(self) -> str:
        words = [self.word() for _ in range(self.of.choice((1, 2, 4, 7, 10, 14, 20)))]
        if len(words) > 8 and self.of.random() < 0.5:
            words[4] += ","
        return " ".join(words).capitalize() + self.of.choice(("...?!" if self.of.random() < 0.1 else ".", "."))

    def saying(self, kind: str) -> str:
        return self.of.choice(PHRASES[kind]).format(w=self.word(), s=self.sentence(), n=self.of.randrange(90))

    def block(self, tag: str, text: str, label: int, attributes: str = "") -> None:
        self.html.append(f"<{tag}{attributes}>{text}" + (f"</{tag}>" if tag != "p" or self.of.random() < 0.9 else ""))
        self.labels.append(label)

    def inside(self, kinds: list[str]) -> str:
        """Opens one of these and returns what closes it."""
        kind = self.of.choice(kinds)
        tag, _, name = kind.partition(".")
        self.html.append(f"<{tag}" + (f' {self.of.choice(("class", "id"))}="{name}"' if name else "") + ">")
        return f"</{tag}>"

    def links(self, kinds: list[str], least: int = 2) -> None:
        close, listed = self.inside(kinds), self.of.random() < 0.7
        self.html.append("<ul>" if listed else "")
        for _ in range(self.of.randrange(least, 9)):
            self.block("li" if listed else "div", f'<a href="/{self.word()}">{self.of.choice((self.word(), self.word() + " " + self.word(), self.sentence()))}</a>', 0)
        self.html.append(("</ul>" if listed else "") + close)

    def said(self, kind: str, kinds: list[str], tags: tuple[str, ...] = ("p", "div", "span")) -> None:
        close, tag = self.inside(kinds), self.of.choice(tags)
        for _ in range(self.of.choice((1, 1, 2))):
            self.block("p" if tag == "span" else tag, self.saying(kind), 0)
        self.html.append(close)

    def bare(self, kind: str, kinds: list[str]) -> None:
        """The text stands in the element itself."""
        tag, _, name = self.of.choice(kinds).partition(".")
        self.block(tag if tag != "p" else "div", self.saying(kind), 0, f' class="{name}"' if name else "")

    def advert(self) -> None:
        (self.bare if self.of.random() < 0.6 else self.said)("advert", ["div.ad", "div.ads", "aside.advert", "div.advertisement", "section.sponsored", "div.promo", "div.ad-slot", "div.banner"])

    def notice(self) -> None:
        (self.bare if self.of.random() < 0.5 else self.said)("notice", ["div.cookie-banner", "div.notice", "div.alert", "dialog", "section.consent", "div.popup", "div.newsletter", "aside.notice"])

    def form(self) -> None:
        self.html.append("<form>" if self.of.random() < 0.8 else '<div class="login-form">')
        close = "</form>" if self.html[-1] == "<form>" else "</div>"
        for _ in range(self.of.randrange(1, 4)):
            self.block(self.of.choice(("div", "p", "button", "legend", "option")), self.saying("form"), 0)
        self.html.append(close)

    def comments(self) -> None:
        close = self.inside(["section.comments", "div.comments", "div.comment-list", "ol.commentlist", "div.discussion", "section.responses"])
        for _ in range(self.of.randrange(1, 6)):
            inner = self.inside(["div.comment", "article.comment", "li", "div", "div.reply"])
            for _ in range(self.of.choice((1, 1, 2, 3))):
                self.block(self.of.choice(("p", "p", "div", "h3")), self.saying("comment"), 0)
            self.html.append(inner)
        self.html.append(close)

    def header(self) -> None:
        close = self.inside(["header", "div.header", "div.masthead", "header.site-header", "div.topbar"])
        self.block(self.of.choice(("div", "p", "h1", "h2")), self.of.choice((self.word(), self.sentence())), 0)
        if self.of.random() < 0.5:
            self.links(["nav", "div.menu", "div"])
        self.html.append(close)

    def side(self) -> None:
        close = self.inside(["aside", "div.sidebar", "aside.sidebar", "div.related", "section.widget", "div.rail", "section.recommended"])
        if self.of.random() < 0.6:
            self.block(self.of.choice(("h2", "h3", "div")), self.word(), 0)
        for _ in range(self.of.randrange(1, 4)):
            self.block("p", self.sentence(), 0)
        if self.of.random() < 0.5:
            self.links(["div", "section"])
        self.html.append(close)

    def footer(self) -> None:
        kinds = ["footer", "footer", "div.footer", "div.copyright", "footer.site-footer"]
        (self.bare if self.of.random() < 0.5 else self.said)("foot", kinds)

    def article(self, title: str) -> None:
        kinds = ["article", "article", "article", "main", "div.content", "div.entry-content", "div.article-body", "section.post", "div.story", "td"]
        plain = self.of.random() < 0.12
        close = "" if plain else self.inside(kinds)
        if self.of.random() < 0.8:
            wrapped = self.of.random() < 0.15 and not plain
            self.html.append("<header>" if wrapped and "article" in close else "")
            self.block("h1", title, 1)
            self.html.append("</header>" if wrapped and "article" in close else "")
        extras = [] if plain else [self.advert, self.form, self.notice, lambda: self.links(["div.share", "ul.social", "div.related", "aside", "nav.toc"]), self.side]
        for _ in range(self.of.choice((0, 1, 2, 3, 4, 6, 9, 14))):
            kind = self.of.random()
            text = " ".join(self.sentence() for _ in range(self.of.choice((1, 1, 2, 3, 5, 9))))
            if kind < 0.7:
                if self.of.random() < 0.3:
                    text = f"<b>{text}<br>"
                elif self.of.random() < 0.15:
                    text += f' <a href="/{self.word()}">{self.word()}</a> {self.sentence()}'
                self.block("p", text, 1)
            elif kind < 0.78:
                self.block(self.of.choice(("h2", "h3", "h4")), self.of.choice((self.word(), self.sentence())), 1)
            elif kind < 0.86:
                tag, item = self.of.choice((("ul", "li"), ("ol", "li"), ("dl", "dd"), ("table", "td")))
                self.html.append(f"<{tag}>" + ("<tr>" if tag == "table" else ""))
                for _ in range(self.of.randrange(1, 6)):
                    self.block(item, self.of.choice((self.word(), self.sentence(), text)), 1)
                self.html.append(("</tr>" if tag == "table" else "") + f"</{tag}>")
            elif kind < 0.92:
                self.block(self.of.choice(("blockquote", "pre", "div", "section")), text, 1)
            elif kind < 0.95:
                self.html.append("<figure><img src='x'>")
                self.block("figcaption", self.sentence(), 1)
                self.html.append("</figure>")
            elif extras:
                self.of.choice(extras)()
        if extras and self.of.random() < 0.1:
            self.comments()
        self.html.append(close)

    def make(self) -> None:
        title = self.of.choice((self.sentence(), self.word(), self.sentence().rstrip(".")))
        whole = self.of.random() < 0.9
        self.html.append(f"<!DOCTYPE html><html><head><title>{title}</title><style>p{{}}</style><script>var t='<p>';</script></head><body>" if whole else "")
        parts = [(0.5, self.header), (0.7, lambda: self.links(["nav", "nav", "div.menu", "div.navigation", "ul.nav"])), (0.4, self.advert), (0.3, self.notice), (0.15, self.form), (0.15, self.side)]
        for chance, part in parts:
            if whole and self.of.random() < chance:
                part()
        self.article(title)
        for chance, part in [(0.35, self.comments), (0.35, self.side), (0.25, self.advert), (0.2, self.form), (0.2, self.notice), (0.75, self.footer)]:
            if whole and self.of.random() < chance:
                part()
        self.html.append("</body></html>" if whole and self.of.random() < 0.9 else "")
