"""Labelled example pages: layouts drawn at random, each leaf block marked main text or not.

The main-text extractor is trained on these. They vary the containers of an article, its
blocks, and what surrounds or interrupts it: menus, headers, footers, sidebars, notices,
adverts, forms and reader comments. Words are random, so no label can be learned from them.
"""

from __future__ import annotations

import random

SYLLABLES = "an ba co de el fi ga ho in ja ke lo mi nu or pa qui re sa to un va wei xo ya ze".split()
ARTICLE = ("content", "post", "entry", "article-body", "story", "main-text", "post-content", "entry-content", "body-copy", "page-content")
ADVERT = ("ad", "ads", "advert", "advertisement", "sponsored", "promo", "banner", "ad-slot", "promotion")
SIDE = ("sidebar", "side", "widget", "related", "recommended", "trending", "popular", "more-stories", "rail")
NOTICE = ("cookie", "cookie-notice", "notice", "alert", "consent", "gdpr", "announcement", "paywall", "subscribe", "newsletter")
COMMENTS = ("comments", "comment-list", "comment", "discussion", "replies", "responses", "disqus")
MENU = ("nav", "menu", "navbar", "breadcrumb", "breadcrumbs", "pagination", "tabs", "toc")
FOOT = ("footer", "foot", "copyright", "legal", "site-footer", "share", "social", "tags", "byline-links")
HEAD = ("header", "masthead", "topbar", "site-header", "logo")


class Page:
    """Collects markup and, for every leaf block in page order, whether it is main text."""

    def __init__(self, seed: int):
        self.draw = random.Random(seed)
        self.html: list[str] = []
        self.labels: list[int] = []
        self.shout = self.draw.random() < 0.15

    def words(self, low: int, high: int) -> str:
        d = self.draw
        out = ["".join(d.choices(SYLLABLES, k=d.randint(1, 4))) for _ in range(d.randint(low, high))]
        for i in range(len(out)):
            if d.random() < 0.12:
                out[i] += d.choice([",", ".", ".", "!", "?", ";", "&amp;", "&#8212;"])
        text = " ".join(out).capitalize() + d.choice(["", ".", ".", "."])
        return text.upper() if self.shout else text

    def block(self, tag: str, text: str, label: int, attributes: str = "") -> None:
        close = "" if tag in ("p", "li") and self.draw.random() < 0.15 else f"</{tag}>"
        self.html.append(f"<{tag}{attributes}>{text}{close}")
        self.labels.append(label)

    def named(self, names: tuple[str, ...]) -> str:
        return f' {self.draw.choice(["class", "class", "id"])}="{self.draw.choice(names)}"'

    def link(self, low: int = 1, high: int = 4) -> str:
        return f'<a href="/{self.draw.randint(1, 999)}">{self.words(low, high)}</a>'

    def menu(self) -> None:
        tag = self.draw.choice(["nav", "nav", "ul", "div"])
        self.html.append(f"<{tag}{'' if tag == 'nav' and self.draw.random() < 0.6 else self.named(MENU)}>")
        items = self.draw.randint(2, 8)
        if tag == "ul" or self.draw.random() < 0.6:
            self.html.append("<ul>" * (tag != "ul"))
            for _ in range(items):
                self.block("li", self.link(), 0)
            self.html.append("</ul>" * (tag != "ul"))
        else:
            self.html.append(" ".join(self.link() for _ in range(items)))
            self.labels.append(0)
        self.html.append(f"</{tag}>")

    def box(self, names: tuple[str, ...], tags: tuple[str, ...], plain: float = 0.0) -> None:
        """A container of text that is not main: paragraphs, headings, links or bare text."""
        d = self.draw
        tag = d.choice(tags)
        self.html.append(f"<{tag}{'' if d.random() < plain else self.named(names)}>")
        if d.random() < 0.4:
            self.html.append(self.words(2, 30) if d.random() < 0.7 else "&copy; " + self.words(1, 6))
            self.labels.append(0)
        else:
            for _ in range(d.randint(1, 3)):
                kind = d.choice(["p", "p", "h3", "li", "div"])
                self.block(kind, self.link() if d.random() < 0.3 else self.words(2, 40), 0)
        self.html.append(f"</{tag}>")

    def form(self) -> None:
        self.html.append("<form>")
        self.block("label", self.words(1, 4), 0)
        self.block("p", self.words(2, 14), 0)
        self.block("button", self.words(1, 2), 0)
        self.html.append("</form>")

    def comments(self) -> None:
        tag = self.draw.choice(["div", "section", "ol", "ul"])
        self.html.append(f"<{tag}{self.named(COMMENTS)}>")
        if self.draw.random() < 0.5 and tag in ("div", "section"):
            self.block("h3", self.words(1, 3), 0)
        for _ in range(self.draw.randint(1, 5)):
            if tag in ("ol", "ul"):
                self.block("li", self.words(4, 60), 0)
            else:
                wrap = self.draw.choice(["div", "article", "li"])
                self.html.append(f"<{wrap}{self.named(('comment', 'reply', 'comment-body'))}>")
                self.block("p", self.words(4, 60), 0)
                self.html.append(f"</{wrap}>")
        self.html.append(f"</{tag}>")

    def aside_of_article(self) -> None:
        d = self.draw
        d.choice(
            [
                lambda: self.box(ADVERT, ("div", "aside", "section")),
                lambda: self.box(SIDE, ("aside", "div"), 0.2),
                lambda: self.box(NOTICE, ("div", "section")),
                self.form,
                lambda: self.box(FOOT, ("footer", "div"), 0.3),
                self.comments,
                self.menu,
            ]
        )()

    def article(self) -> None:
        d = self.draw
        tag = d.choice(["article", "article", "article", "main", "div", "section"])
        bare = d.random() < 0.1  # some pages have no container for the article
        name = "" if tag in ("article", "main") and d.random() < 0.6 else self.named(ARTICLE)
        self.html.append("" if bare else f"<{tag}{name}>")
        inner = d.random() < 0.3
        if d.random() < 0.8:
            headed = not bare and d.random() < 0.2
            self.html.append("<header>" * headed)
            self.block("h1", self.words(1, 10), 1)
            self.html.append("</header>" * headed)
        self.html.append(f"<div{self.named(ARTICLE)}>" * inner)
        for _ in range(d.randint(1, 12)):
            kind = d.choices(["p", "h2", "ul", "blockquote", "pre", "bold", "table", "bare"], [60, 8, 6, 5, 3, 10, 3, 5])[0]
            if kind == "ul":
                self.html.append("<ul>")
                for _ in range(d.randint(1, 4)):
                    self.block("li", self.words(1, 15), 1)
                self.html.append("</ul>")
            elif kind == "table":
                self.html.append("<table><tr>")
                for _ in range(d.randint(1, 4)):
                    self.block("td", self.words(1, 5), 1)
                self.html.append("</tr></table>")
            elif kind == "bold":
                self.html.append(f"<p><b>{self.words(3, 60)}<br>")
                self.labels.append(1)
            elif kind == "bare":
                self.html.append(f"<div>{self.words(3, 60)}</div>")
                self.labels.append(1)
            else:
                text = self.words(1, 90) if kind != "h2" else self.words(1, 6)
                self.block(kind, text + (f" {self.link()} {self.words(1, 9)}" if d.random() < 0.15 else ""), 1)
            if d.random() < 0.3:
                self.aside_of_article()
        self.html.append("</div>" * inner)
        if d.random() < 0.2:
            self.aside_of_article()
        self.html.append("" if bare else f"</{tag}>")

    def build(self) -> tuple[str, list[int]]:
        d = self.draw
        self.html.append("<!DOCTYPE html><html><head><meta charset=utf-8>")
        self.block("title", self.words(2, 8), 0)
        self.html.append("<style>p{margin:0}</style><script>var t='</p>';</script></head><body>")
        outside = [
            self.menu,
            lambda: self.box(ADVERT, ("div", "aside")),
            lambda: self.box(HEAD, ("header", "header", "div"), 0.4),
            lambda: self.box(NOTICE, ("div", "section", "aside")),
            self.form,
            lambda: self.box(SIDE, ("aside", "aside", "div", "section"), 0.3),
        ]
        wrap = d.random() < 0.3
        self.html.append(f'<div class="{d.choice(["wrap", "container", "page", "layout"])}">' * wrap)
        for _ in range(d.randint(0, 4)):
            d.choice(outside)()
        self.article()
        if d.random() < 0.35:
            self.comments()
        for _ in range(d.randint(0, 3)):
            d.choice(outside)()
        self.html.append("</div>" * wrap)
        if d.random() < 0.8:
            self.box(FOOT, ("footer", "footer", "div"), 0.6)
        self.html.append("</body></html>")
        return "".join(self.html), self.labels


def labelled_pages(count: int, seed: int = 0) -> list[tuple[str, list[int]]]:
    return [Page(seed * 1_000_003 + i).build() for i in range(count)]
