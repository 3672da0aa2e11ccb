"""Made-up pages with known main blocks, from which the block labeller learns page layouts."""

from __future__ import annotations

import html

import numpy as np

# Words of page furniture, and names that sites give to it.
FURNITURE = "home about contact login sign up subscribe newsletter cookies accept privacy policy terms share tweet follow related posts popular tags archive search menu comments reply posted advertisement sponsored buy now copyright all rights reserved read more next previous skip".split()
NAMES = {
    "nav": ["nav", "navbar", "menu", "main-nav", "breadcrumb", "navigation", "topbar", "pagination"],
    "header": ["header", "masthead", "site-header", "banner", "top"],
    "footer": ["footer", "site-footer", "bottom", "copyright", "colophon"],
    "aside": ["sidebar", "side", "widget", "related", "popular", "rail", "recommend", "tags"],
    "ad": ["ad", "ads", "advert", "advertisement", "sponsored", "promo", "ad-slot", "banner-ad"],
    "notice": ["cookie", "cookie-notice", "consent", "notice", "popup", "modal", "newsletter", "alert", "gdpr"],
    "form": ["form", "search", "login", "signup", "subscribe", "search-form", "contact-form"],
    "comments": ["comments", "comment-list", "comment", "replies", "discussion", "respond", "disqus"],
    "share": ["share", "social", "share-buttons", "toolbar", "meta-links"],
}
CONTENT = ["content", "post", "entry", "article", "main", "story", "post-content", "entry-content", "article-body", "text", "page"]
_SYLLABLES = "an ber ca cion den der do el en er es et fra ge ha in ka la le ler lo ma men no on or pa que ra re ro sa schen ta te ti tion to un ve wa zu".split()

Made = tuple[str, list[bool]]  # html, and whether each leaf block is main text


def _words(rng: np.random.Generator, n: int) -> str:
    words = ["".join(rng.choice(_SYLLABLES, rng.integers(1, 4))) for _ in range(n)]
    if rng.random() < 0.05:
        words = words[:1] * n  # junk is text too
    for k in range(7, n, int(rng.integers(7, 16))):
        words[k] += str(rng.choice([".", ",", "!", "%%%", " &"]))
    return html.escape(" ".join(words).capitalize() + ("." if n > 6 else ""))


def _furniture(rng: np.random.Generator, n: int) -> str:
    """Words of furniture, or of the same kind as the main text: words alone must not give it away."""
    return html.escape(" ".join(rng.choice(FURNITURE, n)).capitalize()) if rng.random() < 0.5 else _words(rng, n)


class _Page:
    def __init__(self, rng: np.random.Generator):
        self.rng, self.out, self.labels = rng, [], []

    def leaf(self, tag: str, main: bool, n: int, attributes: str = "", close: bool = True) -> None:
        rng = self.rng
        text = _words(rng, n) if main else _furniture(rng, n)
        style = rng.random()
        if tag == "p" and style < 0.15:
            text = f"<b>{text}<br>" + _words(rng, 4) if main else f"<b>{text}"
        elif style < 0.25:
            text = f"<a href='/x'>{text}</a>"
        elif main and style < 0.4:
            text = f"{text} <em>{_words(rng, 2)}</em> {_words(rng, 5)}"
        self.out.append(f"<{tag}{attributes}>{text}" + f"</{tag}>" * close)
        self.labels.append(main)

    def named(self, kind: str) -> str:
        name = str(self.rng.choice(NAMES[kind]))
        return f' {self.rng.choice(["class", "id"])}="{name}"' if self.rng.random() < 0.8 else f' class="{name} x{self.rng.integers(9)}"'

    def furniture(self, kind: str) -> None:
        rng = self.rng
        semantic = {"nav": "nav", "header": "header", "footer": "footer", "aside": "aside", "form": "form", "comments": "section"}.get(kind, "div")
        plain = semantic != "div" and kind != "comments" and rng.random() < 0.5
        tag = semantic if plain or rng.random() < 0.4 else str(rng.choice(["div", "section"]))
        self.out.append(f"<{tag}{'' if plain else self.named(kind)}>")
        n = int(rng.integers(1, 6))
        if kind in ("nav", "aside", "share") and rng.random() < 0.7:
            self.out.append("<ul>")
            for _ in range(n + 1):
                self.out.append("<li>")
                self.out.append(f"<a href='/{rng.integers(99)}'>{_furniture(rng, int(rng.integers(1, 4)))}</a>")
                self.labels.append(False)
                self.out.append("</li>" if rng.random() < 0.8 else "")
            self.out.append("</ul>")
        elif kind == "form":
            self.out.append("<input name='q'>")
            for _ in range(int(rng.integers(1, 3))):
                self.leaf(str(rng.choice(["label", "button", "p"])), False, int(rng.integers(1, 5)))
        elif kind == "comments":
            self.leaf(str(rng.choice(["h2", "h3"])), False, 2)
            for _ in range(n):
                self.out.append("<div class='comment'>" if rng.random() < 0.6 else "<div>")
                self.leaf("p", False, int(rng.integers(3, 60)))
                self.out.append("</div>")
        elif rng.random() < 0.5:
            self.out.append(_furniture(rng, int(rng.integers(2, 25))))
            self.labels.append(False)
        else:
            for _ in range(int(rng.integers(1, 4))):
                self.leaf(str(rng.choice(["p", "span", "div"]) if kind != "header" else rng.choice(["p", "div", "h2"])), False, int(rng.integers(2, 25)))
                if self.out[-1].startswith("<span"):
                    self.out[-1] = self.out[-1].replace("<span", "<div", 1).replace("</span>", "</div>")
        self.out.append(f"</{tag}>")

    def article(self) -> None:
        rng = self.rng
        frame = str(rng.choice(["article", "article", "main", "div", "section", "main><article", "div class='wrap'><article"]))
        opening = f"<{frame}>" if not frame == "div" and rng.random() < 0.6 else f'<{frame.split(" ")[0].split(">")[0]} {rng.choice(["class", "id"])}="{rng.choice(CONTENT)}">'
        self.out.append(opening)
        if rng.random() < 0.85:
            self.leaf(str(rng.choice(["h1", "h1", "h2"])), True, int(rng.integers(1, 12)))
        for _ in range(int(rng.integers(1, 14))):
            what = rng.random()
            if what < 0.7:
                self.leaf("p", True, int(rng.choice([1, 3, 8, 20, 60, 120])), close=rng.random() < 0.85)
            elif what < 0.77:
                self.leaf(str(rng.choice(["h2", "h3"])), True, int(rng.integers(1, 8)))
            elif what < 0.84:
                kind = str(rng.choice(["ul", "ol"]))
                self.out.append(f"<{kind}>")
                for _ in range(int(rng.integers(2, 5))):
                    self.leaf("li", True, int(rng.integers(2, 20)), close=rng.random() < 0.7)
                self.out.append(f"</{kind}>")
            elif what < 0.88:
                self.leaf(str(rng.choice(["blockquote", "pre", "figcaption"])), True, int(rng.integers(5, 30)))
            elif what < 0.91:
                self.out.append("<table>")
                for _ in range(2):
                    self.out.append("<tr>")
                    for _ in range(2):
                        self.leaf("td", True, int(rng.integers(1, 6)))
                    self.out.append("</tr>")
                self.out.append("</table>")
            else:
                self.furniture(str(rng.choice(["ad", "share", "aside", "notice", "form"])))
        for tag in reversed([t.split(" ")[0] for t in opening.strip("<>").split("><")]):
            self.out.append(f"</{tag}>")


def make(rng: np.random.Generator) -> Made:
    page = _Page(rng)
    order = [k for k in ("notice", "header", "nav", "ad", "form") if rng.random() < 0.6]
    after = [k for k in ("share", "ad", "comments", "aside", "form", "notice", "footer") if rng.random() < 0.55]
    if rng.random() < 0.3:
        rng.shuffle(order)
    for kind in order:
        page.furniture(kind)
    page.article()
    for kind in after:
        page.furniture(kind)
    body = "".join(page.out)
    return f"<!DOCTYPE html><html><head><title>{_words(rng, 4)}</title><script>var a='<p>';</script></head><body>{body}</body></html>", page.labels
