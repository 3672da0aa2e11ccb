"""HTML as a sequence of leaf blocks: their texts, the path of tags above them, and what share of each is links."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

# HTML's elements by how they lay out text.
BLOCKS = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 head header "
    "hgroup hr html iframe label legend li main menu nav noframes noscript object ol optgroup option p pre section select summary table tbody td textarea tfoot th thead title tr ul video audio".split()
)
RAW = frozenset("script style template textarea title iframe select".split())  # their text is none of the page's
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE_BREAK = frozenset(("br", "wbr", "img", "input"))
CLOSES_P = BLOCKS - {"button", "label", "option", "optgroup", "object", "video", "audio"}
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table", "thead", "tbody", "tfoot"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select"}}

_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"'=]|=\s*\"[^\"]*\"|=\s*'[^']*'|[=\"'])*+)(?:>|\Z)", re.S)
_NAMED = re.compile(r"\b(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)


@dataclass
class Block:
    path: tuple[str, ...]  # from the root, such as 'div.ad'
    text: str
    links: float  # share of characters within a


def _label(tag: str, attributes: str) -> str:
    names = []
    if "=" in attributes:
        for kind, a, b, c in _NAMED.findall(attributes):
            sign = {"class": ".", "id": "#"}.get(kind.lower(), "@")
            names += [sign + n for n in (a or b or c).lower().split()]
    return tag + "".join(names)


def blocks(page: str | None) -> list[Block]:
    """The page's leaf blocks in order, with white space turned into single spaces; empty ones are left out.

    Unclosed and misnested tags are closed as browsers do for paragraphs, list items and cells. Comments, scripts,
    styles and other raw text are dropped; one without an end tag is a tag like others, but for scripts and styles, whose
    text goes on to the end. A page that ends inside a tag or comment ends there; a quote that no tag closes is a
    character of its tag.
    """
    page = page or ""
    out: list[Block] = []
    stack: list[tuple[str, str]] = []
    parts: list[str] = []
    linked = 0
    in_link = 0
    endless: set[str] = set()  # raw elements that no end tag follows

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                path = tuple(label for tag, label in stack if tag in BLOCKS)
                out.append(Block(path, text, min(1.0, linked / len(text))))
            parts.clear()
            linked = 0

    at = 0
    find = _MARKUP.search
    while True:
        m = find(page, at)
        chunk = page[at : m.start()] if m else page[at:]
        if chunk:
            parts.append(chunk)
            if in_link:
                linked += len(chunk)
        if not m:
            break
        at = m.end()
        if m[2] is None:
            continue
        tag = m[2].lower()
        if m[1]:
            depth = next((k for k in range(len(stack) - 1, -1, -1) if stack[k][0] == tag), -1)
            if depth >= 0 and (tag in BLOCKS or not any(t in BLOCKS for t, _ in stack[depth + 1 :])):
                if tag in BLOCKS or any(t in BLOCKS for t, _ in stack[depth:]):
                    flush()
                in_link -= sum(t == "a" for t, _ in stack[depth:])
                del stack[depth:]
            continue
        if tag in INLINE_BREAK:
            parts.append(" ")
        if tag in BLOCKS:
            flush()
            if tag in CLOSES_P and any(t == "p" for t, _ in stack):
                depth = max(k for k, (t, _) in enumerate(stack) if t == "p")
                in_link -= sum(t == "a" for t, _ in stack[depth:])
                del stack[depth:]
            if tag in SIBLINGS:
                for depth in range(len(stack) - 1, -1, -1):
                    if stack[depth][0] in SCOPE[tag]:
                        break
                    if stack[depth][0] in SIBLINGS[tag]:
                        in_link -= sum(t == "a" for t, _ in stack[depth:])
                        del stack[depth:]
                        break
        if tag in VOID or m[3].rstrip().endswith("/") and tag not in BLOCKS:
            continue
        if tag in RAW and tag not in endless:
            end = re.compile(rf"</{re.escape(tag)}\s*[^>]*(?:>|\Z)", re.I).search(page, at)
            if end or tag in ("script", "style"):
                at = end.end() if end else len(page)
                continue
            endless.add(tag)
        stack.append((tag, _label(tag, m[3])))
        in_link += tag == "a"
    flush()
    return out
