"""Leaf blocks of a page: the text of each block-level element with the path that leads to it."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass

_TOKEN = re.compile(
    r"<!--.*?(?:-->|$)|<(/?)([a-zA-Z][a-zA-Z0-9:-]*)((?:[^<>\"']|\"[^\"]*\"|'[^']*')*)>|<[!?][^>]*>",
    re.DOTALL,
)
_NAMES = re.compile(r"\b(?:class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+))", re.IGNORECASE)
_WORD = re.compile(r"[a-zA-Z]+")
RAW = {"script", "style", "template", "title", "textarea", "iframe"}
#: Drawings and formulas: their tags are inline and their text belongs to the block around them,
#: until they are closed or a block of the page begins.
FOREIGN = {"svg", "math"}
BREAKS_OUT = {
    "article", "aside", "blockquote", "body", "center", "dd", "div", "dl", "dt", "footer", "form", "h1",
    "h2", "h3", "h4", "h5", "h6", "header", "hr", "li", "main", "nav", "ol", "p", "pre", "section",
    "table", "ul",
}
VOID = {
    "area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track",
    "wbr",
}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em",
    "font", "i", "ins", "kbd", "label", "mark", "q", "ruby", "rp", "rt", "s", "samp", "small",
    "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var",
}
#: An opening tag ends open elements of these kinds up to the next container.
ENDS = {
    "li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
    "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
}
HOLDS = {"ul", "ol", "dl", "table", "tbody", "thead", "select", "div", "section", "article", "main",
         "body", "nav", "aside", "footer", "header", "form"}


@dataclass
class Block:
    text: str
    path: tuple[tuple[str, tuple[str, ...]], ...]  # (tag, words of class, id and role)
    linked: float  # share of the text inside links


def _names(attributes: str) -> tuple[str, ...]:
    words = []
    for found in _NAMES.findall(attributes):
        words += [w.lower() for w in _WORD.findall("".join(found))]
    return tuple(words)


def leaf_blocks(page: str) -> list[Block]:
    """Blocks in page order; scripts, styles, comments and the title hold none. Formulas and the
    text of drawings stay in their block.

    White space is collapsed after character references are decoded; blocks without text are left
    out. Unclosed elements end where their container ends, and a block tag ends a paragraph.
    """
    blocks: list[Block] = []
    path: list[tuple[str, tuple[str, ...]]] = []
    pieces: list[str] = []
    linked, links, foreign = 0, 0, 0

    def flush() -> None:
        nonlocal linked
        if pieces:
            raw = "".join(pieces)
            text = " ".join((html.unescape(raw) if "&" in raw else raw).split())
            if text:
                blocks.append(Block(text, tuple(path), min(1.0, linked / len(text))))
            pieces.clear()
        linked = 0

    at, end = 0, len(page)
    while at < end:
        token = _TOKEN.search(page, at)
        stop = token.start() if token else end
        if stop > at:
            pieces.append(page[at:stop])
            if links:
                linked += stop - at
        if token is None:
            break
        at = token.end()
        closing, tag = token.group(1), token.group(2)
        if tag is None:
            continue
        tag = tag.lower()
        if tag in RAW and not closing:
            if not token.group(3).endswith("/"):
                close = re.compile(rf"</{tag}\s*>", re.IGNORECASE).search(page, at)
                at = close.end() if close else end
            continue
        if tag in FOREIGN:
            if closing:
                foreign = max(0, foreign - 1)
            elif not token.group(3).endswith("/"):
                foreign += 1
            continue
        if foreign and tag not in BREAKS_OUT:
            continue
        foreign = 0
        if tag in VOID:
            if tag == "hr":
                flush()
            else:
                pieces.append(" ")
            continue
        if tag in INLINE:
            if tag == "a":
                links = max(0, links + (-1 if closing else 1))
            continue
        flush()
        links = 0
        if closing:
            for depth in range(len(path) - 1, -1, -1):
                if path[depth][0] == tag:
                    del path[depth:]
                    break
            continue
        if path and path[-1][0] == "p":
            path.pop()
        for depth in range(len(path) - 1, -1, -1):
            if path[depth][0] in ENDS.get(tag, ()):
                del path[depth:]
                break
            if path[depth][0] in HOLDS:
                break
        path.append((tag, _names(token.group(3))))
    flush()
    return blocks
