"""Leaf blocks of web pages: what text stands together, and below which elements.

Markup is read in one pass whose time follows the page's length, whatever is nested or left
open. Start tags close what they imply to be closed (a paragraph before a block, a list item
before the next), end tags close what is open, and text between two block boundaries is one
block. Character references are decoded in each piece of text, runs of white space become one
space. Scripts, styles, comments and the head have no text.
"""

from __future__ import annotations

import re
import zlib
from dataclasses import dataclass
from functools import lru_cache
from html import unescape

#: The elements of HTML that begin a block, those without content, and those whose content is no markup.
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure"
    " footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main menu nav ol optgroup option p pre search section"
    " select summary table tbody td tfoot th thead tr ul".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title iframe noembed noframes xmp".split())
SILENT = frozenset("head template svg math object audio video canvas".split())
#: What a start tag closes if it is open in the same scope, and the elements that open a scope of their own.
CLOSES = {
    "li": ("li",),
    "dt": ("dt", "dd"),
    "dd": ("dt", "dd"),
    "td": ("td", "th"),
    "th": ("td", "th"),
    "tr": ("tr",),
    "option": ("option",),
    "body": ("head",),
}
SCOPES = {
    "ul": ("li", "p"),
    "ol": ("li", "p"),
    "menu": ("li", "p"),
    "dl": ("dt", "dd", "p"),
    "table": ("p", "li", "dt", "dd", "td", "th", "tr"),
    "td": ("p", "li", "dt", "dd"),
    "th": ("p", "li", "dt", "dd"),
    "button": ("p",),
    "select": ("option",),
}
#: What a page's own markup says of its blocks: main text is inside one of the first, not inside the others.
MAIN_ELEMENTS = ("article", "main")
OTHER_ELEMENTS = ("nav", "aside", "footer", "form", "header")
OTHER_NAMES = frozenset("ad ads advert comment comments reply replies related share sharing sidebar widget sponsored promo".split())
_CLOSED = frozenset(t for ts in CLOSES.values() for t in ts) | {"p"}

PATH_SLOTS = 512
#: A character of training pages that marks their main text.
MARK = "\ue000"

_NAME = re.compile(r"[a-zA-Z][^\s/>]*+")
_ATTRIBUTE = re.compile(r"""(class|id|role|itemprop|style|hidden|aria-hidden)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s>]++))?+""", re.I)
_WORD = re.compile(r"[a-z]++|[0-9]++")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass
class Block:
    """A block's text, the slots of the elements around it, how many of its characters are links, and whether markup says it is main text."""

    text: str
    path: tuple[int, ...]
    links: int
    told: bool = False


@lru_cache(1 << 14)
def _slot(token: str) -> int:
    return zlib.crc32(token.encode()) % PATH_SLOTS


def _slots(tag: str, attributes: str) -> tuple[tuple[int, ...], bool]:
    """The slots of an element, and whether its names set it apart from main text."""
    tokens = {f"<{tag}"}
    for name, value in _ATTRIBUTE.findall(attributes) if attributes else ():
        name, value = name.lower(), value.strip("\"'")
        if name in ("hidden", "aria-hidden"):
            tokens |= {"hidden"} if name == "hidden" or value == "true" else set()
        elif name == "style":
            tokens |= {"hidden"} if re.search(r"display\s*+:\s*+none", value) else set()
        else:
            tokens.update(f".{w}" for w in _WORD.findall(_CAMEL.sub(" ", value).lower()))
    return tuple(_slot(t) for t in sorted(tokens)), any(t[1:] in OTHER_NAMES for t in tokens if t[0] == ".")


class _Reader:
    def __init__(self):
        self.stack: list[tuple[str, tuple[int, ...], dict[str, int], bool]] = []
        self.open: dict[str, int] = {}
        self.counts = [0] * PATH_SLOTS
        self.slots: set[int] = set()
        self.silent = 0
        self.apart = 0
        self.blocks: list[Block] = []
        self.pieces: list[str] = []
        self.links = 0

    def flush(self) -> None:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                own = next((t for t, *_ in reversed(self.stack) if t in BLOCK), "")
                path = (*sorted(self.slots), _slot(f"leaf {own}"))
                self.blocks.append(Block(text, path, min(self.links, len(text)), self.told()))
            self.pieces, self.links = [], 0

    def told(self) -> bool:
        return not self.apart and any(map(self.open.get, MAIN_ELEMENTS)) and not any(map(self.open.get, OTHER_ELEMENTS))

    def text(self, raw: str) -> None:
        if not self.silent:
            piece = unescape(raw) if "&" in raw else raw
            self.pieces.append(piece)
            if self.open.get("a"):
                self.links += len(piece.strip())

    def start(self, tag: str, attributes: str) -> None:
        scope = self.stack[-1][2] if self.stack else {}
        if tag in BLOCK:
            self.flush()
        for closed in CLOSES.get(tag, ()) + (("p",) if tag in BLOCK else ()):
            if closed in scope:
                self.cut(scope[closed])
                scope = self.stack[-1][2] if self.stack else {}
        if tag in VOID:
            if tag == "br" and not self.silent:
                self.pieces.append(" ")
            return
        slots, apart = _slots(tag, attributes)
        if tag in SCOPES:
            scope = {t: at for t, at in scope.items() if t not in SCOPES[tag]}
        if tag in _CLOSED:
            scope = scope | {tag: len(self.stack)}
        self.stack.append((tag, slots, scope, apart))
        self.apart += apart
        self.open[tag] = self.open.get(tag, 0) + 1
        self.silent += tag in SILENT
        for slot in slots:
            self.counts[slot] += 1
            self.slots.add(slot)

    def end(self, tag: str) -> None:
        if tag in BLOCK:
            self.flush()
        if self.open.get(tag):
            at = len(self.stack) - 1
            while self.stack[at][0] != tag:
                at -= 1
            self.cut(at)

    def cut(self, depth: int) -> None:
        """Close everything from this depth on."""
        for tag, slots, _, apart in self.stack[depth:]:
            self.apart -= apart
            self.open[tag] -= 1
            self.silent -= tag in SILENT
            for slot in slots:
                self.counts[slot] -= 1
                if not self.counts[slot]:
                    self.slots.discard(slot)
        del self.stack[depth:]


def _tag_end(html: str, start: int, missing: set[str]) -> int:
    """Where the tag that starts here ends, quoted > aside; ``missing`` holds quotes known not to come any more."""
    at = start
    while True:
        end = html.find(">", at)
        if end < 0:
            return len(html)
        quote, at = _open_quote(html, at, end)
        if not quote or quote in missing:
            return end
        close = html.find(quote, end)
        if close < 0:
            missing.add(quote)
            return end
        at = close + 1


def _open_quote(html: str, at: int, end: int) -> tuple[str, int]:
    while True:
        first = [p for p in (html.find('"', at, end), html.find("'", at, end)) if p >= 0]
        if not first:
            return "", end
        quote = html[min(first)]
        close = html.find(quote, min(first) + 1, end)
        if close < 0:
            return quote, end
        at = close + 1


def blocks(html: str) -> list[Block]:
    """The blocks of a page in order."""
    reader, at, size, missing = _Reader(), 0, len(html), set()
    lowered = ""
    while at < size:
        mark = html.find("<", at)
        if mark < 0:
            reader.text(html[at:])
            break
        if mark > at:
            reader.text(html[at:mark])
        after = html[mark + 1 : mark + 2]
        if html.startswith("<!--", mark):
            end = html.find("-->", mark + 4)
            at = size if end < 0 else end + 3
        elif after in ("!", "?"):
            end = html.find(">", mark)
            at = size if end < 0 else end + 1
        else:
            name = _NAME.match(html, mark + 2 if after == "/" else mark + 1)
            if not name:
                reader.text("<")
                at = mark + 1
                continue
            end = _tag_end(html, name.end(), missing)
            tag, at = name[0].lower(), end + 1
            if after == "/":
                reader.end(tag)
                continue
            reader.start(tag, html[name.end() : end])
            if tag in RAW:
                lowered = lowered or html.lower()
                close = lowered.find(f"</{tag}", at) if len(lowered) == size else html.find(f"</{tag}", at)
                at = size if close < 0 else close
    reader.flush()
    return reader.blocks
