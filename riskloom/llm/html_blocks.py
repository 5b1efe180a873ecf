"""Leaf blocks of a web page: the runs of text between block boundaries, with their place in the tree.

A small tokenizer walks the page once. It knows raw-text elements, unclosed paragraphs
and list items, and stray end tags; text of scripts, styles, templates, the head and
hidden elements is never a block.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field
from functools import lru_cache

# How elements behave.
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog dir div dl dt fieldset figcaption figure footer form frameset h1 h2 h3 h4 h5 h6 "
    "head header hgroup hr html iframe legend li main menu nav noframes ol optgroup option p pre section select summary table tbody td tfoot th thead title tr ul video audio".split()
)
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes".split())
UNSEEN = frozenset("head script style template noscript textarea title select option optgroup svg math object iframe xmp noembed noframes datalist canvas audio video".split())
# An open element that a start tag ends: paragraphs by any block, items and cells by their like.
ENDS = {
    "li": ({"li"}, {"ul", "ol", "menu"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}), "tr": ({"tr", "td", "th"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"}),
}

# Comments and declarations run to their end or the page's; a tag runs to the first ">" outside a quoted value.
_OTHER = re.compile(r"<!--(?:>|->|.*?(?:--!?>|\Z))|<[!?][^>]*+(?:>|\Z)|</(?![A-Za-z])[^>]*+(?:>|\Z)", re.DOTALL)
_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*+)((?:[^>\"'=]++|=\s*+(?:\"[^\"]*+\"|'[^']*+')?+|[\"'])*+)>")
_ATTRIBUTE = re.compile(r"([^\s=\"'>/]+)(?:\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+)))?")
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])|[0-9]+")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.IGNORECASE)


@dataclass
class Block:
    """One leaf block: text, tags of its ancestors (outermost first), their class, id and role words, and characters in links."""

    text: str
    tags: tuple[str, ...]
    words: tuple[frozenset[str], ...]
    link_chars: int = 0


@dataclass
class _Open:
    tag: str
    words: frozenset[str]
    unseen: bool


@dataclass
class _Walk:
    stack: list[_Open] = field(default_factory=list)
    blocks: list[Block] = field(default_factory=list)
    pieces: list[str] = field(default_factory=list)
    link: bool = False
    link_chars: int = 0

    def flush(self) -> None:
        if self.pieces:
            text = " ".join("".join(self.pieces).split())
            if text:
                self.blocks.append(Block(text, tuple(o.tag for o in self.stack), tuple(o.words for o in self.stack), min(self.link_chars, len(text))))
        self.pieces, self.link_chars = [], 0

    def text(self, raw: str) -> None:
        if raw and not (self.stack and self.stack[-1].unseen):
            plain = html.unescape(raw) if "&" in raw else raw
            self.pieces.append(plain)
            if self.link:
                self.link_chars += len(plain.strip())

    def close(self, tags: set[str], within: set[str]) -> None:
        for i in range(len(self.stack) - 1, -1, -1):
            if self.stack[i].tag in tags:
                del self.stack[i:]
                return
            if self.stack[i].tag in within:
                return

    def start(self, tag: str, attributes: str, closed: bool) -> None:
        if tag == "br":
            self.pieces.append(" ")
        elif tag == "a":
            self.link = True
        unseen = bool(self.stack and self.stack[-1].unseen) or tag in UNSEEN
        if tag in BLOCK:
            self.flush()
            self.link = False
            self.close({"p"}, {"td", "th", "li", "div", "article", "section", "main", "aside", "body"})
            if tag in ENDS:
                self.close(*ENDS[tag])
        elif tag not in UNSEEN:
            return
        words: set[str] = set()
        if attributes:
            for name, a, b, c in _ATTRIBUTE.findall(attributes):
                name = name.lower()
                if name in ("class", "id", "role", "itemprop", "aria-label"):
                    words.update(w.lower() for w in _WORD.findall(a or b or c))
                elif name == "hidden" or name == "style" and _HIDDEN.search(a or b or c):
                    unseen = True
                elif name == "aria-hidden" and (a or b or c).lower() == "true":
                    unseen = True
        if tag not in VOID and not closed:
            self.stack.append(_Open(tag, frozenset(words), unseen))

    def end(self, tag: str) -> None:
        if tag == "a":
            self.link = False
        elif tag in BLOCK or tag in UNSEEN:
            if tag in BLOCK:
                self.flush()
                self.link = False
            for i in range(len(self.stack) - 1, -1, -1):
                if self.stack[i].tag == tag:
                    del self.stack[i:]
                    break


def leaf_blocks(page: str) -> list[Block]:
    """The text blocks of a page in order."""
    walk, at = _Walk(), 0
    while True:
        begin = page.find("<", at)
        if begin < 0:
            walk.text(page[at:])
            break
        nature = page[begin + 1:begin + 2]
        if not (nature.isascii() and nature.isalpha()) and nature not in ("/", "!", "?") or not nature:  # a lone "<" is text
            walk.text(page[at:begin + 1])
            at = begin + 1
            continue
        walk.text(page[at:begin])
        m = _OTHER.match(page, begin)
        if m:
            at = m.end()
            continue
        m = _TAG.match(page, begin)
        if m is None:  # a tag that never ends is no text
            break
        at, tag = m.end(), m[2].lower()
        if m[1]:
            walk.end(tag)
            continue
        walk.start(tag, m[3], m[3].endswith("/") and tag not in BLOCK)
        if tag in RAW:
            stop = _raw_end(tag).search(page, at)
            at = stop.start() if stop else len(page)
    walk.flush()
    return walk.blocks


@lru_cache
def _raw_end(tag: str) -> re.Pattern:
    return re.compile(rf"</{tag}(?=[\s/>])", re.IGNORECASE | re.ASCII)
