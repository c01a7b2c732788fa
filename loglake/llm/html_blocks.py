"""Leaf text blocks of a web page, with the elements around them. Tolerates unclosed and stray tags."""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

#: Elements that begin and end a block of text.
BLOCK = frozenset(
    "address article aside blockquote body button caption center dd details dialog div dl dt fieldset figcaption figure "
    "footer form frameset h1 h2 h3 h4 h5 h6 header hgroup hr html label legend li main menu nav ol optgroup option p pre "
    "search section select summary table tbody td tfoot th thead tr ul".split())
#: Elements without an end, elements whose inside is no text, and which open ones a start tag closes.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe svg math object audio video canvas xmp noembed noframes".split())
SPACING = frozenset(("br", "img", "input", "wbr"))
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "optgroup": ("option", "optgroup"), "tbody": ("tr", "td", "th", "thead", "tbody"),
    "tfoot": ("tr", "td", "th", "thead", "tbody"),
}
SCOPE = frozenset("ul ol menu dl table select body html".split())

TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']++|\"[^\"]*+\"|'[^']*+')*+>|[^>]*(?:>|\Z))", re.S)
ATTRIBUTE = re.compile(r"(?:^|[\s\"'/])(class|id|role)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))", re.I)
NAME_PART = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")


@dataclass(slots=True)
class Node:
    """An open block element and all that is open around it."""

    tag: str
    names: frozenset[str]
    parent: Node | None
    tags: frozenset[str] = field(default=frozenset())
    around: frozenset[str] = field(default=frozenset())
    inner: dict = field(default_factory=dict)

    def child(self, tag: str, attributes: str) -> Node:
        """The same object for equal elements in equal surroundings, so that features are made once."""
        key = (tag, attributes)
        found = self.inner.get(key)
        if found is None:
            names = frozenset(
                part.lower() for m in ATTRIBUTE.finditer(attributes) for part in NAME_PART.findall(m[2] or m[3] or m[4] or ""))
            found = Node(tag, names, self, self.tags | {tag}, self.around | names)
            if len(self.inner) < 64:
                self.inner[key] = found
        return found


@dataclass(slots=True)
class Block:
    text: str
    linked: int
    node: Node


def root() -> Node:
    return Node("", frozenset(), None)


def blocks_of(html: str, top: Node) -> list[Block]:
    """The page's blocks in order: white space made one blank, character references decoded."""
    out: list[Block] = []
    node, parts, linked, in_link, at, size = top, [], 0, False, 0, len(html)

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                out.append(Block(text, min(linked, len(text)), node))
            parts.clear()
        linked = 0

    def close(tags: tuple[str, ...], scope: frozenset[str]) -> None:
        nonlocal node
        found, here = None, node
        while here.parent is not None and here.tag not in scope:
            if here.tag in tags:
                found = here
            here = here.parent
        if found is not None:
            node = found.parent

    while at < size:
        tag_at = html.find("<", at)
        match = TOKEN.match(html, tag_at) if tag_at >= 0 else None
        end = size if tag_at < 0 else tag_at + (match is None)
        if end > at:
            piece = html[at:end]
            parts.append(piece)
            if in_link:
                linked += len(piece)
        if match is None:
            at = end
            continue
        at = match.end()
        tag = (match[2] or "").lower()
        if not tag:
            continue
        if not match[1]:
            if tag in RAW:
                closing = re.compile(rf"</{re.escape(tag)}(?=[\s/>]|\Z)[^>]*>?", re.I).search(html, at)
                at = closing.end() if closing else size
                parts.append(" ")
            elif tag == "head":
                closing = re.compile(r"</head\s*>|(?=<body[\s>])", re.I).search(html, at)
                at = closing.end() if closing else at
            elif tag == "a":
                in_link = True
            elif tag in SPACING:
                parts.append(" ")
            elif tag in BLOCK:
                flush()
                close(("p",), SCOPE | {"button", "div", "section", "article", "td", "th", "li"})
                if tag in CLOSES:
                    close(CLOSES[tag], SCOPE)
                if tag not in VOID:
                    node = node.child(tag, match[3])
        elif tag == "a":
            in_link = False
        elif tag in BLOCK:
            flush()
            here = node
            while here.parent is not None and here.tag != tag:
                here = here.parent
            if here.parent is not None and tag not in ("html", "body"):
                node = here.parent
    flush()
    return out
