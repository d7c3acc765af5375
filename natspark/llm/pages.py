"""Pages as trees of blocks: a small tokenizer of HTML, which gives each block element and each run of text in it.

Nodes of a page come in page order, parents before children. Elements that only mark words (``b``, ``a``, ``span``) are no
nodes: their text belongs to the block around them, and what lies in an ``a`` is counted as linked. A run of text is a
leaf of its own; another block ends it. End tags close the nearest open element of their name; a new paragraph, item or
cell closes the one it follows, as browsers do; what is open at the end of a page that was cut off ends there. Comments,
declarations, scripts, styles and the head have no text. Character references are decoded once; any white space inside a
run, ``br`` included, becomes one space.
"""

from __future__ import annotations

import re
from dataclasses import dataclass, field
from html import unescape

#: Element names of HTML that mark words inside a block, that hold no text to read, that have no end tag,
#: and what a new element of a kind closes.
INLINE = set("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark meter output q ruby rb rp rt s samp small span strike strong sub sup time tt u var wbr".split())
SILENT = set("audio canvas head iframe math noscript object script style svg template textarea title video".split())
RAW = set("iframe noscript script style textarea title".split())
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
CLOSED_BY = {
    "p": set("address article aside blockquote details div dl fieldset figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split()),
    "li": {"li"},
    "dt": {"dt", "dd"},
    "dd": {"dt", "dd"},
    "option": {"option", "optgroup"},
    "td": {"td", "th", "tr", "tbody", "tfoot"},
    "th": {"td", "th", "tr", "tbody", "tfoot"},
    "tr": {"tr", "tbody", "tfoot"},
    "thead": {"tbody", "tfoot"},
    "tbody": {"tbody", "tfoot"},
}
#: An implied end tag does not reach beyond these.
_FENCE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"table"}, "th": {"table"}, "thead": {"table"}, "tbody": {"table"}, "option": {"select"}}
_PHRASE_FENCE = {"table", "td", "th", "body"}
_TAG = re.compile(
    r"""<!--.*?(?:-->|\Z)"""
    r"""|<(/?)([A-Za-z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>"""
    r"""|<(/?)([A-Za-z][^\s/>]*+)([^>]*+)>"""  # a quote that is never closed
    r"""|<[!?][^>]*+>|<(?=/?[A-Za-z!?])[^<]*+\Z""",
    re.S,
)
_NAMES = re.compile(r"""\b(?:class|id|role|itemprop)\s*=\s*("[^"]*"|'[^']*'|[^\s"'>]+)""", re.I)
_HIDDEN = re.compile(r"""(?:^|\s)hidden(?:\s|=|$)|aria-hidden\s*=\s*["']?true|display\s*:\s*none""", re.I)
_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+")
RUN = "#text"


@dataclass
class Node:
    parent: int
    tag: str
    #: Words of class, id and role, in lower case.
    names: tuple[str, ...] = ()
    text: str = ""
    linked: int = 0
    #: Pieces of a run while it is read.
    parts: list[str] = field(default_factory=list)


def name_words(attributes: str) -> tuple[str, ...]:
    """The words of an element's class, id and role; ``hidden`` if it isn't shown."""
    if "=" not in attributes and "hidden" not in attributes.lower():
        return ()
    words = tuple(w.lower() for value in _NAMES.findall(attributes) for w in _WORD.findall(value))
    return (*words, "hidden") if _HIDDEN.search(attributes) else words


def tree(html: str | None) -> list[Node]:
    """The nodes of a page. The first is the page itself; runs without a character to show are left out."""
    return _finished(_Reader().read(html or ""))


class _Reader:
    def __init__(self):
        self.nodes = [Node(-1, "#page")]
        #: Open elements as (tag, node): one that marks words shares the node of its block.
        self.open: list[tuple[str, int]] = [("#page", 0)]
        self.silent = self.links = 0
        self.run: Node | None = None

    def say(self, piece: str) -> None:
        if self.silent or not piece:
            return
        if self.run is None:
            self.run = Node(self.open[-1][1], RUN)
            self.nodes.append(self.run)
        piece = unescape(piece)
        self.run.parts.append(piece)
        self.run.linked += len(piece) if self.links else 0

    def close(self, depth: int) -> None:
        for tag, _ in self.open[depth:]:
            self.silent -= tag in SILENT
            self.links -= tag == "a"
        del self.open[depth:]

    def end(self, tag: str) -> None:
        if tag not in INLINE:
            self.run = None
        for depth in range(len(self.open) - 1, 0, -1):
            if self.open[depth][0] == tag:
                return self.close(depth)
            if tag in INLINE and self.open[depth][0] not in INLINE:
                return  # opened outside this block, if at all
        return

    def start(self, tag: str, attributes: str) -> None:
        if tag in VOID:
            if tag == "br":
                self.say(" ")
            elif tag == "hr":
                self.run = None
            return
        if tag in INLINE:
            self.links += tag == "a"
            self.open.append((tag, self.open[-1][1]))
            return
        if tag in SILENT:
            if not attributes.endswith("/"):
                self.open.append((tag, self.open[-1][1]))
                self.silent += 1
            return
        self.run = None
        for depth in range(len(self.open) - 1, 0, -1):
            before = self.open[depth][0]
            # Only what has no text may stand in a head, so that anything else ends it.
            if before == "head" or tag in CLOSED_BY.get(before, ()):
                self.close(depth)
                break
            if before in _FENCE.get(tag, _PHRASE_FENCE):
                break
        self.nodes.append(Node(self.open[-1][1], tag, name_words(attributes)))
        self.open.append((tag, len(self.nodes) - 1))

    def read(self, html: str) -> list[Node]:
        at = 0
        while found := _TAG.search(html, at):
            self.say(html[at : found.start()])
            at = found.end()
            slash, tag, attributes = found.group(1, 2, 3) if found[2] else found.group(4, 5, 6)
            tag = (tag or "").lower()
            if tag and slash:
                self.end(tag)
            elif tag in RAW:
                stop = re.compile(rf"</{tag}\b[^>]*>", re.I).search(html, at)
                at = stop.end() if stop else len(html)
            elif tag:
                self.start(tag, attributes)
        self.say(html[at:])
        return self.nodes


def _finished(nodes: list[Node]) -> list[Node]:
    """Runs with their text; runs of white space alone go, and parents are numbered anew."""
    place, out = {}, []
    for k, node in enumerate(nodes):
        if node.tag == RUN:
            node.text = " ".join("".join(node.parts).split())
            node.parts = []
            if not node.text:
                continue
        place[k] = len(out)
        node.parent = place.get(node.parent, -1)
        out.append(node)
    return out
