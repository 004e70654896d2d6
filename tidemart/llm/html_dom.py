"""A lenient reader of HTML into a tree of block elements with their texts."""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

# Element names by what they do to the text.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
#: Contents that are not markup, up to the closing tag.
RAW = frozenset("script style noscript template textarea title iframe svg object select annotation annotation-xml".split())
#: Elements that end a block of text; all others run inside one.
BLOCK = frozenset(
    "address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption figure footer form "
    "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot "
    "th thead tr ul".split()
)
#: A new element of the key closes an open one of these, unless a boundary lies between.
CLOSES = {
    "li": frozenset(["li", "p"]),
    "dt": frozenset(["dt", "dd", "p"]),
    "dd": frozenset(["dt", "dd", "p"]),
    "tr": frozenset(["tr", "td", "th", "p"]),
    "td": frozenset(["td", "th", "p"]),
    "th": frozenset(["td", "th", "p"]),
}
BOUNDARY = frozenset("article aside body div dl footer form header html main nav ol section table ul blockquote".split())

#: Elements nested more deeply become children of the element at this depth: their texts stay, in page order.
MAX_DEPTH = 120

_MARKUP = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)([^>]*)(?:>|\Z)", re.S)
_NAMES = re.compile(r"""\b(?:class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.I)
_WORDS = re.compile(r"[a-z]+")
#: Marks a word that is a whole class, id or role, and not a piece of a longer name.
WHOLE = "="


@dataclass
class Node:
    """A block element: its label (element, and the words of class, id and role; whole names marked), its blocks and children."""

    label: str
    blocks: list[int] = field(default_factory=list)
    children: list[Node] = field(default_factory=list)


@dataclass
class Page:
    """The tree, the texts of its blocks in page order, and for each block how many of its characters are in links."""

    root: Node
    texts: list[str]
    linked: list[int]


def _label(name: str, attributes: str) -> str:
    if not attributes:
        return name
    values = [(m[1] or m[2] or m[3] or "").lower() for m in _NAMES.finditer(attributes)]
    words = {w for v in values for w in _WORDS.findall(v)}
    whole = {WHOLE + t for v in values for t in v.split() if _WORDS.fullmatch(t)}
    return " ".join([name, *sorted(words | whole)])


def parse(markup: str) -> Page:
    """Reads any text as HTML: unclosed, misplaced and cut-off tags included. Never fails."""
    root = Node("#page")
    stack: list[tuple[str, Node]] = [("#page", root)]  # block elements and the inline ones that are open
    texts: list[str] = []
    linked: list[int] = []
    parts: list[str] = []
    in_link = [0, 0]  # characters of the current block in links, depth of open links
    owner = root

    def flush() -> None:
        nonlocal parts
        if parts:
            text = " ".join(html.unescape("".join(parts)).split())
            if text:
                owner.blocks.append(len(texts))
                texts.append(text)
                linked.append(min(in_link[0], len(text)))
            parts = []
        in_link[0] = 0

    def say(text: str) -> None:
        if text:
            parts.append(text)
            if in_link[1]:
                in_link[0] += len(text)

    def leave(depth: int) -> None:
        nonlocal owner
        flush()
        del stack[depth:]
        owner = stack[-1][1]

    at, end = 0, len(markup)
    while at < end:
        found = _MARKUP.search(markup, at)
        if not found:
            say(markup[at:])
            break
        say(markup[at : found.start()])
        at = found.end()
        name = found[2]
        if name is None:
            continue
        name = name.lower()
        if found[1]:
            if name == "a":
                in_link[1] = max(0, in_link[1] - 1)
            elif name == "p" or name in BLOCK:
                depth = next((i for i in range(len(stack) - 1, 0, -1) if stack[i][0] == name), 0)
                if depth:
                    leave(depth)
                else:
                    flush()
        elif name in RAW:
            close = re.compile(rf"</{re.escape(name)}\b[^>]*(?:>|\Z)", re.I).search(markup, at)
            if not found[3].endswith("/"):
                at = close.end() if close else end
        elif name == "br" or (name in VOID and name != "hr"):
            say(" ")
        elif name == "a":
            in_link[1] = 1
        elif name in BLOCK:
            in_link[1] = 0
            flush()
            closes = CLOSES.get(name, frozenset(["p"]))
            for i in range(len(stack) - 1, 0, -1):
                if stack[i][0] in closes:
                    leave(i)
                elif stack[i][0] in BOUNDARY:
                    break
            if name != "hr":
                node = Node(_label(name, found[3]))
                (owner if len(stack) <= MAX_DEPTH else stack[MAX_DEPTH - 1][1]).children.append(node)
                stack.append((name, node))
                owner = node
    flush()
    return Page(root, texts, linked)
