"""A page as a tree of its block elements, with the text runs between them in page order.

Inline elements belong to the block around them. What is never shown (scripts, styles, head, templates, controls of forms)
is left out, comments and declarations too. Unclosed elements end where HTML ends them: a paragraph before the next block,
a list item before the next, anything with its parent; an end tag without a start is ignored. Half a tag at the end of a
page, as cut pages have it, is dropped.
"""

from __future__ import annotations

import html
import re
from dataclasses import dataclass, field

from ..functions.html import ATTRIBUTES, VALUE

INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i img ins kbd mark q rp rt ruby s samp small "
                   "span strike strong sub sup time tt u var wbr".split())
EMPTY = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset("script style head title template noscript iframe object svg canvas select textarea option button datalist "
                   "audio video map math".split())
#: Their content is not markup: it ends at the end tag of the same name only.
RAW = "script|style|textarea|title|iframe|noscript|xmp"
ENDS_PARAGRAPH = frozenset("address article aside blockquote center details dialog dir div dl dd dt fieldset figcaption figure footer "
                           "form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul li".split())
#: element -> (those it ends, where the search for them stops)
ENDS_SAME = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dd": ({"dd", "dt"}, {"dl"}), "dt": ({"dd", "dt"}, {"dl"}),
    "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
    "tbody": ({"tbody", "thead", "tr", "td", "th"}, {"table"}), "tfoot": ({"tbody", "thead", "tr", "td", "th"}, {"table"}),
}
TOKEN = re.compile(
    rf"<!--(?s:.*?)(?:--!?>|\Z)|<(?P<raw>{RAW})(?=[\s/>]){ATTRIBUTES}>(?s:.*?)(?:</(?P=raw)\s*>|\Z)"
    rf"|<(?P<end>/?)(?P<tag>[a-zA-Z][^\s/>]*+)(?P<attrs>{ATTRIBUTES})>|<[!?/][^>]*(?:>|\Z)"
    r"|<[a-zA-Z/!?][^>]*\Z|(?P<text>[^<]+|<)", re.I)
NAMED_VALUE = re.compile(rf"([^\s/>][^\s/=>]*+)(?:\s*+=++\s*+({VALUE}))?+")


@dataclass
class Node:
    tag: str
    attrs: str
    parent: int
    label: bool | None = None
    seen: bool = True
    chars: int = 0  # of its own text runs
    linked: int = 0  # of those, inside links
    runs: int = 0
    marks: int = 0  # of punctuation in its own runs
    children: list[int] = field(default_factory=list)


def attributes(raw: str) -> dict[str, str]:
    """Names in lower case with their decoded values; of equal names the first counts."""
    found: dict[str, str] = {}
    for m in NAMED_VALUE.finditer(raw):
        value = m[2] or ""
        found.setdefault(m[1].lower(), html.unescape(value[1:-1] if value[:1] in ("'", '"') else value))
    return found


def parsed(page: str, label_with: str | None = None) -> tuple[list[Node], list[tuple[int, str]]]:
    """Nodes, parents first, and the runs (node, text with single spaces) in page order. Node 0 is the page.

    ``label_with``: an attribute that marks content (1) or not (0) in labelled pages; it reaches down to the next mark.
    """
    nodes = [Node("#page", "", -1)]
    stack, runs, held = [0], [], []
    linked = in_link = 0

    def flush() -> None:
        nonlocal linked
        if held:
            text = " ".join("".join(held).split())
            node = nodes[stack[-1]]
            if text and node.seen:
                runs.append((stack[-1], text))
                node.chars += len(text)
                node.runs += 1
                node.linked += min(linked, len(text))
                node.marks += sum(map(text.count, ".,;!?"))
            held.clear()
        linked = 0

    for m in TOKEN.finditer(page):
        kind = m.lastgroup
        if kind == "text":
            text = html.unescape(m["text"]) if "&" in m["text"] else m["text"]
            held.append(text)
            if in_link:
                linked += len(text)
            continue
        tag = (m["tag"] or "").lower()
        if not tag:
            continue
        if tag == "br":
            held.append(" ")
            continue
        if tag in INLINE:
            if tag == "a":
                in_link = 0 if m["end"] else 1
            continue
        flush()
        in_link = 0
        if m["end"]:
            for depth in range(len(stack) - 1, 0, -1):
                if nodes[stack[depth]].tag == tag:
                    del stack[depth:]
                    break
            continue
        if tag in ("html", "body"):
            continue
        if tag in ENDS_PARAGRAPH:
            for depth in range(len(stack) - 1, 0, -1):
                if nodes[stack[depth]].tag == "p":
                    del stack[depth:]
                    break
                if nodes[stack[depth]].tag in ENDS_PARAGRAPH:
                    break
        if tag in ENDS_SAME:
            ends, stops = ENDS_SAME[tag]
            for depth in range(len(stack) - 1, 0, -1):
                if nodes[stack[depth]].tag in stops:
                    break
                if nodes[stack[depth]].tag in ends:
                    del stack[depth:]
        if tag in EMPTY:
            continue
        up = stack[-1]
        attrs = m["attrs"] or ""
        node = Node(tag, attrs, up, nodes[up].label, nodes[up].seen and tag not in UNSEEN)
        if label_with is not None and (mark := attributes(attrs).pop(label_with, None)) is not None:
            node.label = mark == "1"
        nodes[up].children.append(len(nodes))
        nodes.append(node)
        if not attrs.endswith("/") or tag in ("div", "p", "li", "section", "article"):
            stack.append(len(nodes) - 1)
    flush()
    return nodes, runs
