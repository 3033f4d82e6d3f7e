"""Main text of web pages by a tree-structured graphical model.

Every block element of a page is content or not. A parent and a child are joined by a potential that depends on the child's
kind; each element has a potential of its own from its tag, class, id and role words, and from how much text, links,
punctuation and children it has. Sum-product messages go up the tree and down again, which gives every element's
probability of being content given the whole page. The text of elements above one half is the page's main text.

Both kinds of potentials are trained from labelled pages. ``labelled_pages`` makes some by rule, from the usual names of
page parts; ``from_markup`` labels pages of the given table whose own markup names an article, at most ``SAMPLE`` of them,
chosen by a hash. Every labelled page is also used with its telling tags made neutral, so that no single tag decides.

NULL or empty page: empty text. Text runs keep their order; each is one space apart from the next. Nothing is cut.
"""

from __future__ import annotations

import math
import random
import re
from functools import lru_cache

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import map_rows
from .html_tree import UNSEEN, Node, attributes, parsed

SAMPLE = 300
EPOCHS = 300
MARK = "data-content"
NAME = re.compile(r"[a-z]+|[A-Z][a-z]*|[A-Z]+")
#: Usual names of page parts, as (tag, class or id) of their container.
CONTENT_PARTS = [
    ("article", ""), ("main", ""), ("article", "post"), ("div", "article-body"), ("div", "post-content"), ("div", "entry-content"),
    ("section", "article content"), ("div", "main-content"), ("div", "story"), ("div", "content"), ("div", "text"), ("main", "page"),
]
OTHER_PARTS = {
    "menu": [("nav", ""), ("ul", "menu"), ("div", "navigation"), ("div", "nav navbar"), ("ol", "breadcrumb"), ("div", "topbar"),
             ("div", "pagination"), ("div", "toc")],
    "header": [("header", ""), ("div", "header"), ("div", "masthead"), ("header", "site-header"), ("div", "banner"), ("div", "logo")],
    "footer": [("footer", ""), ("div", "footer"), ("div", "site-footer"), ("div", "copyright"), ("div", "legal")],
    "side": [("aside", ""), ("div", "sidebar"), ("div", "widget"), ("section", "related"), ("div", "recommended"), ("aside", "side"),
             ("div", "trending popular"), ("div", "tags"), ("div", "author bio")],
    "notice": [("div", "cookie-notice"), ("div", "cookie consent"), ("div", "notice"), ("div", "alert"), ("div", "popup modal"),
               ("div", "gdpr"), ("div", "paywall subscribe"), ("dialog", "")],
    "advert": [("div", "ad"), ("div", "ads"), ("div", "advert"), ("div", "advertisement"), ("div", "sponsored"), ("section", "promo"),
               ("div", "ad-slot")],
    "form": [("form", ""), ("div", "newsletter signup"), ("form", "search"), ("div", "login form"), ("fieldset", ""), ("form", "comment-form")],
    "comments": [("section", "comments"), ("div", "comment"), ("ol", "comment-list"), ("div", "disqus"), ("div", "replies"),
                 ("div", "reader-comments"), ("ul", "responses"), ("div", "discussion")],
    "share": [("div", "share"), ("ul", "social"), ("div", "share-buttons")],
}
ROLES = {"menu": "navigation", "header": "banner", "footer": "contentinfo", "side": "complementary", "form": "form",
         "notice": "alert"}
TELLING = frozenset("article main nav header footer aside form dialog".split())
ACCEPT = 0.5


@lru_cache(maxsize=50_000)
def words_of(attrs: str) -> tuple[str, ...]:
    """Words of class, id and role."""
    found = attributes(attrs) if attrs else {}
    return tuple(dict.fromkeys(w.lower().removesuffix("s") for key in ("class", "id", "role") for w in NAME.findall(found.get(key, ""))))


def bucket(n: float) -> int:
    return min(9, int(math.log2(n + 1)))


@lru_cache(maxsize=50_000)
def fixed_features(tag: str, attrs: str, up: str) -> tuple[str, ...]:
    return ("one", f"t:{tag}", f"u:{up}", *(f"w:{w}" for w in words_of(attrs)))


def _sums(nodes: list[Node]) -> list[tuple[int, int, int, int]]:
    """Characters, linked characters, runs and marks of each node's whole subtree."""
    out = [[n.chars, n.linked, n.runs, n.marks] for n in nodes]
    for i in range(len(nodes) - 1, 0, -1):
        up = out[nodes[i].parent]
        for k, v in enumerate(out[i]):
            up[k] += v
    return out


def measures(node: Node, total: list[int]) -> tuple[int, int, int, int]:
    chars, linked, runs, marks = total
    return (bucket(node.chars), int(5 * linked / chars) if chars else 6, bucket(chars / runs) if runs else 10,
            min(5, int(100 * marks / chars)) if chars else 6)


def kind_of(node: Node) -> str:
    return node.tag if not words_of(node.attrs) else f"{node.tag}+"


class Model:
    """Weights of single elements, and P(child | parent) by the child's kind."""

    def __init__(self, weights: dict[str, float], edges: dict[str, tuple[float, float]], prior: float):
        self.weights, self.edges, self.prior = weights, edges, prior
        self.measured = {(k, v): weights.get(f"m{k}:{v}", 0.0) for k in range(4) for v in range(12)}
        self.fixed: dict[tuple, float] = {}

    def evidence(self, node: Node, up: str, total: list[int]) -> float:
        """How much more likely the element's looks are if it is content (a ratio)."""
        key = node.tag, node.attrs, up
        if (base := self.fixed.get(key)) is None:
            if len(self.fixed) > 50_000:
                self.fixed.clear()
            base = self.fixed[key] = sum(self.weights.get(f, 0.0) for f in fixed_features(*key))
        base += sum(self.measured[k, v] for k, v in enumerate(measures(node, total)))
        return math.exp(max(-12.0, min(12.0, base))) * (1 - self.prior) / self.prior

    def marginals(self, nodes: list[Node]) -> list[float]:
        """Probability of content for every node: messages up, then down."""
        n = len(nodes)
        totals = _sums(nodes)
        own = [self.evidence(x, nodes[x.parent].tag if x.parent >= 0 else "", t) for x, t in zip(nodes, totals, strict=True)]
        for i, x in enumerate(nodes):
            if x.tag in UNSEEN:
                own[i] = 1e-9
        default = self.edges[""]
        edge = [self.edges.get(kind_of(x), default) for x in nodes]
        belief = own[:]  # ratio content : other, of the subtree
        message = [1.0] * n  # from a node to its parent, as such a ratio
        for i in range(n - 1, 0, -1):
            a, b = edge[i]  # P(content | parent content), P(content | parent other)
            r = min(belief[i], 1e12)
            message[i] = (a * r + 1 - a) / (b * r + 1 - b)
            up = nodes[i].parent
            belief[up] = min(1e12, max(1e-12, belief[up] * message[i]))
        prior = self.prior
        total = [belief[0] * prior / (1 - prior)] + [0.0] * (n - 1)
        for i in range(1, n):
            a, b = edge[i]
            without = total[nodes[i].parent] / message[i]  # all that the parent knows but from this child
            total[i] = belief[i] * (without * a + b) / (without * (1 - a) + 1 - b)
            total[i] = min(1e12, max(1e-12, total[i]))
        return [t / (1 + t) for t in total]

    def text(self, page: str) -> str:
        nodes, runs = parsed(page)
        p = self.marginals(nodes)
        return " ".join(run for at, run in runs if p[at] >= ACCEPT)


def neutral(nodes: list[Node]) -> list[Node]:
    """The page with telling tags as plain boxes."""
    return [Node("div" if x.tag in TELLING else x.tag, x.attrs, x.parent, x.label, x.seen, x.chars, x.linked, x.runs, x.marks, x.children)
            for x in nodes]


def fitted(pages: list[list[Node]]) -> Model:
    """Logistic weights and edge frequencies from trees whose nodes carry labels (None: not known, taken as no content)."""
    rows, labels, edges = [], [], {}
    for nodes in pages:
        totals = _sums(nodes)
        for x, total in zip(nodes[1:], totals[1:], strict=True):
            y = bool(x.label)
            rows.append([*fixed_features(x.tag, x.attrs, nodes[x.parent].tag), *(f"m{k}:{v}" for k, v in enumerate(measures(x, total)))])
            labels.append(y)
            for kind in ("", kind_of(x)):
                edges.setdefault(kind, [[1.0, 2.0], [0.2, 4.0]])[0 if nodes[x.parent].label else 1][0] += y
                edges[kind][0 if nodes[x.parent].label else 1][1] += 1
    names = {f: k for k, f in enumerate(sorted({f for r in rows for f in r}))}
    at = np.repeat(np.arange(len(rows)), [len(r) for r in rows])
    col = np.array([names[f] for r in rows for f in r], dtype=np.int64)
    y = np.array(labels, dtype=float)
    w, square = np.zeros(len(names)), np.full(len(names), 1e-6)
    for _ in range(EPOCHS if rows else 0):
        p = 1 / (1 + np.exp(-np.clip(np.bincount(at, w[col], len(rows)), -30, 30)))
        g = np.bincount(col, (p - y)[at], len(names)) / len(rows) + 1e-4 * w
        square += g * g
        w -= 0.3 * g / np.sqrt(square)
    shares = {kind: tuple(min(0.995, max(0.005, a / b)) for a, b in pair) for kind, pair in edges.items()} or {"": (0.9, 0.1)}
    return Model(dict(zip(names, w.tolist(), strict=True)), shares, min(0.9, max(0.1, float(y.mean()) if len(y) else 0.5)))


def labelled_pages(count: int = 240, seed: int = 11) -> list[str]:
    """Pages by rule: parts under their usual names around an article, marked as content (1) or not (0)."""
    rnd = random.Random(seed)

    def sentence(n: int) -> str:
        return (" ".join("x" * rnd.randint(2, 9) for _ in range(n)) + rnd.choice([".", ".", "!", "?", ""])).replace(" ", ", ", n // 12)

    def links(n: int, tag: str = "li") -> str:
        return "".join(f'<{tag}><a href="/{k}">{sentence(rnd.randint(1, 3))}</a></{tag}>' for k in range(n))

    def box(tag: str, name: str, mark: str, inner: str, role: str = "") -> str:
        name = name and rnd.choice([f' class="{name}"', f' id="{name.replace(" ", "-")}"', f' class="{name} box-{rnd.randint(1, 9)}"'])
        role = f' role="{role}"' if role and rnd.random() < 0.3 else ""
        return f"<{tag}{name}{role} {MARK}=\"{mark}\">{inner}</{tag}>"

    def paragraphs(n: int, most: int = 60) -> str:
        return "".join(f"<p>{sentence(rnd.randint(3, most))}{'<b>' + sentence(3) + '</b>' if rnd.random() < .2 else ''}</p>" for _ in range(n))

    def part(kind: str) -> str:
        tag, name = rnd.choice(OTHER_PARTS[kind])
        inner = {
            "menu": lambda: links(rnd.randint(3, 8)) if tag in ("ul", "ol") else f"<ul>{links(rnd.randint(3, 8))}</ul>",
            "header": lambda: rnd.choice([f"<h1>{sentence(3)}</h1>", f"<div>{sentence(2)}</div>", f"<p>{sentence(4)}</p>"]),
            "footer": lambda: rnd.choice([sentence(6), f"<p>{sentence(8)}</p>", f"<ul>{links(4)}</ul>{sentence(4)}"]),
            "side": lambda: rnd.choice([f"<h3>{sentence(2)}</h3><ul>{links(5)}</ul>", paragraphs(1, 20), sentence(9)]),
            "notice": lambda: rnd.choice([f"<p>{sentence(14)}</p><button>{sentence(1)}</button>", sentence(12), paragraphs(1, 30)]),
            "advert": lambda: rnd.choice([sentence(8), paragraphs(1, 15), f"<p>{sentence(6)}</p>"]),
            "form": lambda: f"<label>{sentence(2)}</label><input name=q><p>{sentence(7)}</p><button>{sentence(1)}</button>",
            "comments": lambda: "".join(rnd.choice([
                f'<div class="comment"><p>{sentence(rnd.randint(4, 40))}</p></div>', f"<li><p>{sentence(rnd.randint(4, 40))}</p></li>",
                f"<div><b>{sentence(1)}</b><p>{sentence(rnd.randint(4, 30))}</p></div>"]) for _ in range(rnd.randint(1, 5))),
            "share": lambda: f"<ul>{links(3)}</ul>",
        }[kind]()
        return box(tag, name, "0", inner, ROLES.get(kind, ""))

    pages = []
    for _ in range(count):
        body = f"<h1>{sentence(6)}</h1>" * (rnd.random() < 0.8)
        for _ in range(rnd.randint(1, 9)):
            body += rnd.choice([
                lambda: paragraphs(rnd.randint(1, 3)), lambda: paragraphs(1), lambda: f"<h2>{sentence(4)}</h2>" + paragraphs(1),
                lambda: f"<ul>{''.join(f'<li>{sentence(rnd.randint(2, 15))}</li>' for _ in range(3))}</ul>",
                lambda: f"<blockquote><p>{sentence(15)}</p></blockquote>", lambda: f"<section>{paragraphs(2)}</section>",
                lambda: f"<table><tr><td>{sentence(2)}</td><td>{sentence(3)}</td></tr></table>", lambda: f"<pre>{sentence(9)}</pre>",
                lambda: f"<figure><figcaption>{sentence(6)}</figcaption></figure>", lambda: f"<div>{paragraphs(2)}</div>"])()
            if rnd.random() < 0.12:
                body += part(rnd.choice(["advert", "side", "share", "form", "notice"]))
        if rnd.random() < 0.1:
            body += part("comments")
        tag, name = rnd.choice(CONTENT_PARTS)
        main = box(tag, name, "1", body)
        if rnd.random() < 0.3:
            main = f"<div>{main}{part('side')}</div>"
        before = [part(k) for k in ("notice", "menu", "header", "advert") if rnd.random() < 0.6]
        after = [part(k) for k in ("comments", "side", "form", "advert", "footer", "share") if rnd.random() < 0.6]
        rnd.shuffle(before)
        pages.append("".join(before) + main + "".join(after))
    return pages


def from_markup(page: str) -> list[Node] | None:
    """Labels by the page's own article element; None if it has not exactly one."""
    nodes, _ = parsed(page)
    named = [i for i, x in enumerate(nodes) if x.tag == "article"] or [i for i, x in enumerate(nodes) if x.tag == "main"]
    if len(named) != 1:
        return None
    other = {tag for parts in OTHER_PARTS.values() for tag, name in parts if not name}
    for i, x in enumerate(nodes[1:], 1):
        x.label = i == named[0] or bool(nodes[x.parent].label)
        if x.label and (x.tag in other or any(set(words_of(x.attrs)) == set(words_of(f'class="{n}"'))
                                              for parts in OTHER_PARTS.values() for _, n in parts if n)):
            x.label = False
    return nodes


def trained(pages: DataFrame, by: str = "page_id", html: str = "html", sample: int = SAMPLE) -> Model:
    """The model from pages by rule and from at most ``sample`` pages of the table."""
    trees = [parsed(p, MARK)[0] for p in labelled_pages()]
    for nodes in trees:
        for x in nodes:
            x.attrs = re.sub(rf'\s*{MARK}="[01]"', "", x.attrs)
    # the hashes alone are sorted, and only the pages at or below the last one leave their partitions
    hashed = pages.where(F.col(html).isNotNull()).select(F.xxhash64(by, html).alias("h"), html)
    least = hashed.select("h").distinct().orderBy("h").limit(sample).agg(F.max("h")).head()[0]
    chosen = sorted(r[0] for r in hashed.where(F.col("h") <= least).select(html).distinct().collect()) if least is not None else []
    own = [nodes for page in chosen[:sample] if (nodes := from_markup(page)) is not None]
    return fitted([*trees, *(neutral(t) for t in trees), *own, *(neutral(t) for t in own)])


def extracted(pages: DataFrame, model: Model, html: str = "html", keep: tuple[str, ...] = ("page_id", "url")) -> DataFrame:
    """``keep`` columns and ``text``, the main text."""
    data = pages.select(F.col(html).alias("_html"), *keep)
    sent = data.sparkSession.sparkContext.broadcast((model.weights, model.edges, model.prior))

    def make():
        own = Model(*sent.value)

        def each(page, *rest):
            yield (*(r.decode() if isinstance(r, bytes) else r for r in rest), own.text(page.decode()) if page else "")
        return each

    kinds = ", ".join(f"`{c}` {data.schema[c].dataType.simpleString()}" for c in keep)
    return map_rows(data, make, f"{kinds}, text string")
