"""Problem 5: the main body of a page among menus, notices, side columns, teasers and footers.

A page is read into a tree of elements (unclosed tags are closed by the next of
their kind).  Its leaves are the pieces: the text between two tags other than
those of running text.  Gradient-boosted trees over features of the DOM nodes
(density of text and links in the subtree, attribute tokens, tags, depth, place
and sibling statistics) score leaves and inner nodes; hierarchical decoding
then chooses, from the root down, whether a subtree is all body, no body or
mixed, so that no descendant contradicts its ancestor.

Defined results: null or empty html, framesets and server messages have no
body; whole pages are read; a page that comes twice gives its rows once.
"""

from __future__ import annotations

import html as _html
import json
import re
from collections.abc import Iterator
from functools import lru_cache
from importlib import resources
from itertools import accumulate

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession

from tapeloom.llm.spread import spread

# Tags of running text, of things that are never body, without content, and those that close their own kind.
INLINE = frozenset("a b i u em strong span font sup sub small".split())
DROPPED = re.compile(r"<!--.*?(?:-->|\Z)|<(script|style|noscript|title)\b[^>]*>.*?(?:</\1\s*>|\Z)|<!\[CDATA\[.*?\]\]>|<[!?][^>]*>", re.I | re.S)
TITLE = re.compile(r"<title\b[^>]*>(.*?)</title", re.I | re.S)
TAG = re.compile(r"<(/?)([A-Za-z][\w:-]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*)/?>")
VOID = frozenset("br hr img meta link input wbr area base col embed frame param source track".split())
SELF = {"p": {"p"}, "li": {"li"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "option": {"option"}}
#: An element of these kinds begins a scope in which an unclosed tag of SELF is looked for.
SCOPE = frozenset("table ul ol dl div article section main td body".split())
CLOSES_P = frozenset("p div table ul ol dl h1 h2 h3 h4 h5 h6 blockquote article section main header footer nav aside center hr form pre".split())
HREF = re.compile(r"href\s*=\s*[\"']?([^\"'\s>]*)", re.I)
ATTR = re.compile(r"(?:class|id)\s*=\s*[\"']?([^\"'>]*)", re.I)
DIGITS = re.compile(r"\d")
LETTERS = re.compile(r"[^\W_]+")
# Attribute tokens by what they tell.
ATTRIBUTES = [re.compile(p, re.I) for p in (r"menu|nav|breadcrumb", r"content|article|main|body|text|entry|post", r"foot|bottom|copy", r"side|widget|related|links|teaser|aside", r"head|top|logo|banner", r"author|byline|title", r"cookie|notice|popup|dialog|consent")]
TAGS = ["body", "div", "p", "li", "td", "h1", "h2", "h3", "h4", "blockquote", "br", "hr", "article", "main", "section", "aside", "header", "footer", "nav", "dialog", "center", "table", "ul", "tr"]
TAG_AT = {t: i + 1 for i, t in enumerate(TAGS)}
# Words of site furniture; a wrongly decoded page has none of them and is judged by its structure.
FURNITURE = tuple(
    "cookie|куки|© |все права|rights reserved|alle rechte|сайт работает|счётчик|последнее обновление|last updated|letzte änderung|дизайн и поддержка|нашли ошибку|при перепечатке|nachdruck nur|reprint|популярное|новые поступления|читайте также|lesen sie auch|read also|see also|поделиться|теги|похожие|комментарии закрыты|случайное фото|назад к списку|версия для печати|подпишитесь|реклама|newsletter|ähnliche|teilen|share|tags|related|popular|kommentare|comments|druckversion|print version|zurück|back to|werbung|advert|zufallsbild|random photo|neu im|new arrivals|настройк|datenschutz|privacy|сторонних|подписк|обезличенн".split("|")
)


def is_furniture(text: str) -> bool:
    low = text.lower()
    for s in FURNITURE:
        if s in low:
            return True
    return False


PROSE_END = re.compile(r"[.!?…»\")\]]\s*\Z")


class Node:
    __slots__ = ("tag", "attrs", "up", "children", "depth", "leaf", "chars", "linked", "sited", "pieces", "first", "order", "score")

    def __init__(self, tag: str, attrs: str, up: Node | None) -> None:
        self.tag, self.attrs, self.up = tag, attrs, up
        self.children: list[Node] = []
        self.depth = up.depth + 1 if up else 0
        self.leaf: Leaf | None = None
        self.chars = self.linked = self.sited = self.pieces = 0
        self.first = -1


class Leaf:
    __slots__ = ("text", "key", "node", "chars", "linked", "sited", "bold", "before", "ahead", "index")

    def __init__(self, text: str, node: Node, linked: int, sited: int, bold: bool, before: str) -> None:
        self.text, self.node, self.linked, self.sited, self.bold, self.before = text, node, linked, sited, bold, before
        self.ahead = ""
        self.chars = len(text)
        self.key = "".join(LETTERS.findall(text))[:40]


def unescape(x: str) -> str:
    return _html.unescape(x) if "&" in x else x


def key_of(text: str) -> str:
    return "".join(LETTERS.findall(unescape(text)))[:40]


def parse(page: str) -> tuple[str, Node, list[Leaf]]:
    """(title, root, leaves with any letter or digit)."""
    t = TITLE.search(page)
    title = re.sub(r"\s+", " ", unescape(t.group(1))).strip() if t else ""
    page = DROPPED.sub(lambda m: f"<{m.group(1)}/>" if m.group(1) else "", page)
    root = Node("body", "", None)
    node, leaves = root, []
    text: list[str] = []
    linked = sited = 0
    link = site = bold = any_bold = False
    before, at = "", 0

    def flush(after: str) -> None:
        nonlocal text, linked, sited, any_bold, before
        if text:
            whole = re.sub(r"\s+", " ", unescape("".join(text))).strip()
            if whole:
                leaf = Leaf(whole, Node("#", "", node), linked, sited, any_bold, before)
                if leaf.key:
                    leaf.ahead = after
                    node.children.append(leaf.node)
                    leaf.node.leaf = leaf
                    leaves.append(leaf)
            text, linked, sited, any_bold = [], 0, 0, bold
        before = after

    for m in TAG.finditer(page):
        if m.start() > at:
            x = page[at : m.start()]
            if not x.isspace():
                text.append(x)
                if link:
                    linked += len(x)
                    sited += len(x) * site
                any_bold = any_bold or bold
            elif text:
                text.append(" ")
        at = m.end()
        close, tag, attrs = m.group(1), m.group(2).lower(), m.group(3)
        if tag in INLINE:
            if tag == "a":
                link = not close
                h = HREF.search(attrs) if link else None
                site = bool(h and (h.group(1).startswith(("/", "#", "http")) or h.group(1) == ""))
            elif tag in ("b", "strong", "font"):
                bold = not close
            continue
        flush(tag)
        if close:
            n = node
            while n is not root and n.tag != tag:
                n = n.up
            if n is not root:
                node = n.up
            link = False
            continue
        if tag in VOID or tag in ("html", "head", "body", "script", "style", "noscript", "title", "thead", "tbody"):
            continue
        if tag in CLOSES_P and node.tag == "p":
            node = node.up
        if tag in SELF:
            n = node
            while n is not root and n.tag not in SELF[tag] and n.tag not in SCOPE - SELF[tag]:
                n = n.up
            if n is not root and n.tag in SELF[tag]:
                node = n.up
        child = Node(tag, attrs, node)
        node.children.append(child)
        node = child
    if at < len(page) and page[at:].strip():
        text.append(page[at:])
    flush("")
    return title, root, leaves


def nodes_of(root: Node) -> list[Node]:
    """All nodes, parents first, with the sums of their subtrees."""
    out, i = [root], 0
    while i < len(out):
        out.extend(out[i].children)
        i += 1
    for k in range(len(out) - 1, -1, -1):
        n = out[k]
        if n.leaf:
            n.chars, n.linked, n.sited, n.pieces = n.leaf.chars, n.leaf.linked, n.leaf.sited, 1
        if n.up:
            n.up.chars += n.chars
            n.up.linked += n.linked
            n.up.sited += n.sited
            n.up.pieces += n.pieces
    return out


FEATURES = 40
_HOMES = frozenset("td article main section".split())


def home_of(headline: Leaf) -> Node:
    """The element that a headline opens: the nearest around it that holds more than the headline."""
    m = headline.node.up
    while m.up is not None and m.tag not in _HOMES and (m.pieces < 2 or m.tag in ("h1", "h2", "h3", "h4", "h5", "p", "center", "header", "li")):
        m = m.up
    return m


_SIZE, _SHARE, _COUNT = (8, 16, 24, 40, 60, 90, 140, 220, 400, 800, 1600), (0.02, 0.15, 0.35, 0.6, 0.85, 0.97), (1, 2, 3, 4, 6, 9, 14, 22, 40)
#: How a column of raw features is binned; None: it is a small whole number already.
_EDGES = [None, None, None, None, _SIZE, _SHARE, _SHARE, _SHARE, _COUNT, None, None, None, None, _COUNT, _COUNT, _COUNT, _COUNT, _COUNT, _COUNT, _COUNT, _COUNT, _SHARE, _SHARE, _SIZE, _COUNT, None, None, None, None, _COUNT, None, None, _COUNT, _COUNT, None, None, None, _SHARE, None, None]


def binned(rows: list[tuple]) -> np.ndarray:
    raw = np.array(rows, np.float32).reshape(-1, FEATURES)
    out = np.empty(raw.shape, np.uint8)
    for k, e in enumerate(_EDGES):
        out[:, k] = np.minimum(raw[:, k], 127) if e is None else np.searchsorted(np.array(e, np.float32), raw[:, k], side="right")
    return out


@lru_cache(20_000)
def _told(attrs: str) -> int:
    a = ATTR.findall(attrs)
    return sum(1 << i for i, p in enumerate(ATTRIBUTES) if any(p.search(x) for x in a)) if a else 0


def features(title: str, root: Node, leaves: list[Leaf]) -> tuple[list[tuple], list[Node]]:
    """(raw features of every node with text, those nodes); leaves among them in the order of the page."""
    nodes = [n for n in nodes_of(root) if n.pieces]
    for i, leaf in enumerate(leaves):
        leaf.index = i
    own = re.sub(r"\s*(?:[—|·«»]|::|\s-\s)\s*[\w.\-]+\.\w+\s*\Z", "", title)
    head_key = key_of(own)
    heads = [i for i, x in enumerate(leaves) if head_key and (x.key == head_key or len(head_key) >= 20 and x.key.startswith(head_key[:30]))]
    head = next((i for i in heads if leaves[i].sited * 2 <= leaves[i].chars), heads[0] if heads else -1)
    guess = head if head >= 0 else next((i for i, x in enumerate(leaves) if x.node.up.tag in ("h1", "h2") and not x.sited), -1)
    home = home_of(leaves[guess]) if guess >= 0 else None
    furn = [is_furniture(x.text) for x in leaves]
    hot = [f or x.sited * 2 > x.chars for f, x in zip(furn, leaves, strict=True)]
    n = len(leaves)
    # pieces since and until the next piece that looks like furniture or a site link
    since, until = [0] * n, [0] * n
    k = 99
    for i in range(n):
        k = 0 if hot[i] else k + 1
        since[i] = k
    k = 99
    for i in range(n - 1, -1, -1):
        k = 0 if hot[i] else k + 1
        until[i] = k
    # site matter met since the headline: in flat pages the body ends at the first
    ended, e = [0] * n, 0
    rules = 0
    ruled = [0] * n
    for i in range(n):
        if guess >= 0 and i > guess:
            e += hot[i]
            rules += leaves[i].before == "hr" or leaves[i - 1].ahead == "hr"
        ended[i], ruled[i] = e, rules
    spans: dict[int, tuple[int, int]] = {}
    for m in reversed(nodes):  # children come after their parents: one fold upwards
        if m.leaf:
            a, b = spans.get(id(m), (m.leaf.index, m.leaf.index))
            spans[id(m)] = (min(a, m.leaf.index), max(b, m.leaf.index))
        if m.up is not None and id(m) in spans:
            a, b = spans[id(m)]
            c, d = spans.get(id(m.up), (a, b))
            spans[id(m.up)] = (min(a, c), max(b, d))
    upto = list(accumulate(furn, initial=0))
    out: list[tuple] = []
    kin: dict[int, dict[str, int]] = {}
    above: dict[int, tuple[int, int]] = {}
    total = max(1, root.chars)
    for m in nodes:
        a, b = spans[id(m)]
        leaf = m.leaf
        up = m.up or m
        tags = kin.get(id(up))
        if tags is None:
            tags = kin[id(up)] = {}
            for c in up.children:
                tags[c.tag] = tags.get(c.tag, 0) + 1
        told = _told(m.attrs) if m.attrs else 0
        # attribute tokens of all ancestors, and whether the headline's element is among them (parents come first)
        chain, inside = above.get(id(m.up), (0, 0)) if m.up else (0, 0)
        chain |= told
        above[id(m)] = (chain, 1 if inside or m is home else 0)
        inside = 2 if m is home else inside
        c = max(1, m.chars)
        text = leaf.text if leaf else ""
        mid = guess if guess >= 0 else -1
        out.append((
            1 if leaf else 0, TAG_AT.get(m.tag if not leaf else up.tag, 0), TAG_AT.get((up.up or up).tag if leaf else up.tag, 0), min(m.depth, 15),
            m.chars, m.linked / c, m.sited / c, m.chars / total, m.pieces,
            told & 127, chain & 127, inside, 0 if mid < 0 else 1 if b < mid else 2 if a == mid else 3 if a > mid else 4,
            abs(a - mid) if mid >= 0 else 15, ended[a], ended[b], ruled[a], since[a], until[b],
            tags.get(m.tag, 0), len(up.children), up.linked / max(1, up.chars), up.sited / max(1, up.chars), up.chars, up.pieces,
            int(furn[a]), int(upto[b + 1] > upto[a]), int(leaf.bold) if leaf else 0, int(bool(PROSE_END.search(text))) if leaf else 2, text.count(" ") if leaf else 15,
            TAG_AT.get(leaf.before, 0) if leaf else 30, TAG_AT.get(leaf.ahead, 0) if leaf else 30, n - b, a, int(hot[a - 1]) if a else 2, int(hot[b + 1]) if b + 1 < n else 2,
            int(leaves[a - 1].sited > 0) if a else 2, len(DIGITS.findall(text)) / c if leaf else 9, int("©" in text or "|" in text or "::" in text) if leaf else 2, int(guess == head) if guess >= 0 else 2,
        ))
    return out, nodes


class Trees:
    """Boosted trees as complete binary trees: at each inner node go right where feature > cut."""

    def __init__(self, depth: int, feature: np.ndarray, cut: np.ndarray, value: np.ndarray, base: float) -> None:
        self.depth, self.feature, self.cut, self.value, self.base = depth, feature, cut, value, base

    def margin(self, x: np.ndarray) -> np.ndarray:
        out = np.full(len(x), self.base, np.float64)
        rows = np.arange(len(x))
        for f, c, v in zip(self.feature, self.cut, self.value, strict=True):
            at = np.zeros(len(x), np.int64)
            for _ in range(self.depth):
                at = 2 * at + 1 + (x[rows, f[at]] > c[at])
            out += v[at - (2**self.depth - 1)]
        return out

    @staticmethod
    @lru_cache(1)
    def load() -> Trees:
        m = json.loads(resources.files("tapeloom.llm.models").joinpath("dom.json").read_text())
        return Trees(m["depth"], np.array(m["feature"]), np.array(m["cut"]), np.array(m["value"]), m["base"])


#: What the score of an inner node weighs against the sum of its pieces, and the price of a mixed one.
NODE_WEIGHT, MIXED = 0.5, 0.2


def decode(nodes: list[Node], margin: np.ndarray) -> set[int]:
    """Ids of the leaves that are body: per subtree all, none or mixed, whichever the scores support most."""
    inn, out, best, how = {}, {}, {}, {}
    s = np.clip(margin, -6, 6)
    log_in, log_out = -np.logaddexp(0, -s), -np.logaddexp(0, s)
    for m, li, lo in zip(reversed(nodes), log_in[::-1].tolist(), log_out[::-1].tolist(), strict=True):
        k = id(m)
        if m.leaf:
            inn[k], out[k] = li, lo
            best[k], how[k] = (li, "in") if li > lo else (lo, "out")
            continue
        kids = [id(c) for c in m.children if c.pieces]
        inn[k] = sum(inn[c] for c in kids) + NODE_WEIGHT * li
        out[k] = sum(out[c] for c in kids) + NODE_WEIGHT * lo
        mixed = sum(best[c] for c in kids) - MIXED
        best[k], how[k] = max((inn[k], "in"), (out[k], "out"), (mixed, "mixed"))
    body: set[int] = set()
    state = {id(nodes[0]): how[id(nodes[0])]}
    for m in nodes:  # parents first
        h = state[id(m)]
        if m.leaf and h == "in":
            body.add(id(m.leaf))
        for c in m.children:
            if c.pieces:
                state[id(c)] = how[id(c)] if h == "mixed" else h
    return body


def body_pieces(pages: list[str | None], trees: Trees) -> list[list[Leaf]]:
    """The leaves that are body, for each page: all pages of a batch are scored at once."""
    found, rows, at = [], [], 0
    for p in pages:
        if not p or not p.strip():
            found.append(None)
            continue
        title, root, leaves = parse(p)
        if not leaves:
            found.append(None)
            continue
        x, nodes = features(title, root, leaves)
        found.append((leaves, nodes, at, at + len(x)))
        rows += x
        at += len(x)
    margin = trees.margin(binned(rows)) if rows else np.zeros(0)
    out: list[list[Leaf]] = []
    for f in found:
        if f is None:
            out.append([])
            continue
        leaves, nodes, a, b = f
        body = decode(nodes, margin[a:b])
        out.append([x for x in leaves if id(x) in body])
    return out


def _batches(batches: Iterator[pa.RecordBatch], whole: bool) -> Iterator[pa.RecordBatch]:
    trees = Trees.load()
    for b in batches:
        for at in range(0, b.num_rows, 128):
            p = b.slice(at, 128)
            got = body_pieces(p.column(1).to_pylist(), trees)
            ids = p.column(0).to_pylist()
            if whole:
                yield pa.RecordBatch.from_arrays([p.column(0), pa.array(["\n".join(x.text for x in g) or None for g in got], pa.string())], ["page_id", "body"])
                continue
            pairs = [(i, k) for i, g in zip(ids, got, strict=True) for k in dict.fromkeys(x.key for x in g)]
            yield pa.RecordBatch.from_arrays([pa.array([i for i, _ in pairs], pa.int64()), pa.array([k for _, k in pairs], pa.string())], ["page_id", "para_key"])


def bodies(pages: DataFrame) -> DataFrame:
    """page_id, body: the main body's pieces, one a line; null where there is none."""
    return spread(pages.select("page_id", "html")).mapInArrow(lambda b: _batches(b, True), "page_id bigint, body string")


def p5_bodies(spark: SparkSession, d: str) -> DataFrame:
    return bodies(spark.read.parquet(f"{d}/rkka.parquet"))


def p5_found(spark: SparkSession, d: str) -> DataFrame:
    pages = spark.read.parquet(f"{d}/rkka.parquet").filter("page_id is not null and html is not null").select("page_id", "html")
    return spread(pages).mapInArrow(lambda b: _batches(b, False), "page_id bigint, para_key string")
