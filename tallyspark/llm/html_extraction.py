"""Main-text extraction with a tree-structured graphical model over the DOM.

Every element is a node with a hidden label: content, boilerplate, or frame (an element around the
content that isn't content itself, such as the body).  Potentials: how likely a
label is for a node of this tag under the parent's label, and how likely the node's features
(words of its class, id and role, link density, text length, sentence marks) are under each label.  Messages are passed
from the leaves up and from the root down (sum-product), which gives the exact probability of
each node being content.  A block of text is part of the result when its node's marginal is above
one half and no node above it is a certain non-text element (script, style, form control ...).

All potentials are counted, with additive smoothing, from labelled pages
(``labelled_pages.PAGES``: whole pages whose content elements carry a mark that is removed before
features are taken; the frame is what has content below it).  The counts are a small table of fixed size; nothing is fitted on the input.

Defined results: NULL or empty html gives an empty text; broken markup (unclosed, crossing or
stray tags) is read the way browsers do for the common cases; repeated rows each give a row; an
empty table gives an empty result; extra columns are ignored.
"""

from __future__ import annotations

import math
import re
from collections import defaultdict
from collections.abc import Iterator
from functools import lru_cache
from html.parser import HTMLParser
from itertools import islice

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

# Fixed values of the markup language
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
SILENT = frozenset(("script style noscript template head title svg math canvas iframe object select "
                    "button input textarea datalist audio video map").split())
BLOCK = frozenset(("html body address article aside blockquote center dd details dialog dir div dl dt "
                   "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr legend li "
                   "main menu nav ol p pre search section summary table caption thead tbody tfoot tr td "
                   "th ul").split())
CLOSES_P = BLOCK - set("html body tr td th thead tbody tfoot caption legend figcaption summary".split())
# An open element that a tag closes when it stands inside the given scope.
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"},
            "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"},
            "thead": {"tr", "td", "th"}, "tbody": {"tr", "td", "th", "thead"}, "tfoot": {"tr", "td", "th", "tbody"}}
SCOPE = {"li": {"ul", "ol", "menu", "dir"}, "dt": {"dl"}, "dd": {"dl"}, "option": {"select", "datalist"}}
TABLE_SCOPE = {"table"}
OUTSIDE = frozenset("html head body frameset".split())     # elements that no body is opened for
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())

GENERIC = frozenset(("div", "section"))
MARK = "data-content"        # attribute of labelled pages: "1" content, "0" boilerplate
NAME_WORD = re.compile(r"[A-Z]?[a-z]+|[A-Z]+(?![a-z])")
MOST_MARKS = 2               # more sentences than this say nothing more
SENTENCE = re.compile(r"[.!?。！？…](?:\s|$)")


class Node:
    __slots__ = ("tag", "attrs", "parent", "children", "parts", "chars", "link_chars", "links", "marks", "own")

    def __init__(self, tag: str, attrs: dict, parent):
        self.tag, self.attrs, self.parent = tag, attrs, parent
        self.children: list[Node] = []
        self.parts: list = []          # text and child nodes in page order
        self.chars = self.link_chars = self.links = self.marks = self.own = 0


class TreeBuilder(HTMLParser):
    """A DOM of the page: implied ends of paragraphs, items and cells, stray ends dropped."""

    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.root = Node("#root", {}, None)
        self.open = [self.root]
        self.in_head = False

    def _pop_to(self, depth: int) -> None:
        del self.open[depth:]

    def handle_starttag(self, tag, attrs):
        if self.in_head and tag in BLOCK:      # a head that is left open ends here
            self._close("head")
            self.in_head = False
        self.in_head = self.in_head or tag == "head"
        if tag in CLOSES_P:
            self._close("p", BLOCK - {"p"})
        if tag in SIBLINGS:
            scope = SCOPE.get(tag, TABLE_SCOPE)
            for other in SIBLINGS[tag]:
                self._close(other, scope)
        if tag in HEADINGS and self.open[-1].tag in HEADINGS:
            self.open.pop()
        if tag in ("html", "body") and any(n.tag == tag for n in self.open):
            return
        if tag not in OUTSIDE:
            self._in_body()
        parent = self.open[-1]
        node = Node(tag, {k: v or "" for k, v in attrs}, parent)
        parent.children.append(node)
        parent.parts.append(node)
        if tag not in VOID:
            self.open.append(node)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)

    def _close(self, tag: str, scope=frozenset()) -> None:
        """End the innermost open ``tag`` unless an element of ``scope`` is open inside it."""
        for depth in range(len(self.open) - 1, 0, -1):
            name = self.open[depth].tag
            if name == tag:
                self._pop_to(depth)
                return
            if name in scope:
                return

    def handle_endtag(self, tag):
        if tag in VOID:
            return
        # an inline element doesn't end the blocks opened inside it: its end is only noted
        if tag not in BLOCK and tag not in SILENT:
            for depth in range(len(self.open) - 1, 0, -1):
                name = self.open[depth].tag
                if name == tag:
                    self._pop_to(depth)
                    return
                if name in BLOCK:
                    return
            return
        # the end of a container ends what is open in it; the end of a paragraph stays inside
        self._close(tag, frozenset() if tag != "p" else BLOCK - {"p"})

    def _in_body(self) -> None:
        """What stands outside of every element is in the body, as in browsers."""
        if self.open[-1].tag in ("#root", "html"):
            body = next((n for n in self.open[-1].children if n.tag == "body"), None)
            if body is None:
                body = Node("body", {}, self.open[-1])
                self.open[-1].children.append(body)
                self.open[-1].parts.append(body)
            self.open.append(body)

    def handle_data(self, data):
        if not data.isspace():
            self._in_body()
        self.open[-1].parts.append(data)

    def unknown_decl(self, data):
        """Marked sections are no text."""


def parse(html: str) -> Node:
    builder = TreeBuilder()
    builder.feed(html)
    builder.close()
    return builder.root


def in_order(root: Node) -> list[Node]:
    """All nodes, parents before children, without recursion (pages can nest deeply)."""
    nodes, todo = [], [root]
    while todo:
        node = todo.pop()
        nodes.append(node)
        todo.extend(reversed(node.children))
    return nodes


def measure(nodes: list[Node]) -> None:
    for node in reversed(nodes):
        if node.tag in SILENT:
            node.chars = node.link_chars = 0
            continue
        own = "".join(p for p in node.parts if isinstance(p, str))
        if own and not own.isspace():
            node.own = sum(map(len, own.split()))
            node.chars += node.own
            node.marks += sum(1 for _ in islice(SENTENCE.finditer(own), MOST_MARKS))
        if node.tag == "a":
            node.link_chars = node.chars
            node.links += 1
        up = node.parent
        if up is not None:
            up.chars += node.chars
            up.link_chars += node.link_chars
            up.links += node.links
            up.marks += node.marks


def features(node: Node) -> list[str]:
    out = []
    for key in ("class", "id", "role", "aria-label", "itemprop"):
        for word in NAME_WORD.findall(node.attrs.get(key, "")):
            out.append("name=" + word.lower())
    if node.tag in GENERIC:         # boilerplate in a container without a meaning of its own mostly has a name
        out.append("bare=" + ("no" if out else "yes"))
    if "hidden" in node.attrs or "display:none" in node.attrs.get("style", "").replace(" ", "").lower():
        out.append("hidden")
    if node.tag in BLOCK and not any(c.tag in BLOCK for c in node.children):
        out.append("length=" + str(min(4, len(str(node.chars)) if node.chars else 0)))
        share = 10 * node.link_chars // node.chars if node.chars else 0
        out.append("links=" + ("none" if not node.links else "few" if share < 3 else "half" if share < 7 else "most"))
        out.append("sentences=" + str(min(MOST_MARKS, node.marks)))
    elif node.tag in BLOCK:         # text of its own between the blocks in it
        out.append("own=" + str(min(3, len(str(node.own)) if node.own else 0)))
    return out


BOILERPLATE, CONTENT, FRAME = LABELS = (0, 1, 2)
SMOOTHING = 0.1              # added to each feature's count
SIZES = frozenset(("length", "links", "sentences", "own"))


class Model:
    """Counted potentials, as logarithms."""

    def __init__(self, pages: list[str]):
        edge = defaultdict(int)        # by (tag, label of the parent, label)
        seen: dict[str, list[int]] = defaultdict(lambda: [0] * len(LABELS))
        kinds: dict[str, set] = defaultdict(set)
        roots = [SMOOTHING] * len(LABELS)
        groups = [defaultdict(int) for _ in LABELS]
        for html in pages:
            root = parse(html)
            nodes = in_order(root)
            measure(nodes)
            label = {id(root): BOILERPLATE}
            for node in nodes[1:]:
                mark = node.attrs.pop(MARK, None)
                label[id(node)] = int(mark) if mark in ("0", "1") else label[id(node.parent)]
            for node in reversed(nodes[1:]):
                if label[id(node)] and not label[id(node.parent)]:
                    label[id(node.parent)] = FRAME
            for node in nodes[1:]:
                y, up = label[id(node)], label[id(node.parent)]
                edge[None, up, y] += 1
                edge[node.tag, up, y] += 1
                for f in features(node):
                    kind = f.partition("=")[0]
                    seen[f][y] += 1
                    kinds[kind].add(f)
                    groups[y][kind] += kind != "name"
                groups[y]["name"] += 1         # a node has a name or not; every node counts
            roots[label[id(root)]] += 1
        # smoothed towards the counts of all tags, which also serve a tag never seen
        def total(t, u):
            return sum(edge[t, u, y] for y in LABELS)
        share = [[(edge[None, u, y] + SMOOTHING) / (total(None, u) + SMOOTHING * len(LABELS))
                  for y in LABELS] for u in LABELS]
        self.edges = {t: [[math.log((edge[t, u, y] + share[u][y]) / (total(t, u) + 1))
                           for y in LABELS] for u in LABELS] for t in {k[0] for k in list(edge)}}
        self.root = [math.log(n / sum(roots)) for n in roots]

        def smoothed(n: int, kind: str, y: int) -> float:
            values = 1 if kind == "name" else len(kinds[kind])
            return math.log((n + SMOOTHING) / (groups[y][kind] + SMOOTHING * (values + 1)))

        self.feature = {f: tuple(smoothed(n[y], f.partition("=")[0], y) for y in LABELS)
                        for f, n in seen.items()}
        # a name never seen says nothing; an unseen size has the smoothed zero count
        self.unseen = {k: tuple(smoothed(0, k, y) for y in LABELS) for k in list(kinds) if k != "name"}

    def edge(self, node: Node) -> list[list[float]]:
        """[label of the parent][label]"""
        return self.edges.get(node.tag) or self.edges[None]

    def unary(self, node: Node) -> list[float]:
        if node.parent is None:
            return list(self.root)
        # sizes of siblings repeat each other: together they count as one observation
        one = 1 / max(1, len(node.parent.children))
        out = [0.0] * len(LABELS)
        for f in features(node):
            kind = f.partition("=")[0]
            w = self.feature.get(f) or self.unseen.get(kind)
            if w:
                weight = one if kind in SIZES else 1.0
                for y in LABELS:
                    out[y] += weight * w[y]
        return out

    def marginals(self, nodes: list[Node]) -> dict[int, float]:
        """P(content) of each node by sum-product: up from the leaves, then down."""
        own = {id(node): self.unary(node) for node in nodes}
        up, belief, out = {}, {}, {}
        for node in reversed(nodes):      # message of the node to its parent
            if node.parent is None:
                continue
            e, a = self.edge(node), own[id(node)]
            to = up[id(node)] = [log_sum([e[u][y] + a[y] for y in LABELS]) for u in LABELS]
            above = own[id(node.parent)]
            for u in LABELS:
                above[u] += to[u]
        for node in nodes:                # own now holds the evidence of the whole subtree
            a = own[id(node)]
            if node.parent is not None:
                p, m, e = belief[id(node.parent)], up[id(node)], self.edge(node)
                a = [a[y] + log_sum([p[u] - m[u] + e[u][y] for u in LABELS]) for y in LABELS]
            belief[id(node)] = a
            out[id(node)] = math.exp(a[CONTENT] - log_sum(a))
        return out


def log_sum(values: list[float]) -> float:
    """log of the sum of exponentials"""
    top = max(values)
    return top + math.log(sum([math.exp(v - top) for v in values]))


@lru_cache(maxsize=1)
def trained() -> Model:
    from tallyspark.llm.labelled_pages import PAGES
    return Model(PAGES)


def main_text(html: str | None, model: Model | None = None) -> str:
    if not html:
        return ""
    model = model or trained()
    root = parse(html)
    nodes = in_order(root)
    measure(nodes)
    p = model.marginals(nodes)
    if all(n.tag in ("#root", "html", "body") for n in nodes):      # text without any element in it
        return " ".join(" ".join(t for n in nodes for t in n.parts if isinstance(t, str)).split())
    blocks, current = [], []

    def end_block() -> None:
        text = " ".join("".join(current).split())
        if text:
            blocks.append(text)
        current.clear()

    # page order: a text belongs to the nearest block element, whose marginal decides
    todo: list = [(root, False)]
    while todo:
        item, keep = todo.pop()
        if item is None:
            end_block()
        elif isinstance(item, str):
            if keep:
                current.append(item)
        elif item.tag not in SILENT:
            block = item.tag in BLOCK
            if block:
                end_block()
                keep = p[id(item)] > 0.5
                todo.append((None, False))
            elif item.tag == "br":
                current.append(" ")
            todo.extend((part, keep) for part in reversed(item.parts))
    end_block()
    return "\n".join(blocks)


def extract(pages: DataFrame, id_col: str = "page_id", url_col: str = "url",
            html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars."""
    rows = pages.select(F.col(id_col).alias("page_id"), F.col(url_col).alias("url"),
                        F.col(html_col).alias("html"))
    types = {f.name: f.dataType.simpleString() for f in rows.schema}

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = trained()
        for b in batches:
            for at in range(0, b.num_rows, 256):
                part = b.slice(at, 256)
                texts = [main_text(h, model) for h in part.column("html").to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [part.column("page_id"), part.column("url"), pa.array(texts, pa.string()),
                     pa.array(map(len, texts), pa.int64())], ["page_id", "url", "text", "n_chars"])

    return rows.mapInArrow(run, f"page_id {types['page_id']}, url {types['url']}, text string, n_chars long")


def op9_html_extraction(spark: SparkSession, sf_dir: str) -> DataFrame:
    pages = spark.read.parquet(f"{sf_dir}/pages.parquet").select("page_id", "url", "html")
    return extract(pages)
