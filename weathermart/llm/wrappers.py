"""Main text of web pages by wrappers that are induced from the pages of each host.

A page is parsed to a tree of its block elements. Runs of equal siblings are folded, so a tree
is small and pages of one layout have the same one. Per host the commonest tree is the
reference; every other distinct tree is aligned with it by simple tree matching. Texts of
aligned nodes are compared over all pages of the host: a node whose text stays the same (or
rotates among a few) belongs to the template, and what varies is content. Parts that elements,
roles and class names declare as menus, headers, footers, sidebars, notices, adverts, forms,
scripts, styles or reader comments are no content anywhere, so that hosts with a single page
or with varying menus are read too. Where a page has an article (else a main element), only
that is content.

Evidence is counted over page titles, not pages: copies of one article say nothing about a
template. Inside an article a node needs ten titles and 95 % agreement, elsewhere three and
90 %; outside articles a node of 20 or more titles with at most a tenth as many texts rotates.

Pages are parsed once, in tasks; trees, votes and templates are joined and counted by Spark with
digests instead of texts. No host is gathered anywhere.

Defined results: null and empty html give an empty text; pages without a url, or whose url has
no host, are read without a wrapper; repeated rows come back as often. Other columns are
ignored. Elements nested deeper than ``MAX_DEPTH`` belong to the element at that depth.
"""

from __future__ import annotations

import functools
import html as charrefs
import re
from collections.abc import Iterable, Iterator
from dataclasses import dataclass, field
from itertools import chain

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from weathermart.sources.paths import materialize

# Elements that start and end a block of text.
BLOCKS = frozenset(
    "address article aside blockquote body caption center dd details dialog dir div dl dt "
    "fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr html legend li main "
    "menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul".split()
)
# Elements without content, and elements whose content is not markup.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea iframe noembed noframes xmp".split())
# Elements, roles and class words of parts that are not main text.
FURNITURE_TAGS = frozenset(
    "head script style title textarea iframe noembed noframes noscript template svg canvas object "
    "audio video map nav footer aside form fieldset button select datalist dialog menu search".split()
)
FURNITURE_ROLES = frozenset(
    "navigation banner contentinfo complementary search dialog alert alertdialog form menu menubar "
    "toolbar tablist".split()
)
FURNITURE_WORDS = frozenset(
    "ad ads advert adverts advertisement advertisements advertising adsense sponsor sponsored "
    "sponsors promo promos promotion banner cookie cookies consent gdpr notice notices popup modal "
    "overlay newsletter subscribe subscription signup login menu menus nav navbar navigation "
    "breadcrumb breadcrumbs sidebar sidebars widget widgets footer masthead toolbar topbar share "
    "sharing social comment comments disqus respond reply replies related recommended "
    "recommendations pagination pager skip".split()
)
HEADER_WORDS = frozenset({"header", "site-header", "page-header", "topheader"})
# Words that say what a page has or lacks, not what an element is.
_STATES = frozenset("has have with no not non without is free".split())
# A start tag on the left closes these open elements, up to those on the right.
_P_SCOPE = ({"p"}, {"td", "th", "caption", "button", "object"})
_IMPLIED = {
    "li": ({"li"}, {"ul", "ol", "menu", "dir"}),
    "dt": ({"dt", "dd"}, {"dl"}),
    "dd": ({"dt", "dd"}, {"dl"}),
    "tr": ({"tr"}, {"table"}),
    "td": ({"td", "th"}, {"tr", "table"}),
    "th": ({"td", "th"}, {"tr", "table"}),
    "option": ({"option"}, {"select", "datalist", "optgroup"}),
}
MAX_DEPTH = 120

# Evidence for a template node: titles and agreement, inside an article and elsewhere; and how
# many titles and which share of different texts a rotating node has.
INSIDE, OUTSIDE = (10, 0.95), (3, 0.9)
ROTATING = (20, 0.1)

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|</?[a-zA-Z][^\s/>]*+(?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+>"
    r"|</?[a-zA-Z][^>]*+(?:>|\Z)",
    re.DOTALL,
)
_NAME = re.compile(r"</?([a-zA-Z][^\s/>]*)")
_ATTRIBUTE = re.compile(r"(?<=[\s\"'/])(class|id|role|itemprop|hidden|style|aria-hidden)\b(?:\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+))?", re.I)
_WORD = re.compile(r"[a-z]+")
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")


@dataclass(slots=True)
class Node:
    """A block element; ``texts`` are the numbers of the blocks that lie directly in it."""

    label: str
    parent: Node | None = None
    depth: int = 0
    children: list[Node] = field(default_factory=list)
    texts: list[int] = field(default_factory=list)


@dataclass(slots=True)
class Page:
    root: Node
    blocks: list[str]
    kept: list[bool]  # by block: no furniture
    inside: list[bool]  # by block: in the article, or in the main part if there is no article
    title: str


def _attributes(tag: str) -> dict[str, str]:
    return {
        m[1].lower(): charrefs.unescape((m[2] or "").strip("\"'")) for m in _ATTRIBUTE.finditer(tag)
    }


def _is_furniture(name: str, given: dict[str, str], inside: bool) -> bool:
    if name in ("html", "body", "main"):
        return False
    if name in FURNITURE_TAGS or name == "header" and not inside:
        return True
    if "hidden" in given or given.get("aria-hidden", "").lower() == "true":
        return True
    if re.search(r"display\s*:\s*none", given.get("style", ""), re.I):
        return True
    role = given.get("role", "").lower()
    if role in FURNITURE_ROLES and not (role == "banner" and inside):
        return True
    for word in (given.get("class", "") + " " + given.get("id", "")).split():
        if word.lower() in HEADER_WORDS and not inside:
            return True
        parts = _WORD.findall(_CAMEL.sub("-", word).lower())
        if parts and not _STATES.intersection(parts):
            if parts[-1] in FURNITURE_WORDS or parts[0] in FURNITURE_WORDS and name != "article":
                return True
    return False


def _label(name: str, given: dict[str, str]) -> str:
    words = (given.get("class") or given.get("id") or "").split()
    mark = "-".join(_WORD.findall(words[0].lower())) if words else ""
    return f"{name}.{mark}" if mark else name


def parse(source: str) -> Page:
    """Block tree and blocks of a page, as browsers would nest them for the usual mistakes."""
    root = Node("html")
    page = Page(root, [], [], [], "")
    articles: list[bool] = []
    mains: list[bool] = []
    # Open elements: name, its node if it is a block, furniture, inline furniture, article, main.
    stack: list[tuple[str, Node | None, bool, bool, bool, bool]] = [("html", root, *[False] * 4)]
    node, muted, hushed, article, main = root, *[False] * 4
    pieces: list[str] = []

    def flush() -> None:
        text = " ".join("".join(pieces).split())
        pieces.clear()
        if text:
            node.texts.append(len(page.blocks))
            page.blocks.append(text)
            page.kept.append(not muted)
            articles.append(article)
            mains.append(main)

    def top() -> None:
        nonlocal node, muted, hushed, article, main
        _, _, muted, hushed, article, main = stack[-1]
        node = next(n for _, n, *_ in reversed(stack) if n is not None)

    def close(names: set[str], limits: set[str]) -> None:
        for i in range(len(stack) - 1, 0, -1):
            if stack[i][0] in names:
                if any(n is not None for _, n, *_ in stack[i:]):
                    flush()
                del stack[i:]
                top()
                return
            if stack[i][0] in limits:
                return

    place, end = 0, len(source)
    while place < end:
        found = _TOKEN.search(source, place)
        start = found.start() if found else end
        if start > place and not hushed:
            text = source[place:start]
            pieces.append(charrefs.unescape(text) if "&" in text else text)
        if not found:
            break
        place = found.end()
        tag = found[0]
        if tag[1] in "!?":
            continue
        name = _NAME.match(tag)[1].lower()
        if tag[1] == "/":
            if name in BLOCKS:
                flush()
            if name not in ("html", "body"):
                close({name}, {"table"} if name not in ("table", "article", "main", "body") else set())
            continue
        if name == "br":
            pieces.append(" ")
        if name in RAW:
            finish = re.compile(rf"</{re.escape(name)}(?=[\s/>])", re.I).search(source, place)
            inner = source[place : finish.start() if finish else end]
            if name == "title" and not page.title:
                page.title = " ".join(charrefs.unescape(inner).split())
            closing = source.find(">", finish.start()) if finish else -1
            place = closing + 1 if closing >= 0 else end
            continue
        if name in BLOCKS:
            flush()
            close(*_P_SCOPE)
            if name in _IMPLIED:
                close(*_IMPLIED[name])
        if name in VOID or name in ("html", "body"):
            continue
        given = _attributes(tag)
        declared = _is_furniture(name, given, article or main)
        flag = muted or declared and name in BLOCKS
        is_article = article or name == "article" and not flag
        is_main = main or not flag and (
            name == "main" or given.get("role") == "main" or "articleBody" in given.get("itemprop", "")
        )
        if tag.endswith("/>") and name not in BLOCKS:
            continue
        new = None
        hushed = hushed or declared and name not in BLOCKS
        if name in BLOCKS:
            new = node
            if node.depth < MAX_DEPTH:
                new = Node(_label(name, given), node, node.depth + 1)
                node.children.append(new)
            node = new
        stack.append((name, new, flag, hushed, is_article, is_main))
        muted, article, main = flag, is_article, is_main
    flush()
    region = articles if any(a and k for a, k in zip(articles, page.kept)) else mains
    page.inside = region
    return page


# --- folded trees ---------------------------------------------------------------


@functools.lru_cache(100_000)
def _shape(label: str, children: tuple) -> tuple:
    """A tree as (label, shapes of the children, number of nodes); equal trees are one object."""
    return label, children, 1 + sum(c[2] for c in children)


def _without_repeats(parts: list, period: int) -> list:
    """Siblings in which every group of ``period`` that repeats at once stands for its repeats."""
    folded, i = [], 0
    while i < len(parts):
        last = i + period
        while last + period <= len(parts) and all(
            parts[last + k][0] is parts[i + k][0] for k in range(period)
        ):
            last += period
        if last == i + period:
            folded.append(parts[i])
            i += 1
            continue
        for same in (parts[i + k : last : period] for k in range(period)):
            texts = zip(*(p[1] for p in same))
            folded.append((same[0][0], [list(chain.from_iterable(x)) for x in texts]))
        i = last
    return folded


def fold(root: Node) -> tuple[tuple, list[list[int]]]:
    """The tree with repeats of one to three siblings folded, and the blocks of each of its
    nodes in preorder."""
    order, todo = [], [root]
    while todo:
        node = todo.pop()
        order.append(node)
        todo += node.children
    made: dict[int, tuple[tuple, list[list[int]]]] = {}
    for node in reversed(order):
        parts = [made.pop(id(child)) for child in node.children]
        for period in (1, 2, 3):
            parts = _without_repeats(parts, period)
        shape = _shape(node.label, tuple(p[0] for p in parts))
        made[id(node)] = shape, [node.texts, *(texts for p in parts for texts in p[1])]
    return made[id(root)]


def write_shape(shape: tuple) -> str:
    label, children, _ = shape
    return f"{label}({','.join(map(write_shape, children))})" if children else label


def read_shape(text: str) -> tuple:
    stack: list[tuple[str, list]] = [("", [])]
    for label, mark in re.findall(r"([^(),]*)([(),]|\Z)", text):
        if mark == "(":
            stack.append((label, []))
            continue
        if label:
            stack[-1][1].append(_shape(label, ()))
        if mark == ")":
            done = stack.pop()
            stack[-1][1].append(_shape(done[0], tuple(done[1])))
    return stack[0][1][0]


# --- simple tree matching -------------------------------------------------------


class Matcher:
    """Largest order-preserving match of two trees whose matched nodes have equal labels."""

    def __init__(self):
        self.known: dict[tuple[int, int], int] = {}

    def weight(self, a: tuple, b: tuple) -> int:
        if a is b:
            return a[2]
        if a[0] != b[0]:
            return 0
        key = id(a), id(b)
        if key not in self.known:
            self.known[key] = 1 + sum(w for *_, w in self._pairs(a[1], b[1]))
        return self.known[key]

    def _weights(self, a: tuple, b: tuple) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Weights of the different children, and which of them each child is."""
        rows, columns = {id(x): x for x in a}, {id(y): y for y in b}
        weights = np.array([[self.weight(x, y) for y in columns.values()] for x in rows.values()])
        at = {key: i for i, key in enumerate(rows)}, {key: i for i, key in enumerate(columns)}
        return weights, np.array([at[0][id(x)] for x in a]), np.array([at[1][id(y)] for y in b])

    def _pairs(self, a: tuple, b: tuple) -> list[tuple[int, int, int]]:
        """Matched children: their numbers and weight."""
        n = 0
        while n < min(len(a), len(b)) and a[n] is b[n]:
            n += 1
        m = 0
        while m < min(len(a), len(b)) - n and a[-1 - m] is b[-1 - m]:
            m += 1
        head = [(i, i, a[i][2]) for i in range(n)]
        tail = [(len(a) - i, len(b) - i, a[-i][2]) for i in range(m, 0, -1)]
        a, b = a[n : len(a) - m], b[n : len(b) - m]
        middle = _best(*self._weights(a, b)) if a and b else []
        return [*head, *((i + n, j + n, w) for i, j, w in middle), *tail]

    def match(self, tree: tuple, reference: tuple) -> list[int]:
        """For each node of ``tree``, in preorder, its node of ``reference``, or -1."""
        out = [-1] * tree[2]
        todo = [(tree, 0, reference, 0)] if tree[0] == reference[0] else []
        while todo:
            a, i, b, j = todo.pop()
            if a is b:
                out[i : i + a[2]] = range(j, j + a[2])
                continue
            out[i] = j
            starts = [np.cumsum([first + 1, *(c[2] for c in x[1])]) for first, x in ((i, a), (j, b))]
            for p, q, w in self._pairs(a[1], b[1]):
                if w:
                    todo.append((a[1][p], int(starts[0][p]), b[1][q], int(starts[1][q])))
        return out


def _sweep(weights: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> np.ndarray:
    """Best sums of order-preserving matches of all rows with each prefix of the columns."""
    best = np.zeros(len(columns) + 1, np.int64)
    for row in rows:
        best[1:] = np.maximum(best[1:], best[:-1] + weights[row, columns])
        np.maximum.accumulate(best, out=best)
    return best


def _best(weights: np.ndarray, rows: np.ndarray, columns: np.ndarray) -> list[tuple[int, int, int]]:
    """The best order-preserving match, halving the rows so that memory stays linear."""
    if not len(rows) or not len(columns):
        return []
    if len(rows) == 1:
        j = int(weights[rows[0], columns].argmax())
        w = int(weights[rows[0], columns[j]])
        return [(0, j, w)] if w else []
    half = len(rows) // 2
    ahead = _sweep(weights, rows[:half], columns)
    behind = _sweep(weights, rows[half:][::-1], columns[::-1])[::-1]
    cut = int((ahead + behind).argmax())
    later = _best(weights, rows[half:], columns[cut:])
    return [*_best(weights, rows[:half], columns[:cut]), *((i + half, j + cut, w) for i, j, w in later)]


# --- jobs -----------------------------------------------------------------------

_PARSED = (
    "host string, tree string, version long, slots array<struct<node:int,digest:long,inside:boolean>>, "
    "blocks array<struct<node:int,text:string>>"
)
_SLOT = pa.list_(pa.struct([("node", pa.int32()), ("digest", pa.int64()), ("inside", pa.bool_())]))
_BLOCK = pa.list_(pa.struct([("node", pa.int32()), ("text", pa.string())]))
_HOST = re.compile(r"^[a-zA-Z][a-zA-Z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)")


def _digest(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def read_page(url: str | None, source: str | None) -> tuple:
    host = _HOST.match(url or "")
    page = parse(source or "")
    tree, texts = fold(page.root)
    whole = any(i and k for i, k in zip(page.inside, page.kept))
    slots, blocks = [], []
    for number, members in enumerate(texts):
        if members:
            joined = "\n".join(page.blocks[m] for m in members)
            inside = any(page.inside[m] for m in members)
            slots.append({"node": number, "digest": _digest(joined), "inside": inside})
            blocks += [(m, number) for m in members if page.kept[m] and (page.inside[m] or not whole)]
    version = page.title or "\n".join(page.blocks)
    text = [{"node": number, "text": page.blocks[m]} for m, number in sorted(blocks)]
    return host[1].lower() if host else None, write_shape(tree), _digest(version), slots, text


def _parse_pages(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for start in range(0, batch.num_rows, 200):
            part = batch.slice(start, 200)
            *given, url, html = part.columns
            rows = [read_page(u, h) for u, h in zip(url.to_pylist(), html.to_pylist())]
            host, tree, version, slots, blocks = zip(*rows)
            made = [
                pa.array(host, pa.string()), pa.array(tree, pa.string()),
                pa.array(version, pa.int64()), pa.array(slots, _SLOT), pa.array(blocks, _BLOCK),
            ]
            names = ["page_id", "url", "host", "tree", "version", "slots", "blocks"]
            yield pa.RecordBatch.from_arrays([*given, *made], names)


def _align(batches: Iterable[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        pairs = zip(batch.column("tree").to_pylist(), batch.column("reference").to_pylist())
        matched = [Matcher().match(read_shape(tree), read_shape(reference)) for tree, reference in pairs]
        yield pa.RecordBatch.from_arrays(
            [batch.column("host"), batch.column("tree_id"), pa.array(matched, pa.list_(pa.int32()))],
            ["host", "tree_id", "goal"],
        )


def templates(parsed: DataFrame) -> DataFrame:
    """``host, tree_id, template``: the nodes of each distinct tree that belong to the host's
    template; trees without such nodes are left out."""
    trees = (
        parsed.filter("host IS NOT NULL")
        .groupBy("host", "tree_id")
        .agg(F.count(F.lit(1)).alias("pages"), F.any_value("tree").alias("tree"))
    )
    references = trees.groupBy("host").agg(
        F.max(F.struct("pages", F.col("tree").alias("reference")))["reference"].alias("reference")
    )
    aligned = materialize(
        trees.select("host", "tree_id", "tree")
        .join(references, "host")
        .mapInArrow(_align, "host string, tree_id binary, goal array<int>"),
        "aligned",
    )
    votes = (
        parsed.filter("host IS NOT NULL")
        .select("host", "tree_id", "version", F.explode("slots").alias("s"))
        # One row per title, however many copies a page has.
        .select("host", "tree_id", "version", "s.node", "s.digest", "s.inside")
        .distinct()
        .join(aligned, ["host", "tree_id"])
        .withColumn("goal", F.get("goal", F.col("node")))
        .filter("goal >= 0")
        .select("host", "goal", "digest", "version", "inside")
        .groupBy("host", "goal", "digest", "version")
        .agg(F.bool_or("inside").alias("inside"))
        .groupBy("host", "goal", "digest")
        .agg(F.count(F.lit(1)).alias("n"), F.bool_or("inside").alias("inside"))
        .groupBy("host", "goal")
        .agg(
            F.sum("n").alias("all"),
            F.max("n").alias("most"),
            F.count(F.lit(1)).alias("texts"),
            F.bool_or("inside").alias("inside"),
        )
    )

    def same(rule: tuple[int, float]) -> Column:
        return (F.col("all") >= rule[0]) & (F.col("most") >= rule[1] * F.col("all"))

    rotating = (F.col("all") >= ROTATING[0]) & (F.col("texts") <= ROTATING[1] * F.col("all"))
    fixed = votes.filter(F.when(F.col("inside"), same(INSIDE)).otherwise(same(OUTSIDE) | rotating))
    by_host = fixed.groupBy("host").agg(F.collect_set("goal").alias("fixed"))
    found = F.filter(
        F.sequence(F.lit(0), F.size("goal") - 1),
        lambda node: F.array_contains("fixed", F.get("goal", node)),
    )
    return (
        aligned.join(by_host, "host")
        .select("host", "tree_id", found.alias("template"))
        .filter(F.size("template") > 0)
    )


def extract(pages: DataFrame) -> DataFrame:
    """``page_id, url, text, n_chars``: the main text of every page, blocks joined by line feeds."""
    columns = ("page_id", "url")
    kinds = ", ".join(f"{c} {pages.schema[c].dataType.simpleString()}" for c in columns)
    given = pages.select(*columns, F.col("url").alias("_url"), F.col("html").cast("string").alias("_html"))
    read = given.mapInArrow(_parse_pages, f"{kinds}, {_PARSED}")
    parsed = materialize(read.withColumn("tree_id", F.unhex(F.md5("tree"))), "parsed_pages")
    wrapper = materialize(templates(parsed), "templates")
    text = F.filter(
        "blocks", lambda b: ~F.coalesce(F.array_contains("template", b["node"]), F.lit(False))
    )
    return (
        parsed.select("page_id", "url", "host", "tree_id", "blocks")
        .join(wrapper, ["host", "tree_id"], "left")
        .select("page_id", "url", F.array_join(F.transform(text, lambda b: b["text"]), "\n").alias("text"))
        .withColumn("n_chars", F.length("text").cast("long"))
    )
