"""HTML extraction (operator 3).

Method: wrapper induction. Every page is parsed once to a DOM tree. Its main part is its outermost ``article``, ``main`` or role ``main``
elements, else the whole page, without navigation, adverts and the like (tags, roles, words of a class or id). The tree of its block elements, each
known by tag and class, is kept. Pages of a host with the same marked elements outside of their main part are a layout; the page with the
smallest hash of a layout's pages gives its reference tree. Every page is aligned with that by simple tree matching, the largest mapping of nodes that keeps
parents and order. A text has a slot: the aligned element it stands under, and the steps from there. Nodes whose text is the same in their slot on a
large share of the layout's pages are template, more than ``OUTSIDE`` without a landmark, at least ``INSIDE`` within one; varying slots are content.
So an element more, a shifted list or an id of its own do not hide a template. Texts that stand at the same path on as large a share of
all pages of the host are template too, whatever their layout. The main text is the rest, in page order.

Pages with the same blocks in their main part count once, so copies of one article are no template. Where template would be more than half of
an article's characters, that article is one of many near copies and stays whole. Nothing but template is ever left out of the main part.

Votes are hashes, counted once per page, then per task before the shuffle; a host
with a third of all pages sends its distinct votes only, spread over the tasks. A reference tree holds no text, and a layout has at most ``1 / INSIDE`` or
``1 / OUTSIDE`` times as many template slots as its pages have blocks; both meet the pages by broadcast if their table is small, else joined by
host and layout. Long lists of children are aligned as exactly as short ones, row by row of their table of sizes, of which a task never holds more
than some ``TABLE`` cells and a row per halving.

Defined cases: null html counts as empty and gives the empty text; a null or odd url has the host ''; repeated
rows are extracted row by row; an empty table gives no rows; extra columns are not taken along.
"""

from __future__ import annotations

import html as entities
import json
import re
from collections import Counter
from collections.abc import Iterator
from functools import lru_cache
from hashlib import blake2b

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, functions as F

from docloom.llm.common import guarded, settle

#: Template texts stand on more than this share of the pages, outside of landmarks, and on at least that one within them.
OUTSIDE, INSIDE = 0.5, 0.8
#: Fewest pages, different in their main part, that a template text stands on.
LEAST_OUTSIDE, LEAST_INSIDE = 2, 3
#: Elements nested deeper than this become siblings; their texts stay.
DEPTH = 150
#: Pairs of children whose sizes are one table in plain lists; longer lists of children have rows of numbers, at most ``TABLE`` cells at a time.
CELLS, TABLE = 40_000, 1 << 21
#: Mappings of unlike trees that are remembered, with their pairs of children, within a match.
KNOWN = 500_000
#: HTML's void elements, its elements of raw text, and those that end an open paragraph.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style title textarea noscript template iframe svg math object".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 "
                  "h5 h6 header hgroup hr html legend li main menu nav ol p pre section summary table tbody td tfoot th thead tr ul br".split())
#: Elements, words of class or id, and roles that mark what is not the article.
SKIPPED_TAGS = frozenset("head nav footer aside form script style noscript template iframe button select option input menu dialog svg math object textarea "
                         "canvas audio video".split())
SKIPPED_WORDS = frozenset("ad ads adv advert adverts advertisement adsense sponsor sponsored promo banner sidebar nav navbar navigation menu breadcrumb breadcrumbs "
                          "header footer notice notices cookie cookies consent popup modal overlay newsletter subscribe share sharing social related "
                          "comment comments disqus respond reply replies widget toolbar pagination pager skip login signup".split())
SKIPPED_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu".split())
TOKEN = re.compile(r"<!--.*?(?:-->|$)|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>\"']|\"[^\"]*+\"|'[^']*+')*+)>", re.S)
DIGITS = re.compile(r"\d+")
ATTRIBUTE = re.compile(r"(class|id|role)\s*=\s*(\"[^\"]*\"|'[^']*'|[^\s>]+)", re.I)


class Node:
    """An element: ``mark`` is its class, ``named`` its class and id."""

    __slots__ = ("tag", "mark", "named", "role", "children", "parent", "depth", "number", "shape", "weight")

    def __init__(self, tag: str, mark: str = "", role: str = "", parent: Node | None = None, named: str = ""):
        self.tag, self.mark, self.role, self.parent, self.named = tag, mark, role, parent, named
        self.depth = parent.depth + 1 if parent else 0
        self.children: list[Node | str] = []

    @property
    def step(self) -> str:
        return f"{self.tag}.{self.mark}" if self.mark else self.tag

    def nodes(self) -> list[Node]:
        return [c for c in self.children if isinstance(c, Node)]

    def own_text(self) -> str:
        return " ".join("".join(c for c in self.children if isinstance(c, str)).split())


def parse(page: str) -> Node:
    """A tree of the page; tags left open are closed where their parent, or for ``p`` and ``li`` the next block, ends them."""
    root = top = Node("#root")
    at, n = 0, len(page)
    last = page.rfind(">")  # what follows the last one is text
    while at < n:
        found = TOKEN.search(page, at) if at < last or page.startswith("<!--", at) else None
        text = page[at:found.start()] if found else page[at:]
        if text:
            top.children.append(entities.unescape(text))
        if not found:
            break
        at = found.end()
        if not found[2]:
            continue
        tag = found[2].lower()
        if found[1]:
            node = top
            while node.tag != tag and node.parent:
                node = node.parent
            if node.parent and node.tag == tag:
                top = node.parent
            continue
        attributes = {k.lower(): v.strip("\"'") for k, v in ATTRIBUTE.findall(found[3])} if found[3] else {}
        if tag in BLOCK and tag != "br":
            node = top
            while node.parent and node.tag not in ("p", "div", "article", "section", "td", "li", "ul", "ol", "body", "blockquote"):
                node = node.parent
            if node.tag == "p" or node.tag == "li" and tag == "li":
                top = node.parent
        mark = DIGITS.sub("", attributes.get("class", "")).strip().lower()
        named = f"{mark} {DIGITS.sub('', attributes.get('id', '')).strip().lower()}" if attributes else ""
        node = Node(tag, mark, attributes.get("role", "").lower(), top, named)
        top.children.append(node)
        if tag in VOID or found[3].endswith("/") or node.depth >= DEPTH and tag not in RAW:
            continue
        if tag in RAW:
            end = re.compile(rf"</{re.escape(tag)}\s*>", re.I).search(page, at)
            at = end.end() if end else n
            continue
        top = node
    return root


def skipped(node: Node, in_article: bool) -> bool:
    if node.tag in SKIPPED_TAGS or node.role in SKIPPED_ROLES or node.tag == "header" and not in_article:
        return True
    return bool(node.named) and not SKIPPED_WORDS.isdisjoint(re.split(r"[^a-z]+", node.named))


def numbered(root: Node) -> list[Node]:
    """All nodes in page order, with their number, the shape of the tree below them and its size."""
    order, stack = [], [root]
    while stack:
        node = stack.pop()
        node.number = len(order)
        order.append(node)
        stack.extend(reversed(node.nodes()))
    for node in reversed(order):
        below = node.nodes()
        node.shape = hash((node.step, *(c.shape for c in below)))
        node.weight = 1 + sum(c.weight for c in below)
    return order


def match(a: Node, b: Node) -> tuple[int, list[tuple[Node, Node]]]:
    """Simple tree matching: size of the largest mapping of ``a`` to ``b`` and its pairs of nodes."""
    numbered(a)
    numbered(b)
    known: dict[tuple[int, int], tuple[int, list[tuple[int, int]]]] = {}
    held = 0

    def size(x: Node, y: Node) -> int:
        if x.step != y.step:
            return 0
        return x.weight if x.shape == y.shape else children(x, y)[0]

    def children(x: Node, y: Node) -> tuple[int, list[tuple[int, int]]]:
        """Size of the mapping of two unlike trees, and which children it pairs. Alike trees have alike answers."""
        nonlocal held
        key = x.shape, y.shape
        found = known.get(key)
        if not found:
            left, right = x.nodes(), y.nodes()
            first, n, m = 0, len(left), len(right)
            while first < min(n, m) and left[first].shape == right[first].shape:  # equal trees at both ends are always part of a largest mapping
                first += 1
            while min(n, m) > first and left[n - 1].shape == right[m - 1].shape:
                n, m = n - 1, m - 1
            ends = [*((i, i) for i in range(first)), *zip(range(n, len(left)), range(m, len(right)))]
            way = largest if (n - first) * (m - first) <= CELLS else largest_by_rows
            pairs = ends + way(left[first:n], right[first:m], first)
            found = 1 + sum(size(left[i], right[j]) for i, j in pairs), pairs
            held += 1 + len(pairs)
            if held > KNOWN:
                known.clear()
                held = 1 + len(pairs)
            known[key] = found
        return found

    def largest(left: list[Node], right: list[Node], at: int) -> list[tuple[int, int]]:
        best = [[0] * (len(right) + 1) for _ in range(len(left) + 1)]
        for i, x in enumerate(left):
            for j, y in enumerate(right):
                best[i + 1][j + 1] = max(best[i][j + 1], best[i + 1][j], best[i][j] + size(x, y))
        pairs, i, j = [], len(left), len(right)
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs.append((at + i, at + j))
        return pairs

    def largest_by_rows(left: list[Node], right: list[Node], at: int) -> list[tuple[int, int]]:
        """The pairs of ``largest``: the table is halved until the rows of a part fit, and walked back part by part, so rows are made again in place of kept."""
        codes: dict[int, int] = {}
        column = np.array([codes.setdefault(y.shape, len(codes)) for y in right])
        kinds = list({y.shape: y for y in right}.values())
        lines: dict[int, np.ndarray] = {}

        def line(x: Node) -> np.ndarray:
            if x.shape not in lines:
                if (len(lines) + 1) * len(kinds) > TABLE:
                    lines.clear()
                lines[x.shape] = np.array([size(x, y) for y in kinds])
            return lines[x.shape]

        def below(row: np.ndarray, x: Node) -> np.ndarray:
            out = np.zeros_like(row)
            np.maximum.accumulate(np.maximum(row[1:], row[:-1] + line(x)[column[:len(row) - 1]]), out=out[1:])
            return out

        pairs, j, parts = [], len(right), [(0, len(left), np.zeros(len(right) + 1, np.int64))]
        while parts and j:
            low, high, row = parts.pop()
            row = row[:j + 1]
            if high - low > 1 and (high - low) * len(row) > TABLE:
                half, middle = row, (low + high) // 2
                for x in left[low:middle]:
                    half = below(half, x)
                parts += [(low, middle, row), (middle, high, half)]
                continue
            best = [row]
            for x in left[low:high]:
                best.append(below(best[-1], x))
            i = high - low
            while i and j:
                if best[i][j] == best[i - 1][j]:
                    i -= 1
                elif best[i][j] == best[i][j - 1]:
                    j -= 1
                else:
                    i, j = i - 1, j - 1
                    pairs.append((at + low + i, at + j))
        return pairs

    total, mapped, open_ = size(a, b), [], [(a, b)] if a.step == b.step else []
    while open_:
        x, y = open_.pop()
        mapped.append((x, y))
        left, right = x.nodes(), y.nodes()
        open_ += zip(left, right) if x.shape == y.shape else [(left[i], right[j]) for i, j in children(x, y)[1]]
    return total, mapped


def walk(node: Node, path: tuple[str, ...] = (), in_article: bool = False):
    """Nodes outside the skipped parts with their paths."""
    yield node, path
    for child in node.nodes():
        inside = in_article or child.tag in ("article", "main")
        if not skipped(child, inside):
            yield from walk(child, (*path, child.step), inside)


def number(*parts: str) -> int:
    """A hash of 64 bits, the same in all processes, never 0."""
    return int.from_bytes(blake2b("\0".join(parts).encode("utf-8", "surrogatepass"), digest_size=8).digest(), "big", signed=True) or 1


def main_part(page: str | None) -> tuple[list[tuple[Node, tuple[str, ...]]], bool, int]:
    """The main part's top nodes with their paths, whether they are landmarks, and the page's layout."""
    found = list(walk(parse(page or "")))
    landmarks = [x for x in found if x[0].tag in ("article", "main") or x[0].role == "main"]
    ids = {id(n) for n, _ in landmarks}
    outer = [x for x in landmarks if not any(id(y) in ids for y in ancestors(x[0]))]
    signs = set()

    def skeleton(node: Node, path: tuple[str, ...]) -> None:
        landmark = id(node) in ids
        if landmark or node.mark and node.tag in BLOCK:
            signs.add("/".join(path))
        if not landmark:
            for child in node.nodes():
                if not skipped(child, False):
                    skeleton(child, (*path, child.step))

    skeleton(*found[0])
    return outer or found[:1], bool(outer), number(*sorted(signs))


def pruned(node: Node, inside: bool) -> list:
    """A main part as nested lists ``[step, [children]]``: block elements and texts; inline elements give their content, skipped ones nothing."""
    children: list = []

    def take(n: Node) -> None:
        for c in n.children:
            if isinstance(c, str):
                if children and isinstance(children[-1], str):
                    children[-1] += c
                else:
                    children.append(c)
            elif not skipped(c, inside):
                if c.tag in BLOCK:
                    children.append(pruned(c, inside))
                else:
                    take(c)

    take(node)
    return [node.step, children]


def bare(tree: list) -> list:
    """A tree without its texts."""
    return [tree[0], [bare(c) for c in tree[1] if not isinstance(c, str)]]


def restored(tree: list, parent: Node | None = None) -> Node:
    """Nodes of nested lists."""
    tag, _, mark = tree[0].partition(".")
    node = Node(tag, mark, "", parent)
    node.children = [c if isinstance(c, str) else restored(c, node) for c in tree[1]]
    return node


class Page:
    """The main part of a page: its tree under a root, whether it is a landmark, and its layout."""

    def __init__(self, html: str | None = None, tree: str | None = None, inside: bool = False, layout: int = 0):
        if tree is None:
            tops, inside, layout = main_part(html)
            tree = json.dumps(["#root", [pruned(n, inside) for n, _ in tops]])
        self.tree, self.inside, self.layout = tree, inside, layout
        self.root = restored(json.loads(tree))

    def outline(self) -> str:
        return json.dumps(bare(json.loads(self.tree)))

    def blocks(self) -> list[tuple[Node, tuple[str, ...], str]]:
        """Elements with a text of their own, their paths and texts, in page order."""
        out, stack = [], [(self.root, ())]
        while stack:
            node, path = stack.pop()
            text = node.own_text()
            if text:
                out.append((node, path, text))
            stack.extend((c, (*path, c.step)) for c in reversed(node.nodes()))
        return out

    def hash(self) -> int:
        return number(str(self.layout), *(f"{'/'.join(path)} {text}" for _, path, text in self.blocks()))

    def slots(self, reference: str | None) -> list[tuple[Node, int, int, str]]:
        """Per block: node, its slot and text in the reference tree (0 without one), its path and text, and its text."""
        aligned = {id(x): y.number for x, y in match(self.root, reference_tree(reference))[1]} if reference else {}
        out = []
        for node, path, text in self.blocks():
            slot, above, steps = 0, node.parent or node, [node.step]
            while aligned and id(above) not in aligned and above.parent:
                steps.append(above.step)
                above = above.parent
            if id(above) in aligned:
                slot = number("slot", str(aligned[id(above)]), "/".join(steps), text)
            out.append((node, slot, number("path", *path, text), text))
        return out


@lru_cache(maxsize=256)
def reference_tree(outline: str) -> Node:
    return restored(json.loads(outline))


def enough(n: int, pages: int, inside: bool) -> bool:
    return n >= LEAST_INSIDE and n >= INSIDE * pages if inside else n >= LEAST_OUTSIDE and n > OUTSIDE * pages


def votes(page: Page, reference: str | None) -> set[tuple[int, int]]:
    """(layout, slot) and (0, path) of the page's blocks, and (layout, 0), (0, 0) for the page itself."""
    out = {(page.layout, 0), (0, 0)}
    for _, slot, path, _ in page.slots(reference):
        out.add((0, path))
        if slot:
            out.add((page.layout, slot))
    return out


def induce(pages: list[str]) -> dict:
    """The wrapper of a host from its pages, as ``wrappers`` makes it: per layout its reference and template slots, and the template paths of the host."""
    cast = {(p.layout, p.hash()): p for p in map(Page, pages)}
    references: dict[int, tuple[int, str]] = {}
    for (layout, h), p in cast.items():
        references[layout] = min(references.get(layout, (h, p.outline())), (h, p.outline()))
    counts: Counter = Counter()
    for (layout, _), p in cast.items():
        counts.update((at, block, p.inside and block != 0) for at, block in votes(p, references[layout][1]))
    found: dict[int, list[int]] = {}
    for (at, block, inside), n in counts.items():
        if block and enough(n, counts[at, 0, False], inside):
            found.setdefault(at, []).append(block)
    return {"host": found.get(0, []), "layouts": {at: (r[1], found.get(at, [])) for at, r in references.items()}}


def main_text(html: str | None, wrapper: dict | None) -> str:
    """Blocks of the page's main part without the host's template texts, joined by line ends."""
    page = Page(html)
    reference, slots = (wrapper or {}).get("layouts", {}).get(page.layout, (None, []))
    return content(page, reference, frozenset(slots), frozenset((wrapper or {}).get("host", [])))


def content(page: Page, reference: str | None, slots: frozenset, paths: frozenset) -> str:
    """The texts of the page that are in neither of its template's ``slots`` and ``paths``."""
    quiet: set[int] = set()
    if slots or paths:
        sizes = [(id(n), slot in slots or path in paths, len(text)) for n, slot, path, text in page.slots(reference if slots else None)]
        if not page.inside or 2 * sum(k for _, t, k in sizes if t) <= sum(k for _, _, k in sizes):
            quiet = {n for n, t, _ in sizes if t}
    blocks: list[list[str]] = [[]]

    def collect(node: Node) -> None:
        for child in node.children:
            if isinstance(child, str):
                if id(node) not in quiet:
                    blocks[-1].append(child)
                continue
            blocks.append([])
            collect(child)
            blocks.append([])

    collect(page.root)
    return "\n".join(b for b in (" ".join("".join(parts).split()) for parts in blocks) if b)


def ancestors(node: Node) -> list[Node]:
    out = []
    while node.parent:
        node = node.parent
        out.append(node)
    return out


def host(url: str = "url"):
    return F.lower(F.regexp_extract(F.coalesce(F.col(url), F.lit("")), r"^[a-zA-Z][a-zA-Z0-9+.-]*://([^/?#]*)", 1))


def parsed(pages: DataFrame) -> DataFrame:
    """``page_id, url, key`` (the host's hash), ``layout, page`` (hash of the blocks), ``inside, tree, outline`` per row; settled, so that a page is parsed once."""
    given = pages.select("page_id", "url", F.xxhash64(host()).alias("key"), "html")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                found = [Page(h) for h in part.column(3).to_pylist()]
                yield pa.RecordBatch.from_arrays(
                    [*part.columns[:3], pa.array([p.layout for p in found], pa.int64()), pa.array([p.hash() for p in found], pa.int64()),
                     pa.array([p.inside for p in found], pa.bool_()), pa.array([p.tree for p in found], pa.string()), pa.array([p.outline() for p in found], pa.string())],
                    names=["page_id", "url", "key", "layout", "page", "inside", "tree", "outline"])

    schema = given.drop("html").schema.add("layout", "long").add("page", "long").add("inside", "boolean").add("tree", "string").add("outline", "string")
    return settle(given.mapInArrow(run, schema), "parsed-pages")


def references(rows: DataFrame) -> DataFrame:
    """``key, layout, reference`` for layouts of more than one page, settled."""
    first = rows.groupBy("key", "layout").agg(F.min(F.struct("page", "outline")).alias("first"), F.max("page").alias("last"))
    return settle(first.where("first.page <> last").select("key", "layout", F.col("first.outline").alias("reference")), "references")


def wrappers(rows: DataFrame, trees: DataFrame) -> tuple[DataFrame, DataFrame]:
    """Template slots per (``key, layout``) and template paths per ``key``, as arrays, from the ``parsed`` rows and their ``references``; settled."""
    given = rows.join(guarded(trees), ["key", "layout"], "left").select("key", "layout", "page", "inside", "tree", "reference")

    def vote(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                out = []
                for key, layout, page, inside, tree, reference in zip(*(c.to_pylist() for c in batch.slice(at, 500).columns)):
                    out += [(key, where, page, block, inside and block != 0) for where, block in votes(Page(tree=tree, inside=inside, layout=layout), reference)]
                columns = list(zip(*out))
                yield pa.RecordBatch.from_arrays([*[pa.array(c, pa.int64()) for c in columns[:4]], pa.array(columns[4], pa.bool_())],
                                                 names=["key", "at", "page", "block", "inside"])

    cast = given.mapInArrow(vote, "key long, at long, page long, block long, inside boolean").distinct()
    counted = settle(cast.groupBy("key", "at", "block", "inside").agg(F.count(F.lit(1)).alias("n")), "wrapper-votes")
    totals = settle(counted.where("block = 0").select("key", "at", F.col("n").alias("pages")), "wrapper-pages")
    n = F.col("n")
    share = F.when(F.col("inside"), (n >= LEAST_INSIDE) & (n >= INSIDE * F.col("pages"))).otherwise((n >= LEAST_OUTSIDE) & (n > OUTSIDE * F.col("pages")))
    template = counted.where(f"block <> 0 AND n >= {min(LEAST_OUTSIDE, LEAST_INSIDE)}").join(guarded(totals), ["key", "at"]).where(share)
    found = settle(template.groupBy("key", "at").agg(F.array_sort(F.collect_list("block")).alias("template")), "wrappers")
    own = trees.join(found.withColumnRenamed("at", "layout"), ["key", "layout"]).select("key", "layout", "reference", F.col("template").alias("slots"))
    return settle(own, "layout-wrappers"), settle(found.where("at = 0").select("key", F.col("template").alias("paths")), "host-wrappers")


def extract(pages: DataFrame) -> DataFrame:
    """One row per page: ``page_id, url, text, n_chars``."""
    rows = parsed(pages)
    cast = rows.where(F.col("tree") != F.lit(Page("").tree))  # pages without any block have no vote
    by_layout, by_host = wrappers(cast, references(cast))
    joined = rows.join(guarded(by_layout), ["key", "layout"], "left").join(guarded(by_host), "key", "left")
    joined = joined.select("page_id", "url", "layout", "inside", "tree", "reference", "slots", "paths")

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for at in range(0, batch.num_rows, 500):
                part = batch.slice(at, 500)
                texts = [content(Page(tree=tree, inside=inside, layout=layout), reference, frozenset(slots or ()), frozenset(paths or ()))
                         for layout, inside, tree, reference, slots, paths in zip(*(c.to_pylist() for c in part.columns[2:]))]
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                    names=["page_id", "url", "text", "n_chars"])

    return joined.mapInArrow(run, joined.select("page_id", "url").schema.add("text", "string").add("n_chars", "long"))
