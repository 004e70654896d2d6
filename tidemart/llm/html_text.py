"""Main text of web pages by wrapper induction (operator 2).

The trees of a host's pages are aligned by simple tree matching into one tree, the wrapper of the host. Each page
is then aligned with it, which gives every block of text a slot. Spark counts on how many pages a slot stands, and
with which texts: a text on half of a slot's pages is template, the slots' other texts are content.
"""

from __future__ import annotations

import json
from collections.abc import Iterator
from dataclasses import dataclass, field

import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from tidemart.llm.common import steps, written
from tidemart.llm.html_dom import WHOLE, parse
from tidemart.llm.html_dom import Node as Element
from tidemart.llm.url_filter import host_of

#: A text is template if it is on this share of its slot's pages, which are so many at least.
CONSTANT_SHARE, CONSTANT_PAGES = 0.5, 5
#: Slots that a wrapper aligns; the rarest go first. What meets none of them has a slot by the names of the elements
#: down from the last one that did, counted like any other.
WRAPPER_SLOTS = 2000
#: A block, or all blocks of a box, with this share of characters in links is a link.
LINKED = 0.8
#: First merges of a host's partial wrappers run in so many tasks.
MERGES = 64

# Elements, and words of class, id and role, that are not the article. Headers count inside one.
BOILER_ELEMENTS = frozenset("nav footer aside form dialog menu head".split())
BOILER_WORDS = frozenset(
    "ad ads advert adverts advertisement advertising sponsor sponsored promo banner menu nav navbar navigation breadcrumb "
    "breadcrumbs sidebar widget footer header masthead topbar toolbar cookie cookies consent notice alert popup modal overlay "
    "comment comments disqus reply replies respond form search login signup subscribe subscription newsletter share sharing "
    "social related recommended pagination pager copyright".split()
)
CONTENT_ELEMENTS = frozenset(["article", "main"])
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: Elements that are parts of a text and not the place of one.
TEXT_ELEMENTS = frozenset("p h1 h2 h3 h4 h5 h6 li dt dd pre blockquote figure figcaption address".split())
#: Titles, items and cells recur in articles by themselves; there only other texts are template when constant.
RECURRING = frozenset("h1 h2 h3 h4 h5 h6 li dt dd td th".split())


@dataclass
class Tree:
    """A node of a page with the numbers of its blocks, or of a wrapper with the number of its pages."""

    label: str
    pages: int = 1
    blocks: list[int] = field(default_factory=list)
    children: list[Tree] = field(default_factory=list)

    @property
    def element(self) -> str:
        return self.label.split(" ", 1)[0]

    def dump(self) -> list:
        return [self.label, self.pages, self.blocks, [c.dump() for c in self.children]]

    @classmethod
    def load(cls, row: list) -> Tree:
        return cls(row[0], row[1], row[2], [cls.load(c) for c in row[3]])


def page_tree(node: Element) -> Tree:
    """A page's tree with neighbouring children of one label merged: they repeat one slot."""
    merged: list[Element] = []
    for child in node.children:
        if merged and merged[-1].label == child.label:
            merged[-1] = Element(child.label, merged[-1].blocks + child.blocks, merged[-1].children + child.children)
        else:
            merged.append(child)
    return Tree(node.label, 1, node.blocks, [page_tree(c) for c in merged])


class Matching:
    """Simple tree matching of two trees: how many nodes of two subtrees match, each pair of subtrees scored once."""

    def __init__(self):
        self._scores: dict[tuple[int, int], int] = {}

    def score(self, a: Tree, b: Tree) -> int:
        """How many nodes match: labels agree, and order and ancestry are kept."""
        if a.label != b.label:
            return 0
        if not a.children or not b.children:
            return 1
        key = (id(a), id(b))
        if key not in self._scores:
            self._scores[key] = 1 + sum(self.score(a.children[i], b.children[j]) for i, j in self.pairs(a.children, b.children))
        return self._scores[key]

    def pairs(self, left: list[Tree], right: list[Tree]) -> list[tuple[int, int]]:
        """The pairs, in order, of the heaviest alignment of two rows of children."""
        if [x.label for x in left] == [x.label for x in right]:
            return [(i, i) for i in range(len(left))]
        m, n = len(left), len(right)
        best = [[0] * (n + 1) for _ in range(m + 1)]
        for i, a in enumerate(left, 1):
            above, row = best[i - 1], best[i]
            for j, b in enumerate(right, 1):
                most = max(above[j], row[j - 1])
                row[j] = max(most, above[j - 1] + self.score(a, b)) if a.label == b.label else most
        found, i, j = [], m, n
        while i and j:
            if best[i][j] == best[i - 1][j]:
                i -= 1
            elif best[i][j] == best[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                found.append((i, j))
        return found[::-1]


def _bare(tree: Tree) -> Tree:
    """The tree as a wrapper: without blocks."""
    return Tree(tree.label, tree.pages, [], [_bare(c) for c in tree.children])


def merge(wrapper: Tree, other: Tree, matching: Matching | None = None) -> None:
    """Aligns a page or a wrapper of the host with a wrapper and counts it in; what meets no slot becomes one."""
    matching = matching or Matching()
    wrapper.pages += other.pages
    pairs = {j: i for i, j in matching.pairs(wrapper.children, other.children)}
    grown, at = [], 0
    for j, child in enumerate(other.children):
        if j in pairs:
            grown += wrapper.children[at : pairs[j] + 1]
            at = pairs[j] + 1
            merge(grown[-1], child, matching)
        else:
            grown.append(_bare(child))
    wrapper.children[:] = grown + wrapper.children[at:]


def prune(wrapper: Tree) -> None:
    """Keeps at most WRAPPER_SLOTS nodes: those on the most pages, all or none of as many."""
    counts: list[int] = []

    def walk(node: Tree) -> None:
        counts.append(node.pages)
        for c in node.children:
            walk(c)

    def cut(node: Tree, least: int) -> None:
        node.children = [c for c in node.children if c.pages > least]
        for c in node.children:
            cut(c, least)

    walk(wrapper)
    if len(counts) > WRAPPER_SLOTS:
        cut(wrapper, sorted(counts, reverse=True)[WRAPPER_SLOTS])


def _whole_names(label: str) -> set[str]:
    return {w.removeprefix(WHOLE) for w in label.split(" ")[1:] if w.startswith(WHOLE)}


def is_boiler(label: str, inside: bool) -> bool:
    """Whether an element is no article by its name or the words of its attributes; a title never is.

    ``inside`` an article a header belongs to it, and a word counts only if it is a whole class, id or role:
    ``search-methods`` or ``notice-board`` are names of sections there. Whole names count for articles too: comments are
    often written as such.
    """
    name, *words = label.split(" ")
    if name in HEADINGS:
        return False
    if inside or name in CONTENT_ELEMENTS:
        return name in BOILER_ELEMENTS or not BOILER_WORDS.isdisjoint(_whole_names(label) - {"header"})
    return name in BOILER_ELEMENTS or name == "header" or not BOILER_WORDS.isdisjoint(words)


def homes_of(page: Tree) -> list[Tree]:
    """The article and main elements that hold the page's text: of the outermost ones those in the fewest elements that are
    no article by name, so a name around the only article hides nothing and articles in a sidebar are not the page's. One without
    text below (nested so deeply that its parts are taken beside it) is none."""
    found: list[tuple[int, Tree]] = []

    def walk(node: Tree, hidden: int) -> None:
        hidden += is_boiler(node.label, False)
        if node.element in CONTENT_ELEMENTS and any(True for _ in _blocks(node)):
            found.append((hidden, node))
        else:
            for c in node.children:
                walk(c, hidden)

    walk(page, 0)
    least = min((hidden for hidden, _ in found), default=0)
    return [node for hidden, node in found if hidden == least]


def _blocks(node: Tree) -> Iterator[int]:
    yield from node.blocks
    for c in node.children:
        yield from _blocks(c)


class Reading:
    """Which blocks of a page are its text by names alone: (block, slot, whether a constant text there is template)."""

    def __init__(self, wrapper: Tree, page: Tree, linked: list[float]):
        self.linked = linked
        self.matching = Matching()
        self.found: list[tuple[int, str, bool]] = []
        homes = homes_of(page)
        self.homes = {id(h) for h in homes}
        self.inside = bool(homes)
        self.around = self._around(page) if not homes else set()
        self._numbers: dict[int, int] = {}
        self._number(wrapper)
        self._take(wrapper if wrapper.label == page.label else None, "", page, False, False)
        self.found.sort()

    def _number(self, slot: Tree) -> None:
        self._numbers[id(slot)] = len(self._numbers)
        for c in slot.children:
            self._number(c)

    def _around(self, page: Tree) -> set[int]:
        """On a page without article: elements named like no article that hold all its prose are around it instead."""
        prose = {b for b in self._plain(page) if self.linked[b] < LINKED}
        found: set[int] = set()
        node = page
        while prose:
            node = next((c for c in node.children if prose <= set(_blocks(c))), None)
            if node is None:
                break
            found.add(id(node))
        return found

    def _plain(self, node: Tree) -> Iterator[int]:
        """Blocks that lie in no element which is never an article."""
        if node.element not in BOILER_ELEMENTS and node.element != "header":
            yield from node.blocks
            for c in node.children:
                yield from self._plain(c)

    def _is_links(self, node: Tree) -> bool:
        blocks = list(_blocks(node))
        return bool(blocks) and all(self.linked[b] >= LINKED for b in blocks)

    def _take(self, slot: Tree | None, path: str, node: Tree, inside: bool, among_prose: bool) -> None:
        home = id(node) in self.homes
        if not home and (inside or not self.inside):
            if id(node) not in self.around and is_boiler(node.label, inside):
                return
            if not inside and not among_prose and node.element not in TEXT_ELEMENTS and self._is_links(node):
                return  # a box of links that no prose stands beside
        inside = inside or home
        path = f"#{self._numbers[id(slot)]}" if slot is not None else f"{path}/{node.element}"
        if inside or not self.inside:
            fixed = inside and node.element in RECURRING
            self.found.extend((b, path, not fixed) for b in node.blocks)
        prose = any(self.linked[b] < LINKED for part in [node, *(c for c in node.children if c.element in TEXT_ELEMENTS)] for b in part.blocks)
        pairs = {j: i for i, j in self.matching.pairs(slot.children, node.children)} if slot else {}
        for j, child in enumerate(node.children):
            self._take(slot.children[pairs[j]] if j in pairs else None, path, child, inside, prose)


def _hash(*parts: str) -> int:
    return xxhash.xxh3_64_intdigest("\0".join(parts)) - (1 << 63)


def parsed(pages: DataFrame, id_col: str, url_col: str, html_col: str) -> DataFrame:
    """(page_id, url, host, tree, texts, linked): each page's tree as JSON, the texts of its blocks and their shares in links."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in steps(batches, "html"):
            found = [parse(x) for x in batch.column("html").to_pylist()]
            yield pa.RecordBatch.from_arrays(
                [
                    *(batch.column(c) for c in ("page_id", "url", "host")),
                    pa.array([json.dumps(page_tree(p.root).dump(), separators=(",", ":")) for p in found], pa.string()),
                    pa.array([p.texts for p in found], pa.list_(pa.string())),
                    pa.array([[x / len(t) for x, t in zip(p.linked, p.texts, strict=True)] for p in found], pa.list_(pa.float64())),
                ],
                ["page_id", "url", "host", "tree", "texts", "linked"],
            )

    rows = pages.select(
        F.col(f"`{id_col}`").cast("long").alias("page_id"),
        F.col(f"`{url_col}`").cast("string").alias("url"),
        host_of(F.col(f"`{url_col}`").cast("string")).alias("host"),
        F.coalesce(F.col(f"`{html_col}`").cast("string"), F.lit("")).alias("html"),
    )
    return rows.mapInArrow(read, "page_id long, url string, host string, tree string, texts array<string>, linked array<double>")


def wrappers(pages: DataFrame) -> DataFrame:
    """(host, wrapper) from parsed pages. A task aligns its own pages of a host first; their partial wrappers are merged in
    MERGES tasks a host and then in one, so no task meets more than a share of them."""

    def partial(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        trees: dict[str, Tree] = {}
        for batch in batches:
            for host, tree in zip(*(batch.column(c).to_pylist() for c in ("host", "tree")), strict=True):
                wrapper = trees.setdefault(host, Tree("#page", 0))
                merge(wrapper, Tree.load(json.loads(tree)))
                prune(wrapper)
            if len(trees) > 20_000:  # a bound on memory; more partial wrappers, the same sums
                yield rows(trees)
                trees = {}
        if trees:
            yield rows(trees)

    def rows(trees: dict[str, Tree]) -> pa.RecordBatch:
        return pa.RecordBatch.from_pydict({"host": list(trees), "wrapper": [json.dumps(t.dump(), separators=(",", ":")) for t in trees.values()]})

    def whole(group: pd.DataFrame) -> pd.DataFrame:
        first, *rest = (Tree.load(json.loads(w)) for w in sorted(group["wrapper"]))
        for other in rest:
            merge(first, other)
            prune(first)
        return pd.DataFrame({"host": [group["host"].iat[0]], "wrapper": [json.dumps(first.dump(), separators=(",", ":"))]})

    parts = pages.select("host", "tree").mapInArrow(partial, "host string, wrapper string")
    some = parts.withColumn("part", F.pmod(F.xxhash64("wrapper"), F.lit(MERGES))).groupBy("host", "part")
    return some.applyInPandas(whole, "host string, wrapper string").groupBy("host").applyInPandas(whole, "host string, wrapper string")


def aligned(pages: DataFrame, built: DataFrame) -> DataFrame:
    """(host, page_id, url, texts, inside, blocks, slots, keys): for each page the blocks that are its text by names, and hashes of
    their slot and of (slot, text), null where a text may recur."""

    def align(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        last: tuple[str, Tree] | None = None
        for batch in batches:
            out: dict[str, list] = {"inside": [], "blocks": [], "slots": [], "keys": []}
            columns = (batch.column(c).to_pylist() for c in ("host", "tree", "linked", "hashes", "wrapper"))
            for host, tree, linked, hashes, wrapper in zip(*columns, strict=True):
                if last is None or last[0] != wrapper:
                    last = (wrapper, Tree.load(json.loads(wrapper)))
                reading = Reading(last[1], Tree.load(json.loads(tree)), linked)
                slots = [_hash(host, path) for _, path, _ in reading.found]
                out["inside"].append(reading.inside)
                out["blocks"].append([b for b, _, _ in reading.found])
                out["slots"].append(slots)
                out["keys"].append([_hash(str(s), str(hashes[b])) if may else None for s, (b, _, may) in zip(slots, reading.found, strict=True)])
            own = [pa.array(out[c], t) for c, t in (("inside", pa.bool_()), ("blocks", pa.list_(pa.int32())), ("slots", pa.list_(pa.int64())), ("keys", pa.list_(pa.int64())))]
            yield pa.RecordBatch.from_arrays([*(batch.column(c) for c in kept), *own], [*kept, *out])

    hashes = F.col("hashes") if "hashes" in pages.columns else F.transform("texts", lambda t: F.xxhash64(t)).alias("hashes")
    types = {f.name: f.dataType.simpleString() for f in pages.schema if f.name in ("host", "page_id", "url", "texts")}
    kept = list(types)
    met = pages.join(built, "host").select(*kept, "tree", "linked", hashes, "wrapper")
    schema = types | {"inside": "boolean", "blocks": "array<int>", "slots": "array<long>", "keys": "array<long>"}
    return met.mapInArrow(align, ", ".join(f"{c} {t}" for c, t in schema.items()))


def template_of(placed: DataFrame) -> DataFrame:
    """(host, template): the (slot, text) pairs that are on CONSTANT_SHARE of their slot's pages; a page counts once for each.
    A host has the slots of its wrapper and the paths of element names beyond, whatever its pages, and a slot no more such texts than twice the
    blocks that its pages have there."""
    once = placed.select("host", F.explode(F.array_distinct(F.arrays_zip("slots", "keys"))).alias("m"))
    once = once.select("host", F.col("m.slots").alias("slot"), F.col("m.keys").alias("key"))
    pairs = once.filter("key is not null").groupBy("host", "slot", "key").agg(F.count("*").alias("on"))
    slots = placed.select(F.explode(F.array_distinct("slots")).alias("slot")).groupBy("slot").agg(F.count("*").alias("pages"))
    often = pairs.filter(F.col("on") >= CONSTANT_SHARE * CONSTANT_PAGES).join(slots.filter(F.col("pages") >= CONSTANT_PAGES), "slot")
    return often.filter(F.col("on") >= CONSTANT_SHARE * F.col("pages")).groupBy("host").agg(F.collect_set("key").alias("template"))


def _size(blocks: str | Column) -> Column:
    return F.aggregate(blocks, F.lit(0).cast("long"), lambda sum_, b: sum_ + F.length(F.element_at("texts", b.getField("blocks") + 1)))


def main_text(pages: DataFrame, id_col: str = "page_id", url_col: str = "url", html_col: str = "html") -> DataFrame:
    """One row per page: page_id, url, text, n_chars.

    The text is the page's main blocks in page order joined by an empty line, white space inside a block made one space.
    Where a page has an article or main element that is its text, else all that is not menu, header, footer and the like
    by name, or a box of links alone; template goes in both. If more than half of an article, by blocks and by characters,
    would be template, it is a copy of other pages and stays whole.

    A null or empty page has an empty text. Pages without a host share one wrapper; texts of slots on fewer than
    CONSTANT_PAGES pages are judged by names alone. Rows with equal ids are separate pages; an empty table gives no rows. Each page
    is read once. Pages meet their wrapper and their template by joins on the host, whose page side Spark splits where one host has
    very many; no text is grouped.
    """
    spark = pages.sparkSession
    read = written(spark, parsed(pages, id_col, url_col, html_col), "pages")
    built = written(spark, wrappers(read), "wrappers")
    hashed = read.select("host", "tree", "linked", F.transform("texts", lambda t: F.xxhash64(t)).alias("hashes"))
    placed = written(spark, aligned(hashed, built), "places")
    template = written(spark, template_of(placed), "template")

    whole = aligned(read, built).join(template, "host", "left").withColumn("zipped", F.arrays_zip("blocks", "keys"))
    hits = F.array_intersect(F.array_compact("keys"), F.coalesce("template", F.array().cast("array<long>")))
    is_hit = lambda b: b.getField("keys").isNotNull() & F.array_contains("hits", b.getField("keys"))
    gone, kept = F.filter("zipped", is_hit), F.filter("zipped", lambda b: ~is_hit(b))
    distinct = F.size(F.array_distinct(F.array_compact("keys")))
    copy = F.col("inside") & (2 * F.size("hits") > distinct) & (2 * _size(gone) > _size("zipped"))
    shown = F.when(copy, F.col("zipped")).otherwise(kept)
    text = F.array_join(F.transform(shown, lambda b: F.element_at("texts", b.getField("blocks") + 1)), "\n\n")
    out = whole.withColumn("hits", hits).select("page_id", "url", text.alias("text"))
    return out.withColumn("n_chars", F.length("text").cast("long"))
