"""Main text of web pages with a site style tree.

The DOMs of a host's pages are merged into one tree: a node stands for the
elements that are reached by the same path of styles (element name and class
words, without digits), so the paragraphs of all articles of a host are one
node. A node has two kinds of importance, each an entropy with the number of
pages that show the node as base:

* of its presentation: 1 if every page shows other sequences of children there,
  0 if all show the same;
* of each feature of its content (the clauses of its own text, its link target):
  1 less the entropy of where the feature occurs, so 1 for what one page has and
  0 for what all pages have alike.

An element's own importance is the mean of its features, weighed by words, or
without text that of its presentation; a branch combines it with its children,
(1 - g^l) * own + g^l * mean of children for l children with text. A branch is
noise if its importance is below ``LOW`` and so is that of every branch in it.
Copies of a page count once per host, and only nodes that ``MIN_PAGES`` pages
show are judged. Inside a line of text nothing is cut: inline elements go only
with a parent that has no text of its own.

Declared roles are known before: menus, footers, sidebars, notices, adverts,
forms, comments and the like (by tag, ARIA role, class or id) go on every page,
whatever their text, and where an article or main part is declared, the tree
judges the branches inside it; elsewhere it judges the body. A page that would
lose more than ``COPY_SHARE`` of a declared part is a near copy of others, not
furniture, and keeps the part whole; a page that would lose everything keeps
its body without declared noise.

Every page is parsed once; its elements go into the tree as (node, feature)
rows. Only pages that show a feature of low importance are parsed again, as no
other page can lose a branch.

Character references are decoded, white space within a block (a line break
included) becomes one space, and blocks are joined by one \\n.

Defined results: null or empty html gives an empty text. Rows equal in all of
page_id, url and html get equal texts, each its own row. Unclosed and unknown
tags, stray < and text without markup are taken as they come.
"""

from __future__ import annotations

import html
import re
from collections.abc import Iterator

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from vireo.llm.common import frugal, slices, written
from vireo.llm.url_rules import host_of, small

#: Importance below which a branch is noise: a feature is that low on all of 5 pages, 26 of 40, 160 of 320.
LOW = 0.12
MIN_PAGES = 5
DAMPING = 0.9
#: Share of the characters of a declared part that noise inside it may have.
COPY_SHARE = 0.5

# Element names of HTML by their part in a page, and names that sites give to their parts.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes iframe".split())
BLOCK = frozenset("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form "
                  "h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre section summary table tbody td "
                  "tfoot th thead tr ul".split())
NOISE_TAGS = frozenset("head nav footer aside form script style noscript template iframe svg canvas select button textarea input object "
                       "embed audio video menu dialog title noembed noframes xmp math datalist".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form alert alertdialog dialog menu menubar toolbar".split())
NOISE_NAMES = frozenset("ad ads adv advert adverts advertisement advertising adbox adsense banner sponsor sponsored promo promotion "
                        "sidebar sidebars aside menu menus nav navbar navigation navi breadcrumb breadcrumbs footer footnav "
                        "comment comments commentlist respond reply replies discussion disqus cookie cookies consent gdpr notice notices notification alert "
                        "popup modal overlay newsletter subscribe subscription signup login share sharing social related recommended "
                        "widget widgets toolbar pagination pager search searchbox skip skiplink paywall".split())
MAIN_IDS = frozenset("article main content main-content maincontent".split())
PAGE_HEAD_NAMES = frozenset("header masthead topbar pagehead sitehead".split())
#: What a start tag closes if it is open, and the elements that bound the search for it.
CLOSES = {"li": ("li", "ul ol menu"), "dt": ("dt dd", "dl"), "dd": ("dt dd", "dl"), "option": ("option", "select datalist optgroup"),
          "optgroup": ("option optgroup", "select"), "td": ("td th", "table tr"), "th": ("td th", "table tr"), "tr": ("tr", "table"),
          "thead": ("thead tbody tfoot", "table"), "tbody": ("thead tbody tfoot", "table"), "tfoot": ("thead tbody tfoot", "table")}
P_BOUNDS = "table td th caption button object template"

TOKEN = re.compile(r"""<!--(?:>|->|.*?(?:--!?>|\Z))|<!\[CDATA\[.*?\]\]>|<[!?][^>]*+>|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"']++|"[^"]*+"|'[^']*+')*+)>|<(/?)([a-zA-Z][^\s/>]*+)([^>]*+)>""", re.S)
ATTRIBUTE = re.compile(r"""([^\s"'<>/=]++)(?:\s*+=\s*+("[^"]*+"|'[^']*+'|[^\s"'=<>`]++))?""")
NAME_PART = re.compile(r"[A-Z]?[a-z0-9]+|[A-Z]+(?![a-z])")

CLAUSE = re.compile(r"[.!?;:|\u00b7\u2022]+(?:\s+|$)|\s[|\u00b7\u2022\u2013\u2014]\s")
STYLE_PART = re.compile(r"[^\W\d_]+")

NODES = pa.struct([("node", pa.int64()), ("style", pa.int64()), ("feature", pa.int64()), ("times", pa.int32())])
NODES_SCHEMA = "array<struct<node: bigint, style: bigint, feature: bigint, times: int>>"


class Element:
    """An element: name, style, link target, declared part in the page, and its text pieces and children in order."""

    __slots__ = ("tag", "label", "target", "noise", "main", "parent", "inner")

    def __init__(self, tag: str, label: str, target: str, noise: bool, main: bool, parent: Element | None):
        self.tag, self.label, self.target, self.noise, self.main, self.parent = tag, label, target, noise, main, parent
        self.inner: list[str | Element] = []


def _element(tag: str, attributes: str, parent: Element, in_main: bool) -> Element:
    label, target, noise, main = tag, "", tag in NOISE_TAGS, tag in ("article", "main")
    if tag == "header" and not in_main:
        noise = True
    if attributes:
        given = {k.lower(): html.unescape(v.strip("\"'")) for k, v in ATTRIBUTE.findall(attributes)}
        role = given.get("role", "").lower()
        names = f"{given.get('class', '')} {given.get('id', '')}"
        label = ".".join([tag, *sorted(set(STYLE_PART.findall(given.get("class", ""))))])
        target = given.get("href") or given.get("src") or ""
        parts = {p.lower() for p in NAME_PART.findall(names)}
        main = main or role in ("main", "article") or given.get("id", "").lower() in MAIN_IDS or given.get("itemprop", "").lower() == "articlebody"
        hidden = "hidden" in given or given.get("aria-hidden") == "true" or "display:none" in given.get("style", "").replace(" ", "").lower()
        noise = noise or hidden or role in NOISE_ROLES or (tag not in ("html", "body") and bool(parts & NOISE_NAMES)) or (not in_main and bool(parts & PAGE_HEAD_NAMES))
    return Element(tag, label, target, noise, main, parent)


class Builder:
    """A DOM under construction: the open element, and how many open ones are declared main parts."""

    def __init__(self) -> None:
        self.root = self.at = Element("", "", "", False, False, None)
        self.in_main = 0

    def nearest(self, names: str, bounds: str) -> Element | None:
        wanted, stop, node = names.split(), bounds.split(), self.at
        while node is not self.root and node.tag not in stop:
            if node.tag in wanted:
                return node
            node = node.parent
        return None

    def leave(self, node: Element | None) -> None:
        while node is not None and self.at is not node.parent:
            self.in_main -= self.at.main and not self.at.noise
            self.at = self.at.parent

    def start(self, name: str, attributes: str) -> None:
        if name in BLOCK:
            self.leave(self.nearest("p", P_BOUNDS))
        if name in CLOSES:
            self.leave(self.nearest(*CLOSES[name]))
        child = _element(name, attributes, self.at, self.in_main > 0)
        self.at.inner.append(child)
        if name not in VOID and name not in RAW:
            self.in_main += child.main and not child.noise
            self.at = child

    def end(self, name: str) -> None:
        """Close the nearest open element of that name; an inline end tag does not close blocks."""
        node = self.at
        while node is not self.root and node.tag != name:
            if name not in BLOCK and node.tag in BLOCK:
                return
            node = node.parent
        if node is not self.root:
            self.leave(node)


def parse(source: str) -> Element:
    """The DOM of a page; end tags that HTML lets authors leave out are supplied."""
    dom, place, lowered = Builder(), 0, ""
    while (found := TOKEN.search(source, place)) is not None:
        if found.start() > place:
            dom.at.inner.append(html.unescape(source[place:found.start()]))
        place = found.end()
        closing, name, attributes = found.group(1, 2, 3) if found.group(2) else found.group(4, 5, 6)
        if not name:
            continue
        name = name.lower()
        if closing:
            dom.end(name)
            continue
        dom.start(name, attributes.strip().rstrip("/"))
        if name in RAW:  # up to its end tag it is text, and never page text
            lowered = lowered or source.lower()
            end = lowered.find(f"</{name}", place)
            end = source.find(">", end) if end >= 0 else -1
            place = end + 1 if end >= 0 else len(source)
    if place < len(source):
        dom.at.inner.append(html.unescape(source[place:]))
    return dom.root


def _hash(*parts: object) -> int:
    return xxhash.xxh64_intdigest(repr(parts)) - (1 << 63)


def content_features(element: Element) -> dict[int, int]:
    """Feature: words, of an element's own text (its clauses) and link target."""
    own = " ".join(" ".join(c for c in element.inner if isinstance(c, str)).split())
    found = {_hash("text", clause.lower()): clause.count(" ") + 1 for clause in CLAUSE.split(own) if clause}
    if element.target:
        found[_hash("target", element.target)] = 1
    return found


def style_nodes(root: Element, host: str) -> list[tuple[Element, int, dict[int, int]]]:
    """(element, node of the host's style tree, features) of what may be page text, parents first."""
    found, todo = [], [(root, _hash(host), not main_parts(root))]
    while todo:
        element, node, within = todo.pop()
        within = within or element.main
        if within:
            found.append((element, node, content_features(element)))
        todo += [(c, _hash(node, c.label), within) for c in element.inner if not isinstance(c, str) and not c.noise and c.tag not in VOID]
    return found


def node_rows(source: str | None, host: str | None) -> list[tuple[int, int | None, int | None, int]]:
    """(node, style, None, 1) once for every node of a page and (node, None, feature, times) for its features."""
    sequences: dict[int, list[str]] = {}
    features: dict[tuple[int, int], int] = {}
    for element, node, shown in style_nodes(parse(source), host or "") if source else ():
        sequences.setdefault(node, []).append(" ".join(c.label for c in element.inner if not isinstance(c, str) and not c.noise))
        for feature in shown:
            features[node, feature] = features.get((node, feature), 0) + 1
    return [(node, _hash(*shown), None, 1) for node, shown in sequences.items()] + [(node, None, f, n) for (node, f), n in features.items()]


def blocks_of(tops: list[Element], gone: set[int]) -> list[str]:
    """The text blocks below ``tops``, without noise and without the elements in ``gone`` (by id())."""
    blocks: list[str] = []
    run: list[str] = []

    def close() -> None:
        if text := " ".join("".join(run).split()):
            blocks.append(text)
        run.clear()

    for top in tops:
        todo: list[str | Element | None] = [top]
        while todo:
            item = todo.pop()
            if item is None:
                close()
            elif isinstance(item, str):
                run.append(item)
            elif item.tag == "br":
                run.append(" ")
            elif not item.noise and id(item) not in gone:
                if item.tag in BLOCK or item is top:
                    close()
                    todo.append(None)
                todo += reversed(item.inner)
    return blocks


def main_parts(root: Element) -> list[Element]:
    """The outermost declared articles and main parts, in page order."""
    found, todo = [], [root]
    while todo:
        element = todo.pop()
        if element.noise:
            continue
        if element.main:
            found.append(element)
        else:
            todo += [c for c in reversed(element.inner) if not isinstance(c, str)]
    return found


def low_branches(root: Element, host: str, importance: dict[tuple[int, int | None], float]) -> set[int]:
    """ids of the elements whose branch is noise, given the importance of (node, feature), and of (node, None) for the presentation."""
    order = style_nodes(root, host)
    branch: dict[int, float] = {}
    noise: dict[int, bool] = {}
    texts: set[int] = set()
    for element, node, features in reversed(order):
        below = [id(c) for c in element.inner if not isinstance(c, str) and id(c) in branch]
        if not features and not below:
            continue  # shows nothing
        judged = (node, None) in importance
        words = sum(features.values())
        own = sum(w * importance.get((node, f), 1.0) for f, w in features.items()) / words if features else importance.get((node, None), 1.0)
        keep = DAMPING ** len(below)
        branch[id(element)] = value = (1 - keep) * own + keep * sum(branch[c] for c in below) / len(below) if below else own
        noise[id(element)] = judged and value < LOW and (not features or own < LOW) and all(noise[c] for c in below)
        if any(isinstance(c, str) and c.strip() for c in element.inner):
            texts.add(id(element))
    return {id(e) for e, _, _ in order if noise.get(id(e)) and e.parent is not None and e.tag not in ("html", "body")
            and (e.tag in BLOCK or id(e.parent) not in texts)}


def page_text(source: str | None, host: str | None = None, importance: dict[tuple[int, int | None], float] | None = None) -> str:
    """The text of a page without declared noise, and without the low branches if ``importance`` is given."""
    if not source:
        return ""
    root = parse(source)
    declared = main_parts(root)
    tops = declared or [root]
    whole = "\n".join(blocks_of(tops, set()))
    if not importance:
        return whole
    left = "\n".join(blocks_of(tops, low_branches(root, host or "", importance)))
    return left if left and (not declared or len(left) >= (1 - COPY_SHARE) * len(whole)) else whole


def page_trees(pages: DataFrame) -> DataFrame:
    """(page_id, url, page, text, nodes) of (page_id, url, host, page, html): text before the tree is known, and the page's part of the tree."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(4)):
                part = batch.slice(a, b - a)
                hosts, sources = part.column(2).to_pylist(), part.column(4).to_pylist()
                rows = [node_rows(source, host) for source, host in zip(sources, hosts, strict=True)]
                flat = [r for page in rows for r in page]
                ends = [0]
                for page in rows:
                    ends.append(ends[-1] + len(page))
                columns = [pa.array([r[i] for r in flat], NODES.field(i).type) for i in range(len(NODES))]
                nodes = pa.ListArray.from_arrays(pa.array(ends, pa.int32()), pa.StructArray.from_arrays(columns, fields=list(NODES)))
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), part.column(3), pa.array([page_text(x) for x in sources], pa.string()), nodes],
                                                 names=["page_id", "url", "page", "text", "nodes"])

    kind = pages.schema["page_id"].dataType.simpleString()
    return (pages.select("page_id", "url", "host", "page", "html")
            .mapInArrow(frugal(run), f"page_id {kind}, url string, page long, text string, nodes {NODES_SCHEMA}"))


def importances(nodes: DataFrame, copies: DataFrame, min_pages: int = MIN_PAGES) -> DataFrame:
    """(node, feature, importance) of the nodes that at least ``min_pages`` different
    pages show: of each feature that several of them have, and (feature null) of the
    presentation. ``copies`` (page, copies) has the pages that occur more than once;
    each copy counts for its part."""
    weighed = nodes.join(small(copies, 24 * copies.count()), "page", "left").withColumn("w", 1 / F.coalesce("copies", F.lit(1)))
    styles = written(weighed.where("style IS NOT NULL").groupBy("node", "style").agg(F.sum("w").alias("k")), "node-styles")
    shared = written(styles.groupBy("node").agg(F.sum("k").alias("m"), F.sum(F.col("k") * F.log("k")).alias("klogk"))
                     .where(F.col("m") > min_pages - 0.5), "shared-nodes")
    looks = shared.select("node", F.lit(None).cast("long").alias("feature"), (1 - F.col("klogk") / (F.col("m") * F.log("m"))).alias("importance"))
    # where a feature occurs: p = times / total, so the entropy is log(total) - sum(times * log(times)) / total
    spread = weighed.where("feature IS NOT NULL").groupBy("node", "feature").agg(
        F.sum("w").alias("pages"), F.sum(F.col("w") * F.col("times")).alias("total"), F.sum(F.col("w") * F.col("times") * F.log("times")).alias("tlogt"))
    known = spread.where("pages > 1.5").join(small(shared, 24 * shared.count()), "node")
    content = known.select("node", "feature", F.greatest(F.lit(0.0), 1 - (F.log("total") - F.col("tlogt") / F.col("total")) / F.log("m")).alias("importance"))
    return looks.unionByName(content)


def main_texts(pages: DataFrame, key: str = "page_id", url: str = "url", source: str = "html") -> DataFrame:
    """(page_id, url, text, n_chars) of every page."""
    whole = pages.select(pages[key].alias("page_id"), pages[url].cast("string").alias("url"), pages[source].cast("string").alias("html"))
    keyed = whole.withColumn("host", host_of(F.col("url"))).withColumn("page", F.xxhash64("host", "html"))
    kind = whole.schema["page_id"].dataType.simpleString()
    trees = written(page_trees(keyed), "page-trees")
    copies = written(trees.groupBy("page").agg(F.count("*").alias("copies")).where("copies > 1"), "page-copies")
    nodes = trees.select("page", F.explode("nodes").alias("at")).select("page", "at.*")
    judged = written(importances(nodes, copies), "style-importances")
    low = judged.where((F.col("importance") < LOW) & F.col("feature").isNotNull()).select("node", "feature")
    touched = written(nodes.join(small(low, 24 * low.count()), ["node", "feature"], "left_semi").select("page").distinct(), "touched-pages")
    few = small(touched, 24 * touched.count())

    def pruned(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            for a, b in slices(batch.column(3)):
                part = batch.slice(a, b - a)
                texts = [page_text(t, host, {(j["node"], j["feature"]): j["importance"] for j in known or ()})
                         for host, t, known in zip(part.column(2).to_pylist(), part.column(3).to_pylist(), part.column(4).to_pylist(), strict=True)]
                yield pa.RecordBatch.from_arrays([part.column(0), part.column(1), pa.array(texts, pa.string())], names=["page_id", "url", "text"])

    own = nodes.join(few, "page", "left_semi").select("page", "node", "feature").distinct()
    same = (own["node"] == judged["node"]) & own["feature"].eqNullSafe(judged["feature"])
    known = (own.join(small(judged, 32 * judged.count()), same).groupBy(own["page"])
             .agg(F.collect_list(F.struct(judged["node"], judged["feature"], judged["importance"])).alias("judged")))
    through = keyed.join(few, "page", "left_semi").join(known, "page")
    texts = through.select("page_id", "url", "host", "html", "judged").mapInArrow(frugal(pruned), f"page_id {kind}, url string, text string")
    rest = trees.join(few, "page", "left_anti").select("page_id", "url", "text")
    return rest.unionByName(texts).withColumn("n_chars", F.length("text").cast("long"))
