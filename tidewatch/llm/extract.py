"""HTML extraction by site style trees: the branches a site repeats are noise, those that vary are its content.

1. Every page is parsed once into elements and text blocks. An element is named by its path of tags and classes.
2. The pages of a host are merged into one tree: for each path, how many pages have it, which sequences of children
   (presentation styles) occur how often, and which texts. These are counts, folded in each task before they meet, so a host
   with a third of all pages is no larger group than any other.
3. Importance of an element: entropy of its presentation styles, and of the contents of its leaves, to the base of the
   number of pages, discounted by depth as the tree is folded from the leaves up; times a weight below 1 for the roles that
   HTML itself names (navigation, footers, forms, adverts, comments). All branches are in the tree and are judged by this one
   number. A path seen on few pages has no entropy that says anything: 1 stands for it.
4. Low branches are removed from every page; what remains of the most important branch is the text.
"""

from __future__ import annotations

import hashlib
import re
from dataclasses import dataclass
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from tidewatch.llm.common import bounded_batches
from tidewatch.session import pinned

# fixed values: elements of HTML and what they are for
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
UNSEEN = frozenset(("script style noscript template head title svg math iframe object canvas audio video select option "
                    "datalist textarea button map").split())
INLINE = frozenset(("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s samp small "
                    "span strike strong sub sup time tt u var wbr").split())
NOISE_TAGS = frozenset("nav header footer aside form menu dialog".split())
NOISE_ROLES = frozenset(("navigation banner contentinfo complementary search form menu menubar dialog alert alertdialog "
                         "toolbar").split())
NOISE_NAMES = frozenset(("ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion nav navbar "
                         "navigation menu menubar submenu breadcrumb breadcrumbs header masthead topbar footer foot bottombar "
                         "sidebar aside rail widget widgets notice notices cookie cookies consent gdpr popup modal overlay "
                         "newsletter subscribe subscription signup login share sharing social form search comment comments "
                         "reply replies respond disqus related recommended pagination pager toolbar skip copyright legal "
                         "disclaimer alert").split())
MAIN_TAGS = frozenset("article main".split())
MAIN_ROLES = frozenset("article main".split())
# start tags that end an open paragraph, and end tags that HTML lets out
CLOSES_P = frozenset(("address article aside blockquote center details dialog dir div dl fieldset figcaption figure footer form h1 h2 h3 "
                      "h4 h5 h6 header hgroup hr main menu nav ol p pre section table ul").split())
SIBLINGS = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
            "th": ("td", "th"), "option": ("option",), "tbody": ("tbody", "thead", "tr", "td", "th"),
            "tfoot": ("tbody", "thead", "tr", "td", "th")}
SCOPES = frozenset("table ul ol dl body html article section main div nav aside header footer form".split())

TEXT_SCHEMA = "page_id long, url string, text string, n_chars long, removed int, removed_as_repeated int, removed_as_named int"
_CUT_TAG = re.compile(r"<[A-Za-z/!][^<>]*\Z")
HOST_PATTERN = r"^[A-Za-z][A-Za-z0-9+.-]*://(?:[^/?#@]*@)?([^/:?#]*)"


@dataclass(frozen=True)
class Options:
    """min_pages: pages a path must be on before its entropy counts; discount: weight of an element for each level that it
    lies below the judged one; threshold: importance below which a branch is noise; named: weight of an element whose
    tag, role or name is one of noise; broadcast_bytes: size up to which the low branches of all sites are broadcast."""

    min_pages: int = 8
    discount: float = 0.9
    threshold: float = 0.2
    named: float = 0.15
    broadcast_bytes: int = 64 << 20


def _code(*parts) -> int:
    return int.from_bytes(hashlib.blake2b("\x1f".join(map(str, parts)).encode("utf-8", "replace"), digest_size=8).digest(),
                          "big", signed=True)


def _judged(tag: str, names: str, role: str) -> tuple[str, bool, bool]:
    """(kind, main, noise) that an element's tag, class, id and role tell; numbers in names are left out of the kind."""
    words, roles = set(re.split(r"[^a-z]+", names)), set(role.split())
    kind = " ".join(sorted(re.sub(r"\d+", "", names).split()))
    main = tag in MAIN_TAGS or not MAIN_ROLES.isdisjoint(roles)
    named = not NOISE_NAMES.isdisjoint(words) and tag not in MAIN_TAGS and tag not in ("html", "body")
    return kind, main, tag in NOISE_TAGS or not NOISE_ROLES.isdisjoint(roles) or named


class Remembered(dict):
    """Results of a function, remembered up to a fixed number; unlike a cached function it is pickled by value."""

    def __init__(self, function):
        self.function = function

    def __missing__(self, key: tuple):
        if len(self) >= 1 << 16:
            self.clear()
        value = self[key] = self.function(*key)
        return value


class Memory:
    """What a task remembers about tags, names and paths over all its pages."""

    def __init__(self):
        self.judged, self.path = Remembered(_judged), Remembered(_code)


class Element:
    __slots__ = ("tag", "path", "main", "named", "beneath", "unseen", "plain", "children", "texts", "branch")

    def __init__(self, tag: str, attributes: dict[str, str], parent: Element | None, memory: Memory):
        names = f"{attributes.get('class', '')} {attributes.get('id', '')}".lower() if attributes else " "
        kind, main, noise = memory.judged[tag, names, attributes.get("role", "").lower()]
        self.tag, self.plain, self.children, self.texts = tag, not names.strip(), [], []
        hidden = bool(attributes) and ("hidden" in attributes or attributes.get("aria-hidden", "").lower() == "true" or
                                       "display:none" in attributes.get("style", "").replace(" ", "").lower())
        self.named = noise or hidden
        # whether an element is named as noise is part of its path, so that a path has one weight
        self.path = memory.path[parent.path if parent else 0, tag, kind, self.named]
        self.branch = (*parent.branch, self.path) if parent else ()
        self.main = (parent is not None and parent.main) or main
        self.beneath = parent is not None and (parent.named or parent.beneath)
        self.unseen = (parent is not None and parent.unseen) or tag in UNSEEN


@dataclass(frozen=True)
class Block:
    branch: tuple[int, ...]
    main: bool
    text: str


class PageParser(HTMLParser):
    """Elements of a page in one pass, with the end tags that HTML lets out, and its text blocks in page order."""

    def __init__(self, memory: Memory):
        super().__init__(convert_charrefs=True)
        self.memory = memory
        self.stack = [Element("", {}, None, memory)]
        self.elements: list[Element] = []
        self.blocks: list[Block] = []
        self.pieces: list[str] = []
        self.chain: list[Element] = []  # block elements around the pieces
        self.owner = self.stack[0]

    def finish_block(self) -> None:
        text = " ".join("".join(self.pieces).split())
        self.pieces = []
        if text:
            self.blocks.append(Block(self.chain[-1].branch if self.chain else (), self.owner.main, text))
            for element in self.chain:
                element.texts.append(text)

    def _close(self, tags: tuple[str, ...]) -> None:
        """Close the innermost open element of these tags, unless a scope lies between."""
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag in tags:
                del self.stack[k:]
                return
            if self.stack[k].tag in SCOPES:
                return

    def handle_starttag(self, tag, attrs):
        if tag in INLINE or tag == "br":
            if tag == "br" and self.pieces:
                self.pieces.append(" ")
        else:
            self.finish_block()
            if tag in CLOSES_P:
                self._close(("p",))
            if tag in SIBLINGS:
                self._close(SIBLINGS[tag])
        if tag in VOID:
            return
        parent = self.stack[-1]
        element = Element(tag, {k: v or "" for k, v in attrs}, parent, self.memory)
        if tag not in INLINE:
            if not parent.children or parent.children[-1] != tag:  # a run of like children is one
                parent.children.append(tag)
        if tag not in INLINE or element.named:
            self.elements.append(element)
        self.stack.append(element)

    def handle_startendtag(self, tag, attrs):
        self.handle_starttag(tag, attrs)
        if tag not in VOID:
            self.handle_endtag(tag)

    def handle_endtag(self, tag):
        if tag not in INLINE:
            self.finish_block()
        for k in range(len(self.stack) - 1, 0, -1):
            if self.stack[k].tag == tag:
                del self.stack[k:]
                return
            if tag in INLINE and self.stack[k].tag not in INLINE:
                return

    def handle_data(self, data):
        top = self.stack[-1]
        if top.unseen:
            return
        if self.pieces and (top.named or top.beneath, top.main) != (self.owner.named or self.owner.beneath, self.owner.main):
            self.finish_block()
        if not self.pieces:
            self.owner, self.chain = top, [e for e in self.stack[1:] if e.tag not in INLINE or e.named]
        self.pieces.append(data)


def parse(html: str | None, memory: Memory | None = None) -> PageParser:
    page = PageParser(memory or Memory())
    page.feed(_CUT_TAG.sub("", html or ""))  # a page may end inside a tag
    page.close()
    page.finish_block()
    return page


def page_nodes(page: PageParser) -> list[dict]:
    """One row for each path of the page that has text: the branch above it, child sequence, content, and what names say."""
    rows: dict[int, dict] = {}
    for element in page.elements:
        if not element.texts:
            continue
        content = 0 if element.children else _code(*element.texts)  # only that of leaves is ever looked at
        row = rows.get(element.path)
        if row is None:
            rows[element.path] = {
                "path": element.path, "branch": element.branch, "style": _code(*element.children), "content": content,
                "leaf": not element.children, "named": element.named, "beneath": element.named or element.beneath,
                "guarded": not element.named and (element.tag in ("html", "body") or element.main and element.plain)}
        else:
            row["content"], row["style"] = _code(row["content"], content), _code(row["style"], *element.children)
            row["leaf"] = row["leaf"] and not element.children
    return list(rows.values())


_NODE_ROWS = pa.schema([("host", pa.string()), ("path", pa.int64()), ("branch", pa.list_(pa.int64())), ("style", pa.int64()),
                        ("content", pa.int64()), ("leaf", pa.bool_()), ("named", pa.bool_()), ("beneath", pa.bool_()),
                        ("guarded", pa.bool_())])
_NODE_DDL = ("host string, path long, branch array<long>, style long, content long, leaf boolean, named boolean, "
             "beneath boolean, guarded boolean")


def _nodes(batches):
    memory = Memory()
    for batch in batches:
        out = []
        for host, html in zip(*batch.columns, strict=True):
            out += [row | {"host": host.as_py()} for row in page_nodes(parse(html.as_py(), memory))]
        yield pa.RecordBatch.from_pylist(out, _NODE_ROWS)


def _entropy(nodes: DataFrame, kind: str) -> DataFrame:
    """Entropy of a column's values over the pages of a path, to the base of the number of pages; 1 for a single page."""
    each = nodes.groupBy("host", "path", kind).agg(F.count("*").alias("k"))
    folded = each.groupBy("host", "path").agg(F.sum("k").alias("pages"), F.sum(F.col("k") * F.log("k")).alias("klogk"))
    spread = 1 - F.col("klogk") / (F.col("pages") * F.log("pages"))
    return folded.select("host", "path", "pages", F.when(F.col("pages") > 1, F.greatest(F.lit(0.0), spread)).otherwise(1.0)
                         .alias(kind))


def style_tree(nodes: DataFrame, options: Options) -> DataFrame:
    """(host, path, guarded, entropy, importance) of every element of the sites' merged trees.

    A leaf's own entropy is that of its contents, any other element's that of its child sequences; `entropy` is the mean
    over the element's branch, weighted by pages, discounted by the distance below the element, and with `options.named` for
    what lies under a name of noise; it is 1 on fewer than min_pages pages. importance is entropy times the element's weight.
    """
    shape = nodes.groupBy("host", "path").agg(
        F.first("branch").alias("branch"), F.bool_and("leaf").alias("leaf"), F.bool_or("named").alias("named"),
        F.bool_or("beneath").alias("beneath"), F.bool_and("guarded").alias("guarded"))
    tree = pinned(shape.join(_entropy(nodes, "style"), ["host", "path"])
                  .join(_entropy(nodes, "content").drop("pages"), ["host", "path"]))
    weight = F.when(F.col("beneath"), options.named).otherwise(1.0) * F.col("pages") * F.pow(
        F.lit(options.discount), F.size("branch") - 1 - F.col("at"))
    own = F.when(F.col("leaf"), F.col("content")).otherwise(F.col("style"))
    above = tree.select("host", own.alias("own"), "pages", "beneath", "branch", F.posexplode("branch").alias("at", "path"))
    mean = above.groupBy("host", "path").agg((F.sum(weight * F.col("own")) / F.sum(weight)).alias("mean"))
    entropy = F.when(F.col("pages") >= options.min_pages, F.col("mean")).otherwise(1.0)
    return (tree.join(mean, ["host", "path"]).select("host", "path", "guarded", "named", entropy.alias("entropy"))
            .select("host", "path", "guarded", "entropy",
                    (F.col("entropy") * F.when(F.col("named"), options.named).otherwise(1.0)).alias("importance")))


def lone_page(page: PageParser, options: Options = Options()) -> frozenset[int]:
    """The low paths of a page of an unknown site: no entropy is known, so weights alone are left."""
    return frozenset(e.path for e in page.elements if e.named and options.named < options.threshold)


def main_text(html: str | None, low: dict[int, bool] | None = None, memory: Memory | None = None) -> tuple[str, list[int]]:
    """(text, blocks removed: all, for their entropy, for the weight of names): the rest of the main element, or of the page
    if it names none. low: the low paths of the page's site, and whether entropy alone makes them so.
    """
    page = parse(html, memory)
    if low is None:
        low = dict.fromkeys(lone_page(page), False)
    kept, repeated, named = [], 0, 0
    for block in page.blocks:
        causes = [low[path] for path in block.branch if path in low]
        if not causes:
            kept.append(block)
        repeated, named = repeated + any(causes), named + (bool(causes) and not any(causes))
    if any(b.main for b in kept):
        kept = [b for b in kept if b.main]
    return "\n".join(b.text for b in kept), [len(page.blocks) - len(kept), repeated, named]


def _extract(batches):
    memory = Memory()
    for batch in batches:
        texts, removed = [], []
        for html, branches in zip(batch.column(2), batch.column(3), strict=True):
            low = {b["path"]: b["repeated"] for b in branches.as_py() or ()}
            text, gone = main_text(html.as_py(), low, memory)
            texts.append(text)
            removed.append(gone)
        yield pa.RecordBatch.from_pydict({
            "page_id": batch.column(0), "url": batch.column(1), "text": pa.array(texts, pa.string()),
            "n_chars": pa.array([len(t) for t in texts], pa.int64()), **{name: pa.array([r[k] for r in removed], pa.int32())
               for k, name in enumerate(("removed", "removed_as_repeated", "removed_as_named"))}})


def extracted(pages: DataFrame, page_id: str = "page_id", url: str = "url", html: str = "html",
              options: Options = Options()) -> DataFrame:
    """(page_id, url, text, n_chars, removed, removed_as_repeated, removed_as_named) for every page: the blocks left out, those
    in a branch of low entropy, and those in a branch that is low by the weight of its names only.

    A null or empty html gives an empty text. Pages without a host in their url form a site of their own. Repeated rows
    give repeated results; an empty table gives no rows; other columns are ignored. Elements that a page's main element
    holds without a class or id are never judged by repetition, so that copies of a page keep their text.
    """
    bounded_batches(pages.sparkSession)
    rows = pages.select(F.col(page_id).cast("long").alias("page_id"), F.col(url).cast("string").alias("url"),
                        F.col(html).cast("string").alias("html"))
    rows = rows.withColumn("host", F.lower(F.regexp_extract(F.coalesce("url", F.lit("")), HOST_PATTERN, 1)))
    nodes = pinned(rows.select("host", "html").mapInArrow(_nodes, _NODE_DDL))
    low = pinned(style_tree(nodes, options).where((F.col("importance") < options.threshold) & ~F.col("guarded"))
                 .groupBy("host").agg(F.collect_set(F.struct("path", (F.col("entropy") < options.threshold).alias("repeated")))
                                      .alias("low")))
    paths = low.agg(F.coalesce(F.sum(F.size("low")), F.lit(0))).first()[0]
    side = low
    if paths * 16 <= options.broadcast_bytes:
        side = F.broadcast(side)
    return (rows.join(side, "host", "left").select("page_id", "url", "html", "low")
            .mapInArrow(_extract, TEXT_SCHEMA))
