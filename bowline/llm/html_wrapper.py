"""Main-text extraction by wrapper induction.

1. Every page is parsed into a tree of block elements in which consecutive
   siblings of one kind (tag and class) are one node, so a list of any length
   is one repeated slot. Its skeleton, and a hash of every text block with the
   node that holds it, are counted per host.
2. A host's most frequent skeleton is its wrapper. Every other skeleton of the
   host is aligned with it by simple tree matching (largest order-preserving
   matching of equal-labelled nodes), once for each distinct skeleton.
3. Per wrapper slot, over the distinct pages of the host (pages with the same
   blocks count once): pages, blocks (a value once a page), distinct blocks, the
   share of the most frequent one, characters, and those of them in links. A slot
   whose blocks repeat, or that is mostly links, is template; a slot whose blocks
   vary is content. In a run of like siblings, which is one slot, single lines can
   be template: those that nearly all pages have. The counts are sums of hashed
   keys, so a host with a third of all pages is spread over many tasks.
4. Each page is parsed again, aligned with its host's wrapper, and its blocks
   are kept or dropped by their slot. Element roles (nav, footer, forms, hidden
   parts) are always template; inside an article or main element only a slot or
   line that is all but constant on many pages is, and a constant heading only if
   what it heads goes too. Blocks outside such elements go by their slot, and stay
   where it tells nothing. A class name or id (a whole one) that tells template
   counts as well, unless an article or main element without such a name lies below
   it, or the slot varies; the latter does not count beside the text of an article or
   main element. Adverts, reader comments and related boxes vary by nature: their
   names count in any slot and also around an article element.

A page's text is its kept blocks in page order, one a line, with references
decoded and white space joined. Wrappers (a few hundred bytes a host) are
broadcast below the session's broadcast limit and joined by host beyond it.

Defined results: null or empty html: empty text. Null urls are pages of one
unnamed host. Pages of hosts too small to tell (fewer than ``MIN_PAGES`` distinct
pages) go by element roles alone, and where such a page has text in an article or
main element, by these elements. Unclosed, unopened and truncated markup is
tolerated. Repeated rows all come out but count once; extra columns of the input
stay out.
"""

from __future__ import annotations

import html as htmllib
import json
import re
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StringType

from bowline.llm.common import Scratch, arrow_map
from bowline.session import broadcast_limit_bytes

MIN_PAGES = 5             # distinct pages a slot needs before it can be template
MAX_DISTINCT = 0.5        # template: at most this share of its blocks is distinct
ARTICLE_PAGES = 20        # the same two inside an article: pages needed, and
ARTICLE_SHARE = 0.9       # the share that the most frequent block must have
LINK_SHARE = 0.6          # template: at least this share of its characters is in links

# HTML element names by their part in a page.
SKIPPED = frozenset("script style noscript template iframe object svg head title".split())
BOILERPLATE = frozenset("nav header footer aside form button select option input textarea label dialog menu "
                        "fieldset".split())
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
BLOCK = frozenset("html body address article aside blockquote center dd details dialog dir div dl dt fieldset "
                  "figcaption figure footer form h1 h2 h3 h4 h5 h6 header hgroup hr li main menu nav ol p pre "
                  "section summary table tbody td tfoot th thead tr ul button select option textarea label".split())
LANDMARK = frozenset("article main".split())
CLOSES_P = BLOCK - {"button", "select", "option", "textarea", "label"}
# Elements that end an open element of the same set (nearest list or table first).
SIBLINGS = {"li": ({"li"}, {"ul", "ol", "menu", "dir"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
            "tr": ({"tr", "td", "th"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}),
            "th": ({"td", "th"}, {"tr", "table"}), "option": ({"option"}, {"select"})}
ROLE_WORDS = frozenset("ad ads advert adverts advertisement advertising sponsored promo promotion banner nav navbar "
                       "navigation menu breadcrumb breadcrumbs sidebar footer masthead comment comments "
                       "discussion replies respond cookie cookies consent notice notices popup modal newsletter "
                       "subscribe share sharing social related widget toolbar pagination pager login search "
                       "copyright disclaimer skip".split())
# Names of what differs from page to page and is template all the same.
ALWAYS = frozenset("ad ads advert adverts advertisement advertising sponsored promo promotion comment comments "
                   "discussion replies respond related newsletter subscribe cookie cookies consent".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
CELLS = frozenset("td th dt dd li summary figcaption".split())     # one value may stand on all pages there
ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert alertdialog".split())

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:=\s*\"[^\"]*\"|=\s*'[^']*'|[^>])*+)(?:>|\Z)"
                  r"|<[!?][^>]*(?:>|\Z)|</[^a-zA-Z][^>]*(?:>|\Z)", re.S)
# One attribute, its quoted or bare value consumed with it.
_ATTR = re.compile(r"(=?[^\s/>=]+)(?:\s*=\s*(?:\"([^\"]*)(?:\"|\Z)|'([^']*)(?:'|\Z)|([^\s>]+)))?")
_USED = frozenset("class id role hidden aria-hidden".split())
_NAME = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")


def _attributes(raw: str) -> dict[str, str]:
    out: dict[str, str] = {}
    for m in _ATTR.finditer(raw):
        name = m[1].lower()
        if name in _USED:
            out.setdefault(name, m[2] or m[3] or m[4] or "")
    return out


class Page:
    """Nodes as (label, parent), in the order in which they are first opened,
    and text blocks as (node, text, dropped by role, dropped by name: 1 unless the
    slot varies, 2 always, inside a landmark); ``links`` has each block's characters
    in links, ``tags`` the element that holds it."""

    def __init__(self, source: str):
        self.labels, self.parents, self.kids = ["#"], [-1], [[]]
        # elements named like template: the one around it, landmark below, always
        self.named: list[list] = []
        self.found: list[tuple[int, str, bool, int, bool]] = []
        self.links: list[int] = []
        self.tags: list[str] = []
        self.linked: list[str] = []      # text of the present block inside links
        self.in_link = False
        # open elements: tag, node, boilerplate so far, innermost named, landmark so far
        self.open = [("#", 0, False, -1, False)]
        self.buffer: list[str] = []
        self._parse(source)
        # A landmark below an element is below those around it too.
        self.blocks = [(node, text, boiler, self._name(k), mark) for node, text, boiler, k, mark in self.found]

    def _name(self, k: int) -> int:
        """What the names around a block say: 0 nothing, 1 template, 2 always so."""
        said = 0
        while k >= 0:
            outer, below, always = self.named[k]
            said = max(said, 0 if below else 2 if always else 1)
            k = outer
        return said

    def _flush(self) -> None:
        if self.buffer:
            text = _SPACE.sub(" ", htmllib.unescape("".join(self.buffer))).strip()
            self.buffer.clear()
            if text:
                self.found.append((self.open[-1][1], text, *self.open[-1][2:]))
                self.tags.append(self.open[-1][0])
                self.links.append(sum(len(htmllib.unescape(x).strip()) for x in self.linked))
            self.linked.clear()

    def _push(self, tag: str, attrs: dict[str, str]) -> None:
        _, parent, boiler, named, mark = self.open[-1]
        given = f"{attrs.get('class', '')} {attrs.get('id', '')}".lower()
        names = _NAME.findall(given)
        label = f"{tag}.{names[0]}" if names else tag
        kids = self.kids[parent]
        if kids and self.labels[kids[-1]] == label:
            node = kids[-1]                               # a run of one kind
        else:
            node = len(self.labels)
            self.labels.append(label)
            self.parents.append(parent)
            self.kids.append([])
            kids.append(node)
        landmark = tag in LANDMARK or attrs.get("role", "").lower() in ("main", "article")
        role = (tag in BOILERPLATE and not (tag == "header" and mark) or attrs.get("role", "").lower() in ROLES
                or "hidden" in attrs or attrs.get("aria-hidden", "").lower() == "true")
        templatelike = tag not in ("body", "html", "main") and not ROLE_WORDS.isdisjoint(given.split())
        if landmark and not templatelike:
            k = named
            while k >= 0:
                # comments are often article elements themselves
                self.named[k][1] |= not self.named[k][2] or tag == "main"
                k = self.named[k][0]
        elif templatelike and not (landmark and ALWAYS.isdisjoint(given.split())):
            self.named.append([named, False, not ALWAYS.isdisjoint(given.split())])
            named = len(self.named) - 1
        self.open.append((tag, node, boiler or role, named, mark or landmark))

    def _close_to(self, tags, stop=()) -> None:
        for k in range(len(self.open) - 1, 0, -1):
            if self.open[k][0] in tags:
                del self.open[k:]
                return
            if self.open[k][0] in stop:
                return

    def _parse(self, s: str) -> None:
        at, n = 0, len(s)
        while at < n:
            m = _TAG.search(s, at)
            self.buffer.append(s[at:m.start()] if m else s[at:])
            if self.in_link:
                self.linked.append(self.buffer[-1])
            if not m:
                break
            at = m.end()
            tag = (m[2] or "").lower()
            if not tag:
                continue
            if m[1]:
                if tag in BLOCK:
                    self._flush()
                    self._close_to({tag})
                elif tag == "a":
                    self.in_link = False
                continue
            if tag in SKIPPED:
                if not m[3].endswith("/"):
                    end = re.compile(f"</{re.escape(tag)}\\b[^>]*(?:>|\\Z)", re.I).search(s, at)
                    # head ends where the body starts when its end tag is missing
                    if tag == "head" and not end:
                        end = re.compile(r"(?=<body\b)", re.I).search(s, at)
                    at = end.end() if end else n
                continue
            if tag == "br":
                self.buffer.append(" ")
            if tag == "a":
                self.in_link = True
            if tag not in BLOCK:
                continue
            self._flush()
            self.in_link = False
            if tag in CLOSES_P:
                self._close_to({"p"}, {"article", "section", "div", "td", "li", "blockquote", "body"})
            if tag in SIBLINGS:
                self._close_to(*SIBLINGS[tag])
            if tag not in VOID:
                self._push(tag, _attributes(m[3]) if m[3] else {})
        self._flush()

    def skeleton(self) -> str:
        return " ".join(f"{p}:{x}" for p, x in zip(self.parents[1:], self.labels[1:]))


@lru_cache(maxsize=4096)
def _tree(skeleton: str) -> tuple[list[str], list[list[int]]]:
    labels, kids = ["#"], [[]]
    for k, item in enumerate(skeleton.split(" ") if skeleton else [], 1):
        parent, _, label = item.partition(":")
        labels.append(label)
        kids.append([])
        kids[int(parent)].append(k)
    return labels, kids


@lru_cache(maxsize=4096)
def align(page: str, wrapper: str) -> dict[int, int]:
    """Simple tree matching: page node -> wrapper node, roots matched, a node
    only below matched parents, siblings in order, as many pairs as possible."""
    la, ka = _tree(page)
    lb, kb = _tree(wrapper)
    # Size of the best matching of two equal-labelled subtrees and the children
    # it pairs (their own subtrees are in ``memo``), pairs below first.
    memo: dict[tuple[int, int], tuple[int, list[tuple[int, int]]]] = {}
    todo = [(0, 0)]
    while todo:
        a, b = todo[-1]
        xs, ys = ka[a], kb[b]
        below = [(x, y) for x in xs for y in ys if la[x] == lb[y] and (x, y) not in memo]
        if below:
            todo += below
            continue
        todo.pop()
        w = [[0] * (len(ys) + 1) for _ in range(len(xs) + 1)]
        for i, x in enumerate(xs, 1):
            for j, y in enumerate(ys, 1):
                v = memo[x, y][0] if la[x] == lb[y] else 0
                w[i][j] = max(w[i - 1][j], w[i][j - 1], w[i - 1][j - 1] + v)
        pairs, i, j = [], len(xs), len(ys)
        while i and j:
            if w[i][j] == w[i - 1][j]:
                i -= 1
            elif w[i][j] == w[i][j - 1]:
                j -= 1
            else:
                i, j = i - 1, j - 1
                pairs.append((xs[i], ys[j]))
        memo[a, b] = w[len(xs)][len(ys)] + 1, pairs

    out, todo = {}, [(0, 0)]
    while todo:
        a, b = todo.pop()
        out[a] = b
        todo += memo[a, b][1]
    return out


def _host(url: Column) -> Column:
    bare = F.lower(F.regexp_extract(F.coalesce(url, F.lit("")), r"^(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?(?://)?([^/?#]*)", 1))
    return F.regexp_replace(bare, r"^www\.", "")


def _hash(text: str) -> int:
    value = xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass"))
    return value - (1 << 64) if value >> 63 else value


def _pages_fn():
    """Per page: host, fingerprint of its blocks' texts in order, skeleton, and
    the node, hash, characters and linked characters of each value of a node once."""
    schema = pa.schema([("host", pa.string()), ("page", pa.binary()), ("skeleton", pa.string()),
                        ("nodes", pa.list_(pa.int32())), ("hashes", pa.list_(pa.int64())),
                        ("chars", pa.list_(pa.int64())), ("links", pa.list_(pa.int64()))])

    def fn(cols):
        out = {f.name: [] for f in schema}
        for host, source in zip(cols["host"], cols["html"]):
            page = Page(source or "")
            hashes = [_hash(b[1]) for b in page.blocks]
            sizes = {(b[0], h): (len(b[1]), x) for b, h, x in zip(page.blocks, hashes, page.links)}
            once = sorted((*k, *v) for k, v in sizes.items())
            mark = xxhash.xxh3_128_digest(np.array(hashes, np.int64).tobytes())
            for name, v in zip(out, (host, mark, page.skeleton(), *([x[i] for x in once] for i in range(4)))):
                out[name].append(v)
        return out

    return arrow_map(fn, schema)


def _slots_fn():
    schema = pa.schema([("host", pa.string()), ("skeleton", pa.string()), ("node", pa.int32()), ("slot", pa.int32())])

    def fn(cols):
        out = {f.name: [] for f in schema}
        for host, skeleton, wrapper in zip(cols["host"], cols["skeleton"], cols["wrapper"]):
            for node, slot in align(skeleton, wrapper).items():
                for name, v in zip(out, (host, skeleton, node, slot)):
                    out[name].append(v)
        return out

    return arrow_map(fn, schema)


def induce(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Per host: host, wrapper (skeleton), pages (distinct ones), slots (array of
    struct<slot, pages, n, distinct_n, top_n, chars, links>) and fixed (array of
    struct<slot, value, n>, the values that nearly all pages with the slot have),
    from all its distinct pages."""
    scratch = Scratch(spark, "wrapper")
    rows = pages.select(_host(F.col("url")).alias("host"), F.col("html").cast("string").alias("html"))
    per_value = ["nodes", "hashes", "chars", "links"]
    # Copies are combined before the shuffle; of pages that differ in markup only one is taken.
    single = scratch.write(
        rows.mapInArrow(_pages_fn(), "host string, page binary, skeleton string, nodes array<int>, "
                                     "hashes array<long>, chars array<long>, links array<long>")
        .groupBy("host", "page").agg(F.min(F.struct("skeleton", *per_value)).alias("p"))
        .select("host", "p.*"), "pages")
    shapes = single.groupBy("host", "skeleton").agg(F.count(F.lit(1)).alias("n"))
    wrapper = shapes.groupBy("host").agg(F.max_by("skeleton", F.struct("n", "skeleton")).alias("wrapper"),
                                         F.sum("n").alias("pages"))
    slots = shapes.join(wrapper, "host").select("host", "skeleton", "wrapper") \
        .mapInArrow(_slots_fn(), "host string, skeleton string, node int, slot int")
    # Beside its values every node of a page has one null, which counts the pages.
    none = F.lit(None).cast("long")
    items = F.concat(
        F.arrays_zip(F.col("nodes").alias("node"), F.col("hashes").alias("value"), "chars", "links"),
        F.transform(F.array_distinct("nodes"), lambda k: F.struct(
            k.alias("node"), none.alias("value"), none.alias("chars"), none.alias("links"))))
    sizes = [F.max(c).alias(c) for c in ("chars", "links")]
    seen = (single.select("host", "skeleton", F.explode(items).alias("i")).select("host", "skeleton", "i.*")
            .groupBy("host", "skeleton", "node", "value").agg(F.count(F.lit(1)).alias("n"), *sizes))
    values = scratch.write(seen.join(slots, ["host", "skeleton", "node"])
                           .groupBy("host", "slot", "value").agg(F.sum("n").alias("n"), *sizes), "values")
    value_n = F.when(F.col("value").isNotNull(), F.col("n"))
    stats = values.groupBy("host", "slot").agg(
        F.sum(F.when(F.col("value").isNull(), F.col("n"))).alias("pages"), F.sum(value_n).alias("n"),
        F.count("value").alias("distinct_n"), F.max(value_n).alias("top_n"),
        F.sum(value_n * F.col("chars")).alias("chars"), F.sum(value_n * F.col("links")).alias("links"))
    stats = scratch.write(stats, "stats")
    # at most one entry a wrapper node, and of fixed values about as many as a page has blocks
    listed = stats.groupBy("host").agg(F.sort_array(F.collect_list(
        F.struct("slot", "pages", "n", "distinct_n", "top_n", "chars", "links"))).alias("slots"))
    fixed = (values.where(F.col("value").isNotNull() & (F.col("n") >= MIN_PAGES))
             .join(stats.select("host", "slot", "pages"), ["host", "slot"])
             .where(F.col("n") >= ARTICLE_SHARE * F.col("pages"))
             .groupBy("host").agg(F.sort_array(F.collect_list(F.struct("slot", "value", "n"))).alias("fixed")))
    return wrapper.join(listed, "host", "left").join(fixed, "host", "left")


@dataclass(frozen=True)
class Verdicts:
    """What a host's wrapper says of its slots."""

    skeleton: str
    known: bool                            # enough pages to tell
    template: frozenset[int]
    constant: frozenset[int]               # template inside an article too
    varying: frozenset[int]
    lines: frozenset[tuple[int, int]]      # values of a slot that nearly all pages have,
    article_lines: frozenset[tuple[int, int]]    # the same inside an article


@lru_cache(maxsize=1024)
def _verdicts(packed: str) -> Verdicts:
    got = json.loads(packed)
    slots, fixed = got.get("slots") or [], got.get("fixed") or []
    enough = [s for s in slots if s["pages"] >= MIN_PAGES]
    loose = {s["slot"] for s in enough if s["distinct_n"] <= MAX_DISTINCT * s["n"]
             or s["links"] >= LINK_SHARE * s["chars"]}
    strict = {s["slot"] for s in slots if s["pages"] >= ARTICLE_PAGES and s["top_n"] >= ARTICLE_SHARE * s["n"]}
    return Verdicts(got["wrapper"], got["pages"] >= MIN_PAGES, frozenset(loose), frozenset(strict),
                    frozenset({s["slot"] for s in enough} - loose),
                    frozenset((f["slot"], f["value"]) for f in fixed),
                    frozenset((f["slot"], f["value"]) for f in fixed if f["n"] >= ARTICLE_PAGES))


def main_text(source: str | None, wrapper: str | None) -> str:
    """Kept blocks of a page, one a line. ``wrapper``: JSON of ``induce``."""
    page = Page(source or "")
    if not page.blocks:
        return ""
    v, at = None, {}
    if wrapper:
        v = _verdicts(wrapper)
        at = align(page.skeleton(), v.skeleton)
    marked = any(mark and not boiler and not named for _, _, boiler, named, mark in page.blocks)
    kept: list[str] = []
    waiting: list[str] = []      # constant headings, until it shows what they head
    for (node, text, boiler, named, mark), tag in zip(page.blocks, page.tags):
        slot = at.get(node)
        if boiler or named == 2 or named == 1 and (marked and not mark or not (v and slot in v.varying)):
            continue
        # Landmarks stand in for the slots of a host that is too small to have any.
        if marked and not mark and not (v and v.known):
            continue
        if v and slot is not None:
            if slot in (v.constant if mark else v.template):
                if mark and tag in HEADINGS:
                    waiting.append(text)
                else:
                    waiting.clear()
                continue
            if tag not in HEADINGS and tag not in CELLS and (slot, _hash(text)) in (v.article_lines if mark else v.lines):
                waiting.clear()
                continue
        kept += waiting
        waiting.clear()
        kept.append(text)
    return "\n".join(kept)


@F.pandas_udf(StringType())
def _extract(sources: pd.Series, wrappers: pd.Series) -> pd.Series:
    return pd.Series([main_text(s, w) for s, w in zip(sources, wrappers)], dtype=object)


def extract_main_text(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    scratch = Scratch(spark, "extract")
    wrappers = scratch.write(induce(spark, pages).select(
        "host", F.to_json(F.struct("wrapper", "pages", "slots", "fixed")).alias("packed")), "wrappers")
    size = wrappers.agg(F.sum(F.octet_length("host") + F.octet_length("packed"))).first()[0] or 0
    if size <= broadcast_limit_bytes(spark) // 4:
        wrappers = F.broadcast(wrappers)
    rows = pages.select("page_id", "url", F.col("html").cast("string").alias("html"), _host(F.col("url")).alias("host"))
    return (rows.join(wrappers, "host", "left")
            .select("page_id", "url", _extract("html", "packed").alias("text"))
            .withColumn("n_chars", F.length("text").cast("long")))
