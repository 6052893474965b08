"""Main text of web pages with a site style tree.

The DOMs of a host's pages are merged by path (tags with their classes and ids). A path's
presentations are the child sequences seen there, its contents the text blocks directly in it. As
in the published method, a presentation node's importance is the entropy of its presentations over
the m pages that have it (base m), a text block that stands on k of m pages has importance
1 - log_m k, and an element's composite importance is (1 - g^l) * presentation + g^l * content
with l children and g = 0.9, where content is averaged over the blocks below it. Branches with low
composite importance are the site's template and are removed from each page.

Pages of a host with the same text outside such parts as HTML names as no article are copies: m and
the counts are over distinct ones, so that copies of an article do not make its path a template.

The tree is a table of counts: every batch of pages sends the styles of its distinct pages, and these
their counts per path, so a host with a third of all pages is combined map-side and never gathered.
The template paths go to the pages as a broadcast table while it is small (checked), and by a join on
the host beyond that.

What remains on a page: parts that HTML itself names as no article (navigation, page header and
footer, asides, forms, scripts ...) or that are classed so (menus, adverts, notices, comments ...)
go; the article elements, or the main element, or else the body is the root: of the text that is neither
so named nor the site's template, the article elements (or main) must hold a third, so that a story
beside a teaser is not lost. Inside an article the tree
removes a branch only if the site's articles differ, so that copies of an article keep their text; likewise in a
body without an article or main element, if no path there has contents that differ.

Defined cases: null html counts as empty (text is empty, 0 characters); unclosed, stray and
mis-nested tags are tolerated; a null or host-less url is a host of its own with that name; rows
repeating a page_id get a row each; extra columns are ignored; an empty table gives no rows.
"""

from __future__ import annotations

import html as html_lib
import re
from collections import Counter

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import ship, small_enough, written

GAMMA = 0.9
TEMPLATE = 0.3  # composite importance below which a branch is template
VARIED = 0.5  # of an article element, from which on its site's articles differ
ROOT_SHARE = 1 / 3  # of a page's text, which its article elements must hold to be taken for the article; likewise main
PAGES = 5  # that must have a path before it is judged
DEPTH = 100  # steps of a path; elements nested deeper share the path of their ancestor there, and its verdict

_TAG = re.compile(r"<!--.*?(?:-->|\Z)|<!\[CDATA\[.*?(?:\]\]>|\Z)|<[!?][^>]*(?:>|\Z)"
                  r"|<(/?)([a-zA-Z][^\s/>]*)((?:[^>\"']|\"[^\"]*\"|'[^']*')*+)>", re.S)
_ATTR = re.compile(r"([a-zA-Z_:-]+)\s*=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s\"'>]+))")
_NAME = re.compile(r"[a-z]+")
# Fixed values of HTML: elements without content, with raw text, and that stand as blocks.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title xmp noembed noframes".split())
BLOCKS = frozenset("address article aside blockquote body br caption center dd details dialog div dl dt fieldset "
                   "figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hr html legend li main nav ol "
                   "option optgroup p pre section select summary table tbody td tfoot th thead title tr ul".split())
# A start tag closes an open element of the set, looked for up to the given limit.
CLOSES = {"li": ({"li"}, {"ul", "ol"}), "dt": ({"dt", "dd"}, {"dl"}), "dd": ({"dt", "dd"}, {"dl"}),
          "tr": ({"tr"}, {"table"}), "td": ({"td", "th"}, {"tr", "table"}), "th": ({"td", "th"}, {"tr", "table"}),
          "option": ({"option"}, {"select"})}
# Not part of an article, by element and by words in class, id or role.
APART = frozenset("nav aside footer form script style noscript template iframe button select textarea svg canvas "
                  "object dialog menu head title audio video input label".split())
APART_WORDS = frozenset("ad ads advert advertisement adverts banner breadcrumb breadcrumbs comment comments consent "
                        "cookie cookies disclaimer footer gdpr menu modal nav navbar navigation newsletter notice "
                        "notification notifications outbrain pagination popup promo promoted promotion recommended related "
                        "share sharing sidebar signup social sponsor sponsored subscribe taboola toolbar widget "
                        "widgets disqus replies respond masthead topbar complementary contentinfo search".split())


class Page:
    """Elements in page order: tag, path, parent, words (of class, id, role), children; and pieces of
    text as (element, text), with None at block boundaries."""

    def __init__(self, source: str | None):
        self.tag, self.path, self.parent, self.words, self.children = ["#root"], [""], [-1], [frozenset()], [[]]
        self.depth, self.anchor = [0], [0]  # anchor: the element that gave the path its last step
        self.pieces: list[tuple[int, str] | None] = []
        self._parse(source or "")

    def _open(self, at: int, tag: str, attrs: str) -> int:
        found = {m[1].lower(): m[2] or m[3] or m[4] or "" for m in _ATTR.finditer(attrs)} if "=" in attrs else {}
        words = frozenset(_NAME.findall(f"{found.get('class', '')} {found.get('id', '')} {found.get('role', '')}".lower()))
        key = ".".join([tag, *sorted(words)])
        node = len(self.tag)
        deep = self.depth[at] >= DEPTH
        self.tag.append(tag)
        self.path.append(self.path[at] if deep else f"{self.path[at]}/{key}")
        self.depth.append(self.depth[at] + 1)
        self.anchor.append(self.anchor[at] if deep else node)
        self.parent.append(at)
        self.words.append(words)
        self.children.append([])
        self.children[at].append(key)
        return node

    def _parse(self, source: str) -> None:
        stack, end, pos = [0], len(source), 0
        lower = None
        while pos < end:
            m = _TAG.search(source, pos)
            text = source[pos:m.start() if m else end]
            if text:
                self.pieces.append((stack[-1], text))
            if not m:
                break
            pos = m.end()
            tag = (m[2] or "").lower()
            if not tag:
                if m[0].startswith("<![CDATA["):
                    self.pieces.append((stack[-1], m[0][9:].removesuffix("]]>")))
                continue
            if tag in BLOCKS:
                self.pieces.append(None)
            if m[1]:
                self._close(stack, tag)
                continue
            if tag in BLOCKS and tag not in VOID:
                self._imply(stack, tag)
            node = self._open(stack[-1], tag, m[3])
            if tag in VOID or m[3].endswith("/") and tag not in BLOCKS:
                continue
            if tag in RAW:
                lower = lower or source.lower()
                shut = lower.find(f"</{tag}", pos) if len(lower) == end else source.find(f"</{tag}", pos)
                shut = end if shut < 0 else shut
                if tag == "textarea" and shut > pos:
                    self.pieces.append((node, source[pos:shut]))
                close = source.find(">", shut)
                pos = end if close < 0 else close + 1
                continue
            stack.append(node)

    def _imply(self, stack: list[int], tag: str) -> None:
        """A block closes an open p; list items, cells and options close their predecessors."""
        closes, limit = CLOSES.get(tag, ({"p"}, {"td", "th", "li", "article", "section", "div", "main", "body"}))
        for k in range(len(stack) - 1, 0, -1):
            open_tag = self.tag[stack[k]]
            if open_tag in closes:
                del stack[k:]
                return
            if open_tag in limit:
                return

    def _close(self, stack: list[int], tag: str) -> None:
        inline = tag not in BLOCKS
        for k in range(len(stack) - 1, 0, -1):
            open_tag = self.tag[stack[k]]
            if open_tag == tag:
                del stack[k:]
                return
            if inline and open_tag in BLOCKS:
                return  # a stray inline end tag does not close blocks

    def apart(self) -> list[bool]:
        """Elements that are no part of an article by name or class."""
        out = [False]
        inside = [False]  # an article or main element
        for k in range(1, len(self.tag)):
            tag, up = self.tag[k], self.parent[k]
            whole = tag in ("article", "main", "body", "html")
            out.append(out[up] or tag in APART or (tag == "header" and not inside[up])
                       or (bool(self.words[k] & APART_WORDS) and (not whole or "comment" in self.words[k])))
            inside.append(inside[up] or tag in ("article", "main"))
        return out

    def roots(self, apart: list[bool], template: list[bool]) -> tuple[list[bool], int]:
        """Elements below the article's root(s), and one root: articles, else main, else everything. Articles or
        main count only with ROOT_SHARE of the text that is neither apart nor the site's template elsewhere."""
        own = [0] * len(self.tag)
        for piece in self.pieces:
            if piece is not None and not apart[piece[0]]:
                own[piece[0]] += len("".join(piece[1].split()))
        for wanted in (lambda k: self.tag[k] == "article", lambda k: self.tag[k] == "main" or "main" in self.words[k]):
            found = [k for k in range(1, len(self.tag)) if not apart[k] and wanted(k)]
            if found:
                below = [False] * len(self.tag)
                for k in range(1, len(self.tag)):
                    below[k] = below[self.parent[k]] or wanted(k) and not apart[k]
                inside = sum(n for n, b in zip(own, below) if b)
                outside = sum(n for n, b, t in zip(own, below, template) if not b and not t)
                if inside >= ROOT_SHARE * (inside + outside):
                    return below, found[0]
        return [True] * len(self.tag), 0

    def blocks(self) -> list[tuple[int, str]]:
        """(element, text) of each block, white space collapsed; for counting."""
        out: list[tuple[int, str]] = []
        node, parts = -1, []
        for piece in [*self.pieces, None]:
            if piece is None or piece[0] != node:
                text = " ".join("".join(parts).split())
                if text:
                    out.append((node, text))
                parts = []
            if piece is not None:
                node = piece[0]
                parts.append(piece[1])
        return out

    def text(self, keep: list[bool]) -> str:
        """Blocks in page order, references decoded, white space collapsed."""
        blocks, parts = [], []
        for piece in [*self.pieces, None]:
            if piece is not None:
                if keep[piece[0]]:
                    parts.append(html_lib.unescape(piece[1]) if "&" in piece[1] else piece[1])
            elif parts:
                blocks.append("".join(parts))
                parts = []
        return " ".join(" ".join(blocks).split())


def path_key(host: str, path: str) -> int:
    return xxhash.xxh3_64_intdigest(f"{host}\n{path}".encode("utf-8", "surrogatepass")) - (1 << 63)


def _key(text: str) -> int:
    return xxhash.xxh3_64_intdigest(text.encode("utf-8", "surrogatepass")) - (1 << 63)


def main_text(source: str | None, host: str = "", template: frozenset[int] = frozenset(),
              alike: frozenset[int] = frozenset()) -> str:
    """The main text. ``template`` holds keys of low-importance paths, ``alike`` those below VARIED."""
    page = Page(source)
    apart = page.apart()
    low = [False] * len(page.tag)
    if template and path_key(host, "") not in alike:
        for k in range(1, len(page.tag)):
            low[k] = low[page.parent[k]] or (page.tag[k] not in ("html", "body", "main", "article")
                                             and path_key(host, page.path[k]) in template)
    below, root = page.roots(apart, low)
    prune = path_key(host, page.path[root]) not in alike
    keep = [False] * len(page.tag)
    gone = [False] * len(page.tag)
    keep[0] = root == 0
    for k in range(1, len(page.tag)):
        whole = k == root or page.tag[k] in ("html", "body")
        gone[k] = gone[page.parent[k]] or (prune and below[k] and not whole and bool(template)
                                           and path_key(host, page.path[k]) in template)
        keep[k] = below[k] and not apart[k] and not gone[k]
    return page.text(keep)


# --- the site style tree as tables of counts -----------------------------------------------------
COUNTS = T.StructType([T.StructField(n, T.LongType()) for n in ("kind", "path", "value", "n")])
# pages with a path; with a block in it; with a presentation; leaf below path; leaf that is no apart part of a host's pages
PAGE, BLOCK, SHOWN, BELOW, OPEN = 0, 1, 2, 3, 4
STYLES = T.StructType([T.StructField("host", T.LongType()), T.StructField("content", T.LongType()),
                       T.StructField("style", T.BinaryType())])


def _page_styles(batches):
    """Per distinct content of a host in the batch: the (kind, path, value) of one page with it."""
    for b in batches:
        found: dict[tuple[int, int], bytes] = {}
        for host, source in zip(b.column("host").to_pylist(), b.column("html").to_pylist()):
            page = Page(source)
            apart, blocks = page.apart(), page.blocks()
            keys = [path_key(host, p) for p in page.path]
            seen = {(PAGE, k, 0) for k in keys[1:]}
            seen |= {(SHOWN, keys[k], _key(",".join(c)) & ~0xFF | min(255, len(c))) for k, c in enumerate(page.children) if k}
            for node, text in blocks:
                seen.add((BLOCK, keys[node], _key(text)))
                if not apart[node]:
                    seen.add((OPEN, keys[node], keys[0]))
                up = page.anchor[node]
                while up > 0:
                    seen.add((BELOW, keys[node], keys[up]))
                    up = page.parent[up]
            content = [text for node, text in blocks if not apart[node]] or [text for _, text in blocks]
            at, style = (keys[0], _key("\n".join(content))), np.array(sorted(seen), np.int64).tobytes()
            found[at] = min(found.get(at, style), style)
        yield pa.RecordBatch.from_arrays(
            [*[pa.array([at[i] for at in found], pa.int64()) for i in range(2)], pa.array(list(found.values()), pa.binary())],
            names=STYLES.names)


def _count_styles(batches):
    for b in batches:
        counts: Counter = Counter()
        for style in b.column("style").to_pylist():
            counts.update(map(tuple, np.frombuffer(style, np.int64).reshape(-1, 3).tolist()))
        yield pa.RecordBatch.from_arrays(
            [*[pa.array([c[i] for c in counts], pa.int64()) for i in range(3)], pa.array(list(counts.values()), pa.int64())],
            names=COUNTS.names)


def path_importance(spark: SparkSession, pages: DataFrame) -> DataFrame:
    """(path, pages, importance): composite importance of every path that PAGES distinct pages have; and for
    each host, with the empty path and no pages, the largest importance of contents outside apart parts."""
    ship(spark)
    styles = pages.mapInArrow(_page_styles, STYLES).groupBy("host", "content").agg(F.min("style").alias("style"))
    counts = written(spark, styles.select("style").mapInArrow(_count_styles, COUNTS).groupBy("kind", "path", "value")
                     .agg(F.sum("n").alias("n")), "style-counts")
    # entropies as sums of n and n log n, so that a path's many blocks are added up before any exchange
    of = lambda kind, x: F.sum(F.when(F.col("kind") == kind, x))
    n, spread, log_m = F.col("n"), F.col("n") * F.log("n"), F.log("m")
    each = counts.where(F.col("kind") < BELOW).groupBy("path").agg(
        of(PAGE, n).alias("m"), of(BLOCK, n).alias("weight"), of(BLOCK, spread).alias("block_spread"),
        of(SHOWN, n).alias("shown"), of(SHOWN, spread).alias("shown_spread"),
        of(SHOWN, n * F.col("value").bitwiseAND(255)).alias("length")).where(F.col("m") >= PAGES)
    each = written(spark, each, "style-paths")
    block = each.where("weight is not null").select(
        F.col("path").alias("leaf"), "weight", (F.col("weight") - F.col("block_spread") / log_m).alias("sum_imp"))
    content = (counts.where(F.col("kind") == BELOW).select(F.col("path").alias("leaf"), F.col("value").alias("path"))
               .join(block, "leaf")
               .groupBy("path").agg((F.sum("sum_imp") / F.sum("weight")).alias("content")))
    entropy = (F.col("shown") * log_m - F.col("shown_spread")) / (F.col("m") * log_m)
    weight = F.pow(F.lit(GAMMA), F.col("length") / F.col("shown"))
    paths = each.where("shown is not null").join(content, "path").select(
        "path", F.col("m").alias("pages"),
        ((1 - weight) * F.least(entropy, F.lit(1.0)) + weight * F.col("content")).alias("importance"))
    hosts = (counts.where(F.col("kind") == OPEN).select(F.col("path").alias("leaf"), F.col("value").alias("path"))
             .join(block, "leaf").groupBy("path").agg(F.max(F.col("sum_imp") / F.col("weight")).alias("importance")))
    return paths.unionByName(hosts.select("path", F.lit(None).cast("long").alias("pages"), "importance"))


def host_of(url: str = "url") -> Column:
    return F.coalesce(F.regexp_extract(F.lower(F.col(url).cast("string")), r"^[a-z][a-z0-9+.-]*://([^/?#]*)", 1), F.lit(""))


TEXTS = T.StructType([T.StructField("page_id", T.LongType()), T.StructField("url", T.StringType()),
                      T.StructField("text", T.StringType()), T.StructField("n_chars", T.LongType())])


def _texts(lookup):
    def texts(batches):
        for b in batches:
            sets = lookup(b)
            out = [main_text(h, host, *s) for h, host, s in zip(b.column("html").to_pylist(), b.column("host").to_pylist(), sets)]
            yield pa.RecordBatch.from_arrays([b.column("page_id"), b.column("url"), pa.array(out, pa.string()),
                                              pa.array([len(t) for t in out], pa.int64())], names=TEXTS.names)
    return texts


def extract_main_text(spark: SparkSession, pages: DataFrame, broadcast_bytes: int | None = None) -> DataFrame:
    """Per page: page_id, url, text, n_chars."""
    ship(spark)
    rows = pages.select(F.col("page_id").cast("long").alias("page_id"), F.col("url").cast("string").alias("url"),
                        host_of().alias("host"), F.col("html").cast("string").alias("html"))
    importance = path_importance(spark, rows.select("host", "html"))
    low = written(spark, importance.where(F.col("importance") < VARIED).select(
        "path", (F.col("importance") < TEMPLATE).alias("template")), "style-low")
    n = low.count()
    if small_enough(spark, n, 200) if broadcast_bytes is None else n * 200 <= broadcast_bytes:
        got = low.toArrow()
        path, flag = got["path"].to_numpy(), got["template"].to_numpy()
        table = spark.sparkContext.broadcast((frozenset(path[flag].tolist()), frozenset(path.tolist())))
        return rows.mapInArrow(_texts(lambda b: [table.value] * b.num_rows), TEXTS)
    # beyond the bound each page gets the judged ones of its own paths; the html itself moves once
    rows = rows.withColumn("content", F.md5(F.concat("host", F.lit("\n"), F.coalesce("html", F.lit("")))))
    mine = rows.select("content", "host", "html").mapInArrow(_page_paths, "content string, path bigint")
    judged = mine.join(low, "path").groupBy("content").agg(
        F.collect_set(F.when(F.col("template"), F.col("path"))).alias("template"), F.collect_set("path").alias("alike"))
    return rows.join(judged, "content", "left").mapInArrow(
        _texts(lambda b: [(frozenset(t or ()), frozenset(a or ())) for t, a in
                          zip(b.column("template").to_pylist(), b.column("alike").to_pylist())]), TEXTS)


def _page_paths(batches):
    """The distinct paths of each page, beside the page's content hash; equal pages have equal paths."""
    for b in batches:
        content, path = [], []
        for key, host, source in zip(*(b.column(c).to_pylist() for c in ("content", "host", "html"))):
            found = sorted({path_key(host, p) for p in Page(source).path})
            content += [key] * len(found)
            path += found
        yield pa.RecordBatch.from_arrays([pa.array(content, pa.string()), pa.array(path, pa.int64())], names=["content", "path"])
