"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree of element paths. A path is important if
pages present it in different ways (entropy of the tags below it) and fill it with
different content (entropy of its texts over the pages); a branch that looks and
reads the same on page after page is not, nor is one that is all links where markup
says nothing about it. Importance decides about every block: branches of low importance
are removed from each page.

Markup that says what a branch is (navigation, advert, form; article, main) is a prior: it sets the
importance that the entropies start from and the one a branch must fall below. A branch
called main goes if it reads the same on page after page. A branch called noise comes back, but for
what is called noise inside it, if nearly all that differs from page to page of a
host is in it: it is then a frame around the page. The fewer pages a host has, the more the prior counts.

The tree is only ever a table of (host, path): a host with any number of pages is summed
up by partial aggregation.
"""

from __future__ import annotations

import hashlib
import html as entities
import re
from collections.abc import Iterator
from typing import NamedTuple
from urllib.parse import urlsplit

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession, functions as F

from namewire.llm.base import semi_join, stored, table

STYLE_SHARE = 0.1  # of presentation in an importance; the rest is content
PRIOR_PAGES = 3  # pages that a prior counts as
FRAME_PRIOR, FRAME = 0.1, 0.8  # a branch called noise is a frame from this share on

VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
RAW = frozenset("script style textarea title noscript template iframe xmp noembed noframes".split())
BLOCKS = frozenset("""address article aside blockquote body center dd details dialog dir div dl dt fieldset figcaption
figure footer form h1 h2 h3 h4 h5 h6 head header hgroup hr html legend li main menu nav ol optgroup option p pre search
section summary table tbody td tfoot th thead tr ul caption""".split())
NOISE_TAGS = frozenset("""nav footer aside form head button select option dialog menu svg canvas object audio video map
search input label fieldset legend""".split())
NOISE_WORDS = frozenset("""ad ads advert adverts advertisement advertising adsense banner sponsor sponsored promo promotion
menu nav navbar navigation breadcrumb breadcrumbs header masthead footer sidebar aside widget cookie cookies consent gdpr
notice notices alert popup modal overlay newsletter subscribe subscription signup login search share sharing social
comment comments reply replies respond disqus discussion related recommended recommendations pagination pager toolbar
copyright legal""".split())
MAIN_WORDS = frozenset("article main content post entry story body text".split())
NOISE_ROLES = frozenset("navigation banner contentinfo complementary search form dialog alert menu menubar toolbar".split())
# a start tag on the left closes an open element on the right, up to the nearest boundary
CLOSES = {
    "li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"), "th": ("td", "th"),
    "option": ("option",), "tbody": ("tr", "td", "th", "thead", "tbody"), "tfoot": ("tr", "td", "th", "tbody"),
}
BOUNDS = {"li": ("ul", "ol", "menu", "dir"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("table", "tr"),
          "th": ("table", "tr"), "tbody": ("table",), "tfoot": ("table",), "option": ("select",)}

TAG = re.compile(r"""<(/?)([A-Za-z][^\s/>]*)((?>[^>"']+|"[^"]*"|'[^']*')*+)>""")
LOOSE_TAG = re.compile(r"<(/?)([A-Za-z][^\s/>]*)([^>]*)>?")
ATTRIBUTE = re.compile(r"""\b(class|id|role)\s*=\s*(?:"([^"]*)"|'([^']*)'|([^\s"'>]+))""", re.IGNORECASE)
SPLIT = re.compile(r"[^a-z0-9]+")
NOISE, OPEN, MAIN = -1, 0, 1
HEADINGS = ("h1", "h2", "h3", "h4", "h5", "h6")
# importance before any page is seen, and below which a path is removed
PRIOR = {OPEN: (0.6, 0.4), MAIN: (0.9, 0.1)}


def _long(*parts: object) -> int:
    return int.from_bytes(hashlib.blake2b("\x1f".join(map(str, parts)).encode(), digest_size=8).digest(), "big", signed=True)


def _called(tag: str, attributes: str, above: int) -> tuple[int | None, str]:
    """What markup calls an element itself, if anything, and its class for the path."""
    found = {m[1].lower(): (m[2] or m[3] or m[4] or "").lower() for m in ATTRIBUTE.finditer(attributes)} if attributes else {}
    style = found.get("class", "")
    if tag in NOISE_TAGS or found.get("role") in NOISE_ROLES:
        return NOISE, style
    if tag in ("article", "main") or found.get("role") in ("main", "article"):
        return MAIN, style
    if tag == "header" and above != MAIN:
        return NOISE, style
    if tag in ("html", "body"):
        return None, style
    words = set(SPLIT.split(found.get("class", "") + " " + found.get("id", "")))
    noise, main = bool(words & NOISE_WORDS), bool(words & MAIN_WORDS)
    return (NOISE if noise else MAIN) if noise != main else None, style


class Element(NamedTuple):
    """An open element: its path, what markup makes of it, and where the nearest block around it is."""
    tag: str
    path: int
    standing: int
    branch: int | None  # the outermost branch called noise around it
    inner: int  # its standing if that branch were none
    block: int
    linked: bool


class Block(NamedTuple):
    path: int
    standing: int
    text: str
    branch: int | None
    inner: int
    linked: int  # letters inside links


class Page:
    """Blocks of text of a page in order, and the tags below each path; time and memory are linear in the page."""

    def __init__(self, source: str):
        self.blocks: list[Block] = []
        self.below: dict[int, list[str]] = {}
        self.stack = [Element("", 0, OPEN, None, OPEN, 0, False)]
        self.depths: dict[str, list[int]] = {}  # of the open elements of each tag
        self.names: dict[tuple[int, str, str], int] = {}
        self.parts: list[str] = []
        self.linked = 0
        self.owner = self.stack[0]
        self._parse(source)

    def _flush(self) -> None:
        if self.parts:
            text = " ".join(entities.unescape("".join(self.parts)).split())
            if text:
                owner = self.owner
                self.blocks.append(Block(owner.path, owner.standing, text, owner.branch, owner.inner, min(self.linked, len(text))))
            self.parts, self.linked = [], 0

    def _text(self, piece: str) -> None:
        if piece:
            top = self.stack[-1]
            if not self.parts:
                self.owner = top
            elif (top.standing, top.branch, top.inner) != (self.owner.standing, self.owner.branch, self.owner.inner):
                self._flush()  # an inline element of another standing, such as a label
                self.owner = top
            self.parts.append(piece)
            if top.linked:
                self.linked += len(piece)

    def _close_to(self, depth: int) -> None:
        while len(self.stack) > depth:
            self.depths[self.stack.pop().tag].pop()

    def _depth(self, tags: tuple[str, ...]) -> int:
        return max((self.depths[t][-1] for t in tags if self.depths.get(t)), default=0)

    def _name(self, path: int, tag: str, style: str) -> int:
        key = path, tag, style
        if key not in self.names:
            self.names[key] = _long(*key)
        return self.names[key]

    def _open(self, tag: str, attributes: str) -> None:
        if tag in BLOCKS:
            self._flush()
            if self.stack[self.stack[-1].block].tag == "p":  # a block ends an open paragraph
                self._close_to(self.stack[-1].block)
        if tag in CLOSES:
            depth = self._depth(CLOSES[tag])
            if depth > self._depth(BOUNDS[tag]):
                self._close_to(depth)
        top = self.stack[-1]
        called, style = _called(tag, attributes, top.inner if top.standing == NOISE else top.standing)
        self.below.setdefault(top.path, []).append(tag)
        if tag == "br" or tag == "hr":
            self._text(" ")
        if tag in VOID or attributes.endswith("/"):
            return
        name = self._name(top.path, tag, style)
        if top.standing == NOISE:
            standing, branch = NOISE, top.branch
            inner = NOISE if top.inner == NOISE else top.inner if called is None else called
        elif called == NOISE:
            standing, branch, inner = NOISE, name, OPEN
        else:
            standing, branch = (top.standing if called is None else called), None
            inner = standing
        depth, block = len(self.stack), tag in BLOCKS
        link = tag == "a" and self.stack[top.block].tag not in HEADINGS  # a title may be a link
        self.stack.append(Element(tag, name if block else top.path, standing, branch, inner,
                                  depth if block else top.block, top.linked or link))
        self.depths.setdefault(tag, []).append(depth)

    def _close(self, tag: str) -> None:
        if tag in BLOCKS:
            self._flush()
        depth = self._depth((tag,))
        if depth > (0 if tag in BLOCKS else self.stack[-1].block):  # else a stray end
            self._close_to(depth)

    def _parse(self, source: str) -> None:
        at, end = 0, len(source)
        lower = None
        while at < end:
            mark = source.find("<", at)
            if mark < 0:
                self._text(source[at:])
                break
            self._text(source[at:mark])
            after = source[mark + 1: mark + 2]
            if after == "!" or after == "?":
                close, skip = (("-->", 3) if source.startswith("<!--", mark) else
                               ("]]>", 3) if source.startswith("<![CDATA[", mark) else (">", 1))
                found = source.find(close, mark + (2 if skip == 1 else 4))
                at = end if found < 0 else found + skip
                continue
            m = TAG.match(source, mark) or LOOSE_TAG.match(source, mark)
            if not m:
                self._text("&lt;")
                at = mark + 1
                continue
            at = m.end()
            tag = m[2].lower()
            if m[1]:
                self._close(tag)
            elif tag in RAW:
                if lower is None:
                    lower = source.lower() if source.isascii() else re.sub("[A-Z]", lambda c: c[0].lower(), source)
                found = lower.find(f"</{tag}", at)
                at = end if found < 0 else max(source.find(">", found) + 1, found + 1)
                if at == 0:
                    at = end
            else:
                self._open(tag, m[3])
        self._flush()

    def kept(self) -> list[Block]:
        """What markup alone would keep: blocks not called noise; beside a main part, only that part."""
        blocks = [b for b in self.blocks if b.standing != NOISE]
        main = [b for b in blocks if b.standing == MAIN]
        return main or blocks


def host_of(url: str | None) -> str:
    try:
        return (urlsplit(url or "").hostname or "").removeprefix("www.")
    except ValueError:
        return ""


BLOCK = pa.struct([("path", pa.int64()), ("standing", pa.int8()), ("text", pa.string()), ("branch", pa.int64()), ("inner", pa.int8())])
NODE = pa.struct([("path", pa.int64()), ("style", pa.int64()), ("size", pa.int64()), ("linked", pa.int64())])
CONTENT = pa.struct([("path", pa.int64()), ("branch", pa.int64()), ("item", pa.int64()), ("size", pa.int64())])
SCHEMA = ("page_id long, url string, host string, page long, source long,"
          " blocks array<struct<path:long,standing:tinyint,text:string,branch:long,inner:tinyint>>,"
          " nodes array<struct<path:long,style:long,size:long,linked:long>>,"
          " contents array<struct<path:long,branch:long,item:long,size:long>>")


def _nodes(page: Page) -> list[dict]:
    """Each path of a page: what stands below it, the letters of its texts and those in links."""
    sums: dict[int, list[int]] = {p: [0, 0] for p in page.below}
    for b in page.blocks:
        found = sums.setdefault(b.path, [0, 0])
        found[0] += len(b.text)
        found[1] += b.linked
    return [{"path": p, "style": _long(*page.below[p]) if p in page.below else None, "size": n, "linked": k} for p, (n, k) in sums.items()]


def _contents(page: Page) -> list[dict]:
    """Different texts of each path of a page, with their letters."""
    sums: dict[tuple, int] = {}
    for b in page.blocks:
        key = b.path, b.branch, _long(b.text)
        sums[key] = sums.get(key, 0) + len(b.text)
    return [{"path": p, "branch": r, "item": i, "size": n} for (p, r, i), n in sums.items()]


def _pages(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    for batch in batches:
        for low in range(0, len(batch), 128):
            part = batch.slice(low, 128)
            out = {name: [] for name in ("host", "page", "source", "blocks", "nodes", "contents")}
            for url, source in zip(part.column("url").to_pylist(), part.column("html").to_pylist()):
                page = Page(source or "")
                out["host"].append(host_of(url))
                # pages that differ in noise only are one
                out["page"].append(_long(*([b.text for b in page.blocks if b.standing != NOISE] or [source or ""])))
                out["source"].append(_long(source or ""))
                out["blocks"].append([{"path": b.path, "standing": b.standing, "text": b.text, "branch": b.branch, "inner": b.inner}
                                      for b in page.blocks if b.inner != NOISE])
                out["nodes"].append(_nodes(page))
                out["contents"].append(_contents(page))
            yield pa.RecordBatch.from_arrays([
                part.column("page_id"), part.column("url"), pa.array(out["host"], pa.string()), pa.array(out["page"], pa.int64()),
                pa.array(out["source"], pa.int64()), pa.array(out["blocks"], pa.list_(BLOCK)), pa.array(out["nodes"], pa.list_(NODE)),
                pa.array(out["contents"], pa.list_(CONTENT))],
                names=["page_id", "url", "host", "page", "source", "blocks", "nodes", "contents"])


def _with_prior(prior: float, seen: str, pages: str = "m"):
    """An estimate from ``pages`` pages, drawn towards what was held before any was seen."""
    return (F.lit(prior * PRIOR_PAGES) + (F.col(pages) - 1) * F.col(seen)) / (PRIOR_PAGES + F.col(pages) - 1)


def style_tree(parsed: DataFrame) -> tuple[DataFrame, DataFrame]:
    """``importance`` of every (host, path) and ``frame`` of every (host, branch) called noise, with ``m`` pages.

    Presentation: entropy of the styles of a path over its pages, in units of the largest
    possible; none if there is nothing below it. Content: one less the mean entropy of its texts, where a text on k of m
    pages has entropy log k / log m. ``linked`` is the share of its letters in links. ``frame`` nears one as the
    text that differs from page to page and stands outside the branch nears none of the host's.
    """
    # a copy of a page counts once
    firsts = parsed.groupBy("host", "page").agg(F.min(F.struct("source", "row")).getField("row").alias("row")).select("row")
    pages = semi_join(parsed.select("row", "host", "nodes", "contents"), stored(firsts, "firsts"), "row")
    nodes = pages.select("host", F.explode("nodes").alias("n")).select("host", "n.*")
    shown = (nodes.where("style is not null").groupBy("host", "path", "style").agg(F.count("*").alias("k"))
             .groupBy("host", "path").agg(F.sum("k").alias("shown"), F.sum(F.col("k") * F.log("k")).alias("klogk")))
    presentation = shown.select("host", "path", F.when(
        F.col("shown") > 1, (F.log("shown") - F.col("klogk") / F.col("shown")) / F.log("shown")).otherwise(1.0).alias("presentation"))
    filled = nodes.where("size > 0").groupBy("host", "path").agg(
        F.count("*").alias("m"), (F.sum("linked") / F.sum("size")).alias("linked"))
    texts = (pages.select("host", F.explode("contents").alias("c")).select("host", "c.*")
             .groupBy("host", "path", "branch", "item").agg(F.count("*").alias("k"), F.sum("size").alias("size")))
    fresh = F.when(F.col("m") > 1, 1 - F.log("k") / F.log("m")).otherwise(1.0)
    summed = stored(texts.join(filled, ["host", "path"]).groupBy("host", "path", "branch").agg(
        F.sum(fresh).alias("fresh"), F.count("*").alias("items"), F.sum(F.col("size") * fresh).alias("varied"),
        F.first("m").alias("m"), F.first("linked").alias("linked")), "paths")
    content = summed.groupBy("host", "path").agg(
        (F.sum("fresh") / F.sum("items")).alias("content"), F.first("m").alias("m"), F.first("linked").alias("linked"))
    paths = (content.join(presentation, ["host", "path"], "left")
             .select("host", "path", "m", "linked", (STYLE_SHARE * F.coalesce("presentation", F.lit(0.0))
                                                     + (1 - STYLE_SHARE) * F.col("content")).alias("importance")))
    hosts = pages.groupBy("host").agg(F.count("*").alias("m"))
    whole = summed.groupBy("host").agg(F.sum("varied").alias("all")).where("all > 0").join(hosts, "host")
    outside = 1 - F.col("varied") / F.col("all")
    frames = (summed.where("branch is not null").groupBy("host", "branch").agg(F.sum("varied").alias("varied")).join(whole, "host")
              .select("host", "branch", "m", (1 - F.least(F.lit(1.0), 10 * outside)).alias("frame")))
    return paths, frames


def main_text(
    pages: DataFrame, id_column: str = "page_id", url_column: str = "url", html_column: str = "html",
) -> DataFrame:
    """``page_id``, ``url``, ``text``, ``n_chars`` of every page, and ``n_removed``.

    Blocks are joined by line breaks; white space inside a block is one space. If any block that is
    called main is left, the others go. ``n_removed`` counts the blocks that markup does not call noise and the tree
    removed. A null or empty page has an empty text. Pages with a null or broken url are one host. Repeated rows are
    all returned. Very long and deeply nested pages take time and memory in proportion. Other columns
    are not looked at, whatever their names; an empty table gives no row.
    """
    plain = pages.select(F.col(id_column).cast("long").alias("page_id"), F.col(url_column).alias("url"),
                         F.col(html_column).alias("html"))
    parsed = stored(plain.mapInArrow(_pages, SCHEMA).withColumn("row", F.monotonically_increasing_id()), "parsed")
    paths, frames = style_tree(parsed)
    # kind: the standing in which a path is removed, or NOISE for a branch that is a frame
    low = [paths.withColumn("seen", F.col("importance") * (1 - F.col("linked") if kind == OPEN else F.lit(1)))
           .where(_with_prior(prior, "seen") < cut).select("host", F.lit(kind).alias("kind"), F.col("path").alias("id"))
           for kind, (prior, cut) in PRIOR.items()]
    verdicts = stored(low[0].union(low[1]).union(
        frames.where(_with_prior(FRAME_PRIOR, "frame") >= FRAME).select("host", F.lit(NOISE), "branch")), "verdicts")
    # a path inside a branch called noise matters only if that branch is a frame
    asked = parsed.select("row", "host", F.explode("blocks").alias("b")).select("row", "host", F.explode(F.array(
        F.struct(F.col("b.inner").cast("int").alias("kind"), F.col("b.path").alias("id"), (F.col("b.standing") != NOISE).alias("acts")),
        F.struct(F.lit(NOISE).alias("kind"), F.col("b.branch").alias("id"), F.lit(True).alias("acts")))).alias("q")).select("row", "host", "q.*")
    found = stored(asked.where("id is not null").distinct().join(verdicts, ["host", "kind", "id"]).groupBy("row").agg(
        F.collect_set(F.struct("kind", "id")).alias("found"), F.bool_or("acts").alias("acts")).where("acts").drop("acts"), "found")

    def told(kind, name):
        return F.exists("found", lambda f: (f["kind"] == kind) & (f["id"] == name))

    # only pages of which the tree has something to say move
    none = F.array().cast("array<struct<kind:int,id:long>>")
    whole = parsed.select("row", "page_id", "url", "blocks")
    if found.isEmpty():
        whole = whole.withColumn("found", none)
    else:
        ids = found.select("row")
        whole = semi_join(whole, ids, "row").join(found, "row").unionByName(
            semi_join(whole, ids, "row", how="left_anti").withColumn("found", none))
    judged = whole.withColumn(
        "open", F.filter("blocks", lambda b: (b["standing"] != NOISE) | told(NOISE, b["branch"]))).withColumn(
        "left", F.filter("open", lambda b: ~told(b["inner"], b["path"])))
    main = F.filter("left", lambda b: b["inner"] == MAIN)
    return judged.withColumn("main", main).withColumn("left", F.when(F.size("main") > 0, F.col("main")).otherwise(F.col("left"))).select(
        "page_id", "url", F.array_join(F.transform("left", lambda b: b["text"]), "\n").alias("text"),
        F.size(F.filter("open", lambda b: told(b["inner"], b["path"]))).cast("long").alias("n_removed")
    ).select("page_id", "url", "text", F.length("text").cast("long").alias("n_chars"), "n_removed")


def op1_html(spark: SparkSession, folder: str) -> DataFrame:
    return main_text(table(spark, folder, "pages"))
