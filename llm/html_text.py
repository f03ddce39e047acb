"""Main text of web pages by a site style tree.

The pages of a host are merged into one tree whose nodes are paths of elements (tag, class, id). Per node, over
the m pages of the host that have it:

* presentation importance is the entropy, to the base m, of the node's layouts on its pages (how many blocks,
  with which inline tags): a menu looks the same everywhere, an article does not;
* content importance is 1 minus the mean, over its blocks, of log_m of the number of pages that show the same block
  at that node: a notice that all pages repeat has none.

Their mean is weighted by what the path says itself: menus, footers, forms, adverts, sidebars, notices, comments and
nodes whose text is mostly links count ``NOISE`` of it, nodes inside an article start from ``ARTICLE``. Branches
below ``LEAST`` are removed. Nodes on fewer than ``FEW`` pages keep full importance, so small sites are judged by
their paths alone. Where a page has text inside an article, only that is its main text.

Scripts, styles, the head and markup never make blocks. Every page is parsed once, in its task; the tree is built by
grouping on (host, node), so a host with a third of all pages is aggregated before it is shuffled, and decisions
come back by a join with one row per node of a host, or, where their counted number is small, by one list per host.

Defined cases: null or empty html gives empty text; null urls share the empty host; unclosed and stray tags are
tolerated; pages equal in id and html share their text; other columns are not read.
"""

from __future__ import annotations

import re
from html import unescape

import pyarrow as pa
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from llm.common import arrow_map, store, table, texts
from llm.registry import query

NOISE, ARTICLE, LEAST, FEW, LINKS = 0.3, 0.5, 0.35, 4, 0.6
SMALL = 500_000

# Elements without content, elements inside a line, elements that are never main text.
_VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
_INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd mark q rp rt ruby s samp small span strike strong sub sup time tt u var".split())
_NOISE_TAGS = frozenset("head title nav footer aside form button select option label fieldset dialog menu iframe noscript template svg math canvas audio video object applet map datalist textarea".split())
_RAW = "script|style|noscript|template|svg|iframe|textarea|select|math|title|canvas|object"
_NOISE_NAMES = frozenset(
    "ad ads adv advert adverts advertisement advertising banner sponsor sponsored promo promotion cookie cookies consent gdpr "
    "notice notices alert popup modal overlay newsletter subscribe subscription signup share sharing social sidebar side aside widget "
    "widgets related recommended recommendations breadcrumb breadcrumbs menu nav navbar navigation pagination pager comment comments "
    "disqus reply replies respond footer foot header masthead topbar copyright login search toolbar skip teaser outbrain taboola".split()
)
_NOISE_ROLES = frozenset("navigation banner contentinfo complementary search dialog alertdialog alert form menu menubar".split())
_NEGATED = frozenset("has with no without".split())
_CLOSES_P = frozenset("address article aside blockquote details div dl fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 header hr main menu nav ol p pre section table ul".split())
_LISTS = {"li": ("ul", "ol", "menu"), "dt": ("dl",), "dd": ("dl",), "tr": ("table",), "td": ("tr", "table"), "th": ("tr", "table"), "option": ("select",)}

_TOKEN = re.compile(
    r"<!--.*?(?:-->|\Z)"
    rf"|<(?P<raw>{_RAW})\b[^>]*+>.*?(?:</(?P=raw)\s*>|\Z)"
    r"|<(?P<close>/?)(?P<tag>[a-zA-Z][a-zA-Z0-9:-]*)(?P<attrs>(?:[^>\"']++|\"[^\"]{0,4096}+\"|'[^']{0,4096}+'|[\"'])*+)>"
    r"|<[!?][^>]*+>|(?P<text>[^<]++)|<",
    re.S | re.I,
)
_ATTR = re.compile(r"([a-zA-Z-]+)\s*(?:=\s*(?:\"([^\"]*)\"|'([^']*)'|([^\s>]+)))?")
_HIDDEN = re.compile(r"display\s*:\s*none|visibility\s*:\s*hidden", re.I)
_CAMEL = re.compile(r"(?<=[a-z])(?=[A-Z])")
_NAME = re.compile(r"[^a-zA-Z]+")

_NEUTRAL, _IS_NOISE, _IS_ARTICLE = 0, 1, 2


def _noise_name(names: str) -> bool:
    parts = [x.lower() for x in _NAME.split(_CAMEL.sub(" ", names)) if x]
    return any(p in _NOISE_NAMES and (i == 0 or parts[i - 1] not in _NEGATED) for i, p in enumerate(parts))


class _Element:
    __slots__ = ("tag", "node", "kind", "link")

    def __init__(self, tag: str, node: int, kind: int, link: bool):
        self.tag, self.node, self.kind, self.link = tag, node, kind, link


def _enter(parent: _Element, tag: str, raw: str) -> _Element:
    from xxhash import xxh64_intdigest

    found = {m[0].lower(): m[1] or m[2] or m[3] for m in _ATTR.findall(raw)} if raw and raw != "/" else {}
    names = f"{found.get('class', '')} {found.get('id', '')}".strip()
    kind = parent.kind
    if kind != _IS_NOISE:
        role = found.get("role", "").lower()
        noise = (
            tag in _NOISE_TAGS or role in _NOISE_ROLES or "hidden" in found or found.get("aria-hidden") == "true"
            or (tag == "header" and kind != _IS_ARTICLE) or bool(_HIDDEN.search(found.get("style", "")))
            or (tag not in ("html", "body", "main") and bool(names) and _noise_name(names))
        )
        kind = _IS_NOISE if noise else _IS_ARTICLE if tag in ("article", "main") or role == "main" else kind
    if tag in _INLINE and kind == parent.kind:
        node = parent.node  # inline markup is layout of its block, not a branch
    else:
        label = re.sub(r"[0-9]+", "0", names)
        node = xxh64_intdigest(f"{parent.node}/{tag}.{label}") - (1 << 63)
    return _Element(tag, node, kind, parent.link or tag == "a")


def parse(html: str) -> list[tuple[int, int, str, int, str]]:
    """Blocks in page order: (node, kind, text, characters inside links, inline tags)."""
    root = _Element("", 0, _NEUTRAL, False)
    stack, opened = [root], {"": 1}
    blocks: list[tuple[int, int, str, int, str]] = []
    parts: list[str] = []
    inline: list[str] = []
    linked = 0

    def flush() -> None:
        nonlocal linked
        if parts:
            text = " ".join(unescape("".join(parts)).split())
            if text:
                top = stack[-1]
                blocks.append((top.node, top.kind, text, min(linked, len(text)), " ".join(inline)))
            parts.clear()
        inline.clear()
        linked = 0

    def pop_to(tag: str) -> None:
        while True:
            gone = stack.pop()
            opened[gone.tag] -= 1
            if gone.tag == tag:
                return

    for token in _TOKEN.finditer(html):
        text = token["text"]
        if text is not None:
            parts.append(text)
            if stack[-1].link:
                linked += len(text.strip())
            continue
        tag = token["tag"]
        if tag is None:
            if token["raw"] is None and token[0] == "<":
                parts.append("<")
            continue
        tag = tag.lower()
        if tag in _VOID:
            if tag in ("br", "hr"):
                flush()
            continue
        if token["close"]:
            if opened.get(tag):
                if tag not in _INLINE or any(e.node != stack[-1].node for e in stack[-2:-1] if stack[-1].tag == tag):
                    flush()
                pop_to(tag)
            continue
        if tag not in _INLINE:
            flush()
            if tag in _CLOSES_P and opened.get("p"):
                pop_to("p")
            if tag in _LISTS and opened.get(tag):
                for element in reversed(stack):
                    if element.tag == tag:
                        pop_to(tag)
                        break
                    if element.tag in _LISTS[tag]:
                        break
        element = _enter(stack[-1], tag, token["attrs"])
        if tag in _INLINE:
            if element.node != stack[-1].node:
                flush()
            inline.append(tag)
        if not token["attrs"].endswith("/") or tag in _INLINE:
            stack.append(element)
            opened[tag] = opened.get(tag, 0) + 1
    flush()
    return blocks


def host_of(url: str | None) -> str:
    found = re.match(r"(?:[a-zA-Z][a-zA-Z0-9+.-]*:)?//(?:[^/?#@]*@)?([^/?#:]*)", url or "")
    return found[1].lower() if found else ""


_BLOCK = "array<struct<node:long,kind:int,text:string,linked:int,inline:string>>"
_ARROW_BLOCK = pa.list_(pa.struct([("node", pa.int64()), ("kind", pa.int32()), ("text", pa.string()), ("linked", pa.int32()), ("inline", pa.string())]))


def parsed(pages: DataFrame, key: str, url: str, html: str) -> DataFrame:
    """(k, h, url, host, blocks) per page."""
    fields = ("node", "kind", "text", "linked", "inline")

    def run(batch: pa.RecordBatch) -> pa.RecordBatch:
        blocks = [[dict(zip(fields, b, strict=True)) for b in parse(x)] for x in texts(batch.column(3))]
        hosts = [host_of(u) for u in batch.column(2).to_pylist()]
        return pa.RecordBatch.from_arrays(
            [batch.column(0), batch.column(1), batch.column(2), pa.array(hosts, pa.string()), pa.array(blocks, _ARROW_BLOCK)],
            names=["k", "h", "url", "host", "blocks"],
        )

    narrow = pages.select(F.col(key).cast("long").alias("k"), F.xxhash64(html, url).alias("h"), F.col(url).alias("url"), F.col(html).alias("html"))
    return arrow_map(narrow, run, f"k long, h long, url string, host string, blocks {_BLOCK}")


def style_tree(blocks: DataFrame) -> DataFrame:
    """(host, node, pages, presentation, content, importance) over (k, h, host, node, kind, feature, chars, linked, inline)."""
    on_page = blocks.groupBy("host", "node", "k", "h").agg(
        F.max("kind").alias("kind"), F.count("*").alias("n"), F.sum("chars").alias("chars"), F.sum("linked").alias("linked"), F.bit_xor("inline").alias("inline"))
    sizes = on_page.groupBy("host", "node").agg(
        F.count("*").alias("pages"), F.max("kind").alias("kind"), F.sum("chars").alias("chars"), F.sum("linked").alias("linked"))
    shared = (
        blocks.groupBy("host", "node", "feature", "k", "h").agg(F.lit(1).alias("one"))
        .groupBy("host", "node", "feature").agg(F.count("*").alias("f"))
        .groupBy("host", "node").agg((F.sum(F.col("f") * F.log("f")) / F.sum("f")).alias("repeats"))
    )
    layouts = on_page.groupBy("host", "node", F.xxhash64("n", "inline").alias("layout")).agg(F.count("*").alias("f"))
    entropy = layouts.groupBy("host", "node").agg((F.log(F.sum("f")) - F.sum(F.col("f") * F.log("f")) / F.sum("f")).alias("entropy"))
    base = F.log("pages")
    presentation = F.when(F.col("pages") >= FEW, F.col("entropy") / base).otherwise(1.0)
    content = F.when(F.col("pages") >= FEW, 1 - F.col("repeats") / base).otherwise(1.0)
    own = (presentation + content) / 2
    linked = F.col("linked") > LINKS * F.col("chars")
    weighted = (
        F.when(F.col("kind") == _IS_ARTICLE, ARTICLE + (1 - ARTICLE) * own)
        .when((F.col("kind") == _IS_NOISE) | linked, NOISE * own).otherwise(own)
    )
    return sizes.join(shared, ["host", "node"]).join(entropy, ["host", "node"]).select(
        "host", "node", "pages", presentation.alias("presentation"), content.alias("content"), weighted.alias("importance"))


def _with_low(rows: DataFrame, each: DataFrame, low: DataFrame) -> DataFrame:
    """``rows`` with ``gone``, the low nodes of the page.

    Up to ``SMALL`` low nodes (some 20 MB) go to all tasks as one list per host, so texts are not shuffled. Beyond that
    each page is joined with its own nodes only.
    """
    if low.count() <= SMALL:
        return rows.join(F.broadcast(low.groupBy("host").agg(F.collect_set("node").alias("gone"))), "host", "left")
    gone = each.select("k", "h", "host", "node").distinct().join(low, ["host", "node"]).groupBy("k", "h").agg(F.collect_set("node").alias("gone"))
    same = F.col("a.h").eqNullSafe(F.col("b.h")) & F.col("a.k").eqNullSafe(F.col("b.k"))
    return rows.alias("a").join(store(gone, "html-gone").alias("b"), same, "left").select("a.*", "b.gone")


def extract(pages: DataFrame, key: str = "page_id", url: str = "url", html: str = "html") -> DataFrame:
    """(key, url, text, n_chars) per page."""
    rows = store(parsed(pages, key, url, html), "html-blocks")
    each = rows.select("k", "h", "host", F.explode("blocks").alias("b")).select(
        "k", "h", "host", "b.node", "b.kind", F.xxhash64("b.text").alias("feature"), F.length("b.text").alias("chars"), "b.linked", F.xxhash64("b.inline").alias("inline"))
    low = store(style_tree(each).where(F.col("importance") < LEAST).select("host", "node"), "html-low")
    joined = _with_low(rows, each, low)
    dropped = F.coalesce(F.col("gone"), F.array().cast("array<long>"))
    stay = F.filter("blocks", lambda x: ~F.array_contains(dropped, x["node"]))
    once = joined.select("k", "url", F.explode(F.array(stay)).alias("stay"))
    inside = F.filter("stay", lambda x: x["kind"] == _IS_ARTICLE)
    main = F.when(F.size(inside) > 0, inside).otherwise(F.col("stay"))
    text = F.array_join(F.transform(main, lambda x: x["text"]), " ")
    return once.select(F.col("k").alias(key), F.col("url").alias(url), text.alias("text")).withColumn("n_chars", F.length("text").cast("long"))


@query("op10_html_text")
def op10_html_text(spark: SparkSession, folder: str) -> DataFrame:
    return extract(table(spark, folder, "pages"))
