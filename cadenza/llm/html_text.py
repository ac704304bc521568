"""Main text of web pages by site style trees.

The DOMs of a host's pages are merged into one tree: elements with the same path of tags, classes and ids are one
style node, whatever page they come from. A node's importance is the entropy of what its branch contains over the
pages that have it, divided by its highest possible value: 0 if every page shows the same, 1 if no two pages do. Pages
of a host with the same marked main part, or without one the same text, are one page here, so copies are no evidence. Nodes
that state their purpose need no statistics: menus, forms, adverts, notices, comments and the like have importance 0,
``article`` and ``main`` have importance 1. Each page then loses its branches of low importance; where a page marks its
main part, what stands outside it goes as well. Plain paragraphs and headings inside a marked main part always stay, so
that pages which are copies of each other keep their article.

Pages are parsed as streams of tags on the executors, tolerantly: unclosed and stray tags, raw elements, cut-off pages.
Copies are reduced per (host, hash of the main text) and statistics counted per (host, node, content), both with partial
aggregation, so neither a hot host nor a page of many copies is a group in one task; only
style nodes that can be removed go back to the pages, as one short row per host, by a join on host and a salt of the page,
so a host with a third of all pages is spread as well.

Defined cases: null and empty html, and pages with nothing but boilerplate, give an empty text. A url without a host
has no siblings, so only stated purposes count. Repeated pages are extracted alike and change no other page. Extra columns are not carried.
"""

from __future__ import annotations

import html as entities
import re
from collections.abc import Iterator

import pandas as pd
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

#: Elements by their role in HTML.
RAW = ("script", "style", "noscript", "template", "textarea", "title", "iframe", "svg", "math", "object", "canvas", "audio", "video", "xmp", "select")
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "param", "source", "track", "wbr"}
INLINE = {
    "a", "abbr", "acronym", "b", "bdi", "bdo", "big", "cite", "code", "data", "del", "dfn", "em", "font", "i", "ins", "kbd", "label",
    "mark", "q", "ruby", "rb", "rp", "rt", "s", "samp", "small", "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr", "img",
}
PLAIN = INLINE | {"p", "h1", "h2", "h3", "h4", "h5", "h6", "li", "blockquote", "pre", "td", "th", "tr", "tbody", "thead", "dt", "dd", "figure", "figcaption"}
NOISE = {"nav", "footer", "aside", "form", "button", "menu", "dialog", "head", "fieldset", "legend", "datalist", "marquee"}
NOISE_ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert", "alertdialog", "menu", "menubar", "toolbar"}
NOISE_WORDS = {
    "ad", "ads", "adv", "advert", "adverts", "advertisement", "advertising", "sponsor", "sponsored", "promo", "promotion", "banner",
    "nav", "navbar", "navigation", "menu", "breadcrumb", "breadcrumbs", "header", "masthead", "footer", "sidebar", "aside", "widget",
    "cookie", "cookies", "consent", "notice", "gdpr", "popup", "modal", "overlay", "alert", "comment", "comments", "disqus", "reply",
    "replies", "respond", "share", "sharing", "social", "newsletter", "subscribe", "signup", "login", "related", "recommended",
    "pagination", "pager", "toolbar", "copyright", "skip",
}
#: An element of the key closes an open element of the value.
CLOSES = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
#: An end tag or an implied end does not reach out of these.
SCOPES = {"table", "ul", "ol", "dl", "article", "main", "body", "html"}

MIN_PAGES = 4
IMPORTANCE = 0.5
#: Partitions that one host's pages are dealt to, at most; its row of removable style nodes is copied as often.
SALTS = 64
TAG = re.compile(
    rf"<!--.*?(?:-->|\Z)|<({'|'.join(RAW)})(?=[\s/>]).*?(?:</\1\s*>|\Z)|<[!?][^>]*(?:>|\Z)"
    r"""|<(/?)([a-z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"'])*+)(?:>|\Z)""", re.S | re.I)
ATTRIBUTE = re.compile(r"""(class|id|role|hidden|aria-hidden)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>"']+))?(?=[\s/>]|\Z)""", re.I)
WORD = re.compile(r"[a-z]+")
HOST = r"^[a-z][a-z0-9+.-]*://(?:[^/?#@]*@)?([^/?#:]+)"
NODES = "array<struct<node:bigint,content:bigint>>"


class _Element:
    __slots__ = ("tag", "node", "noise", "main", "doubt", "content")

    def __init__(self, tag: str, node: int, noise: bool, main: bool, doubt: bool):
        self.tag, self.node, self.noise, self.main, self.doubt = tag, node, noise, main, doubt
        self.content = xxhash.xxh3_64()


def _style(tag: str, attributes: str) -> tuple[str, bool, bool]:
    """Label of an element's style; whether it states that it is noise, and that it is hidden from the text's flow."""
    if not attributes or attributes.isspace():
        return tag, tag in NOISE, False
    values = {k.lower(): (v or "").strip("\"'").lower() for k, v in ATTRIBUTE.findall(attributes)}
    names = sorted(set(WORD.findall(f"{values.get('class', '')} {values.get('id', '')}")))
    role = values.get("role", "")
    noise = tag in NOISE or role in NOISE_ROLES or "hidden" in values or values.get("aria-hidden") == "true"
    if tag not in ("article", "main", "body", "html") and not NOISE_WORDS.isdisjoint(names):
        noise = True
    return " ".join([tag, *names, role]), noise, role == "main"


def parse(html: str | None) -> tuple[list[tuple[int, int]], list[tuple[str, list[int]]]]:
    """Style nodes (node, content) of a page, and its text blocks with the style nodes that decide on each of them."""
    nodes: list[tuple[int, int]] = []
    blocks: list[tuple[str, bool, list[int]]] = []
    stack: list[_Element] = [_Element("", 0, False, False, False)]
    buffer: list[str] = []
    place, has_main = 0, False

    def flush() -> None:
        text = " ".join("".join(buffer).split())
        buffer.clear()
        top = stack[-1]
        if text and not top.noise:
            blocks.append((text, top.main, [e.node for e in stack if e.doubt]))

    def close(count: int) -> None:
        for element in reversed(stack[count:]):
            if element.tag not in INLINE:
                flush()
            if element.doubt:
                nodes.append((element.node, element.content.intdigest() - (1 << 63)))
            stack.pop()

    def text(raw: str) -> None:
        if raw:
            decoded = entities.unescape(raw)
            if stack[-1].noise:
                return
            buffer.append(decoded)
            if not decoded.isspace():
                for element in stack:
                    if element.doubt:
                        element.content.update(decoded.encode("utf-8", "replace"))

    source = html or ""
    for found in TAG.finditer(source):
        text(source[place:found.start()])
        place = found.end()
        if found[3] is None:
            continue
        tag, ends = found[3].lower(), bool(found[2])
        if tag == "br" or tag in VOID:
            if tag in INLINE or tag == "br":
                buffer.append(" ")
            else:
                flush()
            continue
        if ends:
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag == tag:
                    close(i)
                    break
                if stack[i].tag in SCOPES and tag not in SCOPES and tag not in NOISE and tag not in ("div", "section"):
                    break
            continue
        if tag not in INLINE:
            flush()
            implied = CLOSES.get(tag, set()) | {"p"}
            for i in range(len(stack) - 1, 0, -1):
                if stack[i].tag in implied:
                    close(i)
                    break
                if stack[i].tag in SCOPES or (stack[i].tag not in INLINE and stack[i].tag not in PLAIN):
                    break
        above = stack[-1]
        label, noise, role_main = _style(tag, found[4])
        main = above.main or tag in ("article", "main") or role_main
        if tag == "header" and not above.main:
            noise = True
        noise = above.noise or noise
        has_main |= main and not noise
        doubt = not noise and tag not in ("html", "body", "article", "main") and not (
            tag in INLINE and label == tag) and not (main and tag in PLAIN)
        node = xxhash.xxh3_64_intdigest(f"{above.node} {label}") - (1 << 63)
        stack.append(_Element(tag, node, noise, main, doubt))
    text(source[place:])
    close(1)
    flush()
    return nodes, [(t, path) for t, main, path in blocks if main or not has_main]


def _nodes(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        found, keys = [], []
        for html in batch["html"]:
            merged: dict[int, int] = {}
            nodes, blocks = parse(html)
            for node, content in nodes:  # siblings of one style are one node
                merged[node] = (31 * merged.get(node, 0) + content) % (1 << 62)
            found.append([{"node": n, "content": c} for n, c in merged.items()])
            keys.append(xxhash.xxh3_64_intdigest("\n".join(t for t, _ in blocks).encode("utf-8", "replace")) - (1 << 63))
        yield pd.DataFrame({"host": batch["host"], "main": keys, "nodes": found})


def style_nodes(pages: DataFrame) -> DataFrame:
    """Importance of each style node of each host: host, node, pages, importance. ``pages`` has ``host`` and ``html``.

    Of the pages with the same main text, the one with the least nodes counts.
    """
    found = pages.where("host <> ''").select("host", "html").mapInPandas(_nodes, f"host string, main bigint, nodes {NODES}")
    distinct = found.groupBy("host", "main").agg(F.min("nodes").alias("nodes"))
    counts = (
        distinct.select("host", F.explode("nodes").alias("n"))
        .groupBy("host", F.col("n.node").alias("node"), F.col("n.content").alias("content")).agg(F.count(F.lit(1)).alias("c"))
    )
    sums = counts.groupBy("host", "node").agg(F.sum("c").alias("pages"), F.sum(F.col("c") * F.log("c")).alias("s"))
    entropy = F.log("pages") - F.col("s") / F.col("pages")
    return sums.select("host", "node", "pages", F.when(F.col("pages") > 1, entropy / F.log("pages")).otherwise(1.0).alias("importance"))


def _texts(batches: Iterator[pd.DataFrame]) -> Iterator[pd.DataFrame]:
    for batch in batches:
        texts = []
        for html, low in zip(batch["html"], batch["low"], strict=True):
            gone = set() if low is None else set(low)
            texts.append("\n".join(t for t, path in parse(html)[1] if gone.isdisjoint(path)))
        yield pd.DataFrame({"page_id": batch["page_id"], "url": batch["url"], "text": texts})


def main_text(pages: DataFrame, min_pages: int = MIN_PAGES, importance: float = IMPORTANCE) -> DataFrame:
    """One row per row of ``pages``: page_id, url, text, n_chars."""
    host = F.coalesce(F.regexp_extract(F.lower("url"), HOST, 1), F.lit(""))
    hosted = pages.select(F.col("page_id").cast("bigint"), F.col("url").cast("string"), F.col("html").cast("string"), host.alias("host"))
    low = style_nodes(hosted).where((F.col("pages") >= min_pages) & (F.col("importance") < importance))
    per_host = low.groupBy("host").agg(F.collect_list("node").alias("low")).withColumn("salt", F.explode(F.sequence(F.lit(0), F.lit(SALTS - 1))))
    salted = hosted.withColumn("salt", F.pmod(F.xxhash64("page_id", "url"), F.lit(SALTS)).cast("int"))
    texts = salted.join(per_host, ["host", "salt"], "left").select("page_id", "url", "html", "low").mapInPandas(
        _texts, "page_id bigint, url string, text string")
    return texts.withColumn("n_chars", F.length("text").cast("bigint"))
