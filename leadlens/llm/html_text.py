"""Main text of web pages: page structure first, then a host's repeated runs.

A page's markup is read into blocks of text. Blocks inside ``article`` (or
``main``) make the text; menus, headers, footers, sidebars, notices, adverts,
forms, comments, scripts and styles are left out by element, role and class.
Names of classes are judged whole. What an article or a wrapper around it is
called counts only where the page has another one that isn't called so. Outside
articles hidden elements are left out too. What this leaves of a page, its
article or, where it has none, all of it, is then searched together with the
other pages of its host for long substrings that recur. These are runs of ``LONG`` tokens wherever they
start (the suffixes of a host's stream, cut there, that equal their neighbours
in sorted order), and runs of whole blocks with at least ``RUN`` tokens, so that
a short menu goes but a phrase that sentences share stays. A run is boilerplate
where it recurs on ``SHARE`` of the host's distinct page texts, and on two at
least; pages whose texts are copies of one another are one page, and a host of
fewer than ``LEAST`` texts has no boilerplate, since two pages can't tell a menu
from a text that both carry. Covered tokens go, the others stay. Pages without an
article are searched for what recurs outside articles. Articles are searched for
what recurs inside the host's articles, on ``ARTICLE_SHARE`` of their distinct
texts: notices and adverts that no element, role or class tells from the
article. Where that is half of an article or more, the articles are versions of
one text, and it stays whole.

Character references are decoded, white space inside a block becomes one space,
blocks are joined by one line feed.

Defined cases: a null or empty html has no text; a page without an article
that is boilerplate throughout has none; rows that repeat a whole page are one
page to the host's search; a null url belongs to the empty host; unclosed elements are
closed where the standard's rules for paragraphs, list items and table cells
say, or with their parent; a page that ends inside a tag ends before it; a quote
that is never closed is an ordinary character; parsing takes time in proportion
to the page, whatever its markup; further columns are not read.

Scale: every page is parsed once, and its main blocks and the hashes of its runs
are written. The hashes are shuffled, dealt by host, run and page text before
they are counted by host and run, so a host that holds a third of all pages is
spread over the tasks; main blocks meet the repeated runs of their page by its key,
and those of pages that a screen of such keys rules out don't move.
Long runs inside articles are counted in two steps, since every token of a text
starts one: first their anchors (a twentieth as many), and then the runs whose
anchor recurs as often as a run must, so that none is missed.
"""

from __future__ import annotations

import html as entities
import re
from collections import defaultdict
from collections.abc import Iterator
from dataclasses import dataclass, replace

import numpy as np
import pandas as pd
import xxhash
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from leadlens.llm.tables import Scratch
from leadlens.llm.url_filter import host_of
from leadlens.operators.screen import marked, screen

RUN = 6             # tokens of a run of whole blocks, at least
LONG = 50           # tokens of a run that starts anywhere
GRAM = 10           # tokens whose hashes choose the anchor of a long run
SHARE = 0.5
ARTICLE_SHARE = 0.8
LEAST = 3
# Possessive throughout: a scan either moves on or ends, so parsing is linear.
_MARKUP = re.compile(
    r"""<!--.*?(?:-->|\Z)|<[!?][^>]*+(?:>|\Z)"""
    r"""|<(/?)([a-zA-Z][^\s/>]*+)((?:[^>"'=]++|=\s*+"[^"]*+"|=\s*+'[^']*+'|[="'])*+)(?:>|(\Z))|<""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s/>="']++)(?:\s*+=\s*+(?:"([^"]*+)"|'([^']*+)'|([^\s"'>]++)))?+""")
# fixed values: elements of the HTML standard by what they mean for the text
VOID = {"area", "base", "br", "col", "embed", "hr", "img", "input", "link", "meta", "source", "track", "wbr"}
RAW = {"script", "style", "template", "iframe", "textarea", "title", "xmp", "noembed", "noframes"}
DROPPED = {"head", "nav", "header", "footer", "aside", "form", "menu", "dialog", "button", "select", "svg",
           "canvas", "object", "audio", "video", "datalist", "fieldset"}
HEADINGS = {"h1", "h2", "h3", "h4", "h5", "h6"}
INLINE = {"a", "abbr", "acronym", "b", "bdi", "bdo", "big", "br", "cite", "code", "data", "del", "dfn", "em",
          "font", "i", "img", "ins", "kbd", "label", "mark", "q", "rp", "rt", "ruby", "s", "samp", "small",
          "span", "strike", "strong", "sub", "sup", "time", "tt", "u", "var", "wbr"}
CLOSES = {"li": ("p", "li"), "dt": ("p", "dt", "dd"), "dd": ("p", "dt", "dd"), "tr": ("p", "tr", "td", "th"),
          "td": ("p", "td", "th"), "th": ("p", "td", "th"), "option": ("p", "option"),
          "tbody": ("p", "thead", "tbody", "tr", "td", "th")}
_PARAGRAPH = ("p",)
KEEPS_OPEN = {"html", "body", "main", "article", "section", "div", "table", "ul", "ol", "dl", "blockquote", "td", "th"}
BOILERPLATE = {"ad", "ads", "advert", "adverts", "advertisement", "advertising", "banner", "breadcrumb",
               "breadcrumbs", "comment", "comments", "consent", "cookie", "cookies", "disqus", "footer", "gdpr",
               "login", "menu", "modal", "nav", "navbar", "navigation", "newsletter", "notice", "pagination",
               "popup", "promo", "related", "search", "share", "sharing", "sidebar", "signup", "social",
               "sponsor", "sponsored", "subscribe", "toolbar", "widget"}
# words that may stand beside those in the name of a class, and say nothing themselves
NEUTRAL = {"area", "bar", "block", "bottom", "box", "center", "column", "container", "content", "inner", "item",
           "items", "left", "list", "main", "middle", "outer", "page", "panel", "post", "primary", "right", "row",
           "secondary", "section", "site", "slot", "top", "unit", "wrap", "wrapper"}
ROLES = {"navigation", "banner", "contentinfo", "complementary", "search", "form", "dialog", "alert",
         "alertdialog", "menu", "menubar"}


def _boilerplate_name(name: str) -> bool:
    """Whether a class says that an element isn't text: it is one of the names,
    or made of them and neutral words (``post-comments``, ``ad-slot``). In
    ``social-policy`` another word says what it is about."""
    words = [w for w in re.split(r"[_-]+", name) if w]
    return not BOILERPLATE.isdisjoint(words) and all(w in BOILERPLATE or w in NEUTRAL for w in words)


def _left_out(tag: str, attributes: str, in_article: bool) -> bool:
    if tag in DROPPED and not (tag == "header" and in_article):
        return True
    if tag in ("html", "body", "main") or not attributes:
        return False
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m.group(1).lower(), (m.group(2) or m.group(3) or m.group(4) or "").lower()
        if name == "class" and any(map(_boilerplate_name, value.split())):
            return True
        if name == "id" and tag not in HEADINGS and tag != "p" and _boilerplate_name(value.strip()):
            return True         # ids of headings and paragraphs are slugs of their texts
        if name == "role" and value.strip() in ROLES:
            return True
        if not in_article and (name == "hidden" or (name == "aria-hidden" and value == "true") or (
                name == "style" and re.search(r"display\s*+:\s*+none|visibility\s*+:\s*+hidden", value))):
            return True
    return False


@dataclass(frozen=True)
class Place:
    """Where a block stands. ``wrapped``: so many elements around its article (or
    main) would be left out, itself included; ``out``: so many inside it would."""

    article: bool = False
    main: bool = False
    wrapped: int = 0
    out: int = 0


class _Open:
    """The elements that are open, the nearest of each name at hand."""

    def __init__(self):
        self.stack: list[tuple[str, Place, int]] = []      # element, place, the nearest fence up to it
        self.at: dict[str, list[int]] = defaultdict(list)

    def place(self) -> Place:
        return self.stack[-1][1] if self.stack else Place()

    def push(self, tag: str, place: Place) -> None:
        k = len(self.stack)
        fence = k if tag in KEEPS_OPEN else self.stack[-1][2] if self.stack else -1
        self.stack.append((tag, place, fence))
        self.at[tag].append(k)

    def close_one_of(self, tags: tuple[str, ...]) -> None:
        """The nearest of ``tags`` that no fence shuts off."""
        nearest = -1
        for t in tags:
            if self.at[t] and self.at[t][-1] > nearest:
                nearest = self.at[t][-1]
        if nearest >= 0 and nearest >= self.stack[-1][2]:
            self.cut(nearest)

    def cut(self, k: int) -> None:
        """Element ``k`` and all inside it end."""
        while len(self.stack) > k:
            self.at[self.stack.pop()[0]].pop()


def blocks(source: str) -> Iterator[tuple[Place, str]]:
    """Place and text of each block of text, in page order."""
    opened = _Open()
    text: list[str] = []
    at, end = 0, len(source)

    def flush():
        block = " ".join("".join(text).split())
        text.clear()
        if block:
            yield opened.place(), block
    while at < end:
        if source[at] != "<":
            to = source.find("<", at)
            piece = source[at:to if to >= 0 else end]
            text.append(entities.unescape(piece) if "&" in piece else piece)
            at += len(piece)
            continue
        m = _MARKUP.match(source, at)
        at = m.end()
        closing, tag, attributes, cut = m.groups()
        if tag is None:
            if m.group() == "<":
                text.append("<")
            continue
        if cut is not None:                    # the page ends inside a tag
            break
        tag = tag.lower()
        if tag not in INLINE:
            if text:
                yield from flush()
        elif tag == "br":
            text.append(" ")
        if closing:
            if opened.at[tag]:
                k = opened.at[tag][-1]
                if opened.place() != (opened.stack[k - 1][1] if k else Place()):
                    yield from flush()
                opened.cut(k)
            continue
        above = opened.place()
        if tag in RAW or (tag == "noscript" and not (above.article or above.main)):
            stop = re.compile(rf"</{re.escape(tag)}\b[^>]*+(?:>|\Z)", re.I).search(source, at)
            at = stop.end() if stop else end
            continue
        if tag in VOID:
            continue
        if tag not in INLINE:
            opened.close_one_of(CLOSES.get(tag, _PARAGRAPH))
            above = opened.place()
        out = above.out
        if (attributes or tag in DROPPED) and _left_out(tag, attributes, above.article):
            out += 1
        article, main = tag == "article", tag == "main" or bool(
            attributes and "main" in attributes and re.search(r"role\s*+=\s*+[\"']?+main\b", attributes))
        if (article and not above.article) or (main and not (above.article or above.main)):
            here = Place(above.article or article, above.main or main, above.wrapped + out)
        elif out != above.out:
            here = replace(above, out=out)
        else:
            here = above
        if here is not above:
            yield from flush()
        opened.push(tag, here)
    yield from flush()


def _hash(text: str) -> int:
    h = xxhash.xxh64_intdigest(text)
    return h - (1 << 64) if h >> 63 else h


def _block_runs(found: list[str]) -> Iterator[tuple[int, int, int]]:
    """(first token, end, hash) of the runs of whole blocks."""
    ends = [0]
    for block in found:
        ends.append(ends[-1] + len(block.split()))
    n, spans = len(found), set()
    # the shortest runs that start with each block and that end with each block
    for k in range(n):
        spans.add((k, next((j for j in range(k + 1, n + 1) if ends[j] - ends[k] >= RUN), 0)))
        spans.add((next((j for j in range(k, -1, -1) if ends[k + 1] - ends[j] >= RUN), n), k + 1))
    for i, j in spans:
        if i < j:
            yield ends[i], ends[j], _hash("\n".join(["", *found[i:j]]))


def _runs(found: list[str]) -> Iterator[tuple[int, int, int]]:
    """Those, and the long runs."""
    yield from _block_runs(found)
    stream = " ".join(found).split()
    for k in range(len(stream) - LONG + 1):
        yield k, k + LONG, _hash(" ".join(stream[k:k + LONG]))


def _anchors(stream: list[str]) -> np.ndarray:
    """Of each long run the smallest hash of its ``GRAM`` tokens: the same wherever
    the run stands, and mostly the same as its neighbour's."""
    if len(stream) < LONG:
        return np.empty(0, dtype=np.int64)
    grams = np.array([_hash(" ".join(stream[k:k + GRAM])) for k in range(len(stream) - GRAM + 1)], dtype=np.int64)
    return np.lib.stride_tricks.sliding_window_view(grams, LONG - GRAM + 1).min(axis=1)


def _anchored(main: list[str], anchors: set[int]) -> set[int]:
    """Hashes of the long runs that have one of these anchors."""
    stream = " ".join(main).split()
    return {_hash(" ".join(stream[k:k + LONG])) for k, a in enumerate(_anchors(stream).tolist()) if a in anchors}


def _article(found: list[tuple[Place, str]]) -> list[str] | None:
    """The blocks of the article element; those of ``main``, if more of it lies
    beside the articles in it than inside articles, since those are teasers
    then. Of several, those that the fewest wrappers speak against."""
    own = [(p, b) for p, b in found if not p.out and (p.article or p.main)]
    least = min((p.wrapped for p, _ in own), default=0)
    own = [(p, b) for p, b in own if p.wrapped == least]
    articles = [b for p, b in own if p.article]
    beside = [b for p, b in own if not p.article]
    if sum(map(len, beside)) > sum(map(len, articles)):
        return [b for p, b in own if p.main]
    return articles or None


def read(source: str | None) -> tuple[bool, list[str], list[int], list[int], int]:
    """Whether the page has an article, its main blocks (all that structure
    leaves, without one), hashes of the runs outside articles, of the block runs
    and anchors inside, and of the page's text."""
    found = list(blocks(source or ""))
    article = _article(found)
    outside = [(p.out > 0, b) for p, b in found if not (p.article or p.main)]
    outer = {h for _, _, h in _runs([b for _, b in outside])}
    outer |= {h for _, _, h in _runs([b for out, b in outside if not out])}
    inner = {h for _, _, h in _block_runs(article or [])} | set(_anchors(" ".join(article or []).split()).tolist())
    main = [b for p, b in found if not p.out] if article is None else article
    return article is not None, main, sorted(outer), sorted(inner), _hash(" ".join(" ".join(main).split()))


def unique_runs(rest: list[str], repeated: set[int]) -> str:
    """Blocks without the tokens that a repeated run covers."""
    tokens = [(k, t) for k, b in enumerate(rest) for t in b.split()]
    covered = [False] * len(tokens)
    for start, end, run in _runs(rest) if repeated else ():
        if run in repeated:
            covered[start:end] = [True] * (end - start)
    out: dict[int, list[str]] = {}
    for (k, t), gone in zip(tokens, covered, strict=True):
        if not gone:
            out.setdefault(k, []).append(t)
    return "\n".join(" ".join(words) for words in out.values())


def main_text(article: bool, main: list[str], repeated: set[int]) -> str:
    """What the host's search leaves of a page's main blocks."""
    whole = "\n".join(main)
    if not repeated:
        return whole
    text = unique_runs(main, repeated)
    return whole if article and 2 * len(text.split()) <= len(whole.split()) else text


def extracted(pages: DataFrame) -> DataFrame:
    """page_id, url, text of every page."""
    @F.pandas_udf("article boolean, main array<string>, outer array<long>, inner array<long>, said long")
    def parse(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
        for sources in batches:
            yield pd.DataFrame([read(s) for s in sources], columns=["article", "main", "outer", "inner", "said"])

    @F.pandas_udf("string")
    def unique(batches: Iterator[tuple[pd.Series, pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for article, main, repeated in batches:
            yield pd.Series([main_text(a, list(b), set() if r is None else {int(x) for x in r})
                             for a, b, r in zip(article, main, repeated, strict=True)], dtype=object)
    @F.pandas_udf("array<long>")
    def anchored(batches: Iterator[tuple[pd.Series, pd.Series]]) -> Iterator[pd.Series]:
        for main, anchors in batches:
            yield pd.Series([list(_anchored(list(b), {int(x) for x in a})) for b, a in zip(main, anchors, strict=True)],
                            dtype=object)
    url = F.coalesce("url", F.lit(""))
    work = Scratch(pages.sparkSession, "html-text")
    read_once = work.write(
        pages.select("page_id", "url", host_of(url).alias("host"),
                     F.xxhash64(F.col("page_id").cast("string"), "url", "html").alias("key"), parse("html").alias("p"))
        .select("page_id", "url", "host", "key", "p.*"), "pages", compression="zstd")
    # distinct texts first, then their number: two shuffles, and no task holds a host
    texts = (read_once.groupBy("host", "said").agg(F.max("article").alias("article"))
             .groupBy("host").agg(F.count(F.lit(1)).alias("texts"), F.count_if("article").alias("articles")))
    among = F.when(F.col("article"), F.col("articles")).otherwise(F.col("texts"))
    share = F.when(F.col("article"), ARTICLE_SHARE).otherwise(SHARE)

    def on_pages(runs: DataFrame, counted: DataFrame, name: str) -> DataFrame:
        """By key, those of a page's ``runs`` that are often enough among the ``counted``."""
        # most runs are on pages of one text only: they go after one shuffle
        twice = work.write(counted.groupBy("host", "article", "run").agg(F.min("said").alias("lo"), F.max("said").alias("hi"))
                           .where("lo < hi").select("host", "article", "run"), f"{name}-twice")
        often = (counted.join(twice, ["host", "article", "run"]).select("host", "article", "said", "run").distinct()
                 .groupBy("host", "article", "run").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
                 .join(texts, "host").where((among >= LEAST) & (F.col("n") >= share * among))
                 .select("host", "article", "run"))
        # written, so that Spark knows its size and moves no runs where it is small
        return (runs.join(work.write(often, name), ["host", "article", "run"])
                .groupBy("key").agg(F.collect_set("run").alias("repeated")))

    def exploded(rows: DataFrame, runs: Column, article: Column) -> DataFrame:
        return rows.select("key", "host", "said", article.alias("article"), F.explode(runs).alias("run"))
    inside = F.col("article")
    inner = exploded(read_once.where(inside), F.col("inner"), inside)
    bare = exploded(read_once.where(~inside), F.col("outer"), inside)
    first = work.write(on_pages(inner.unionByName(bare),
                                inner.unionByName(exploded(read_once, F.col("outer"), F.lit(False))), "often"), "first")
    hit = marked(read_once, ["key"], screen(first, ["key"]), "hit")          # most pages have no such run: they stay
    long = exploded(hit.where(inside & F.col("hit")).join(first, "key"), anchored("main", "repeated"), inside)
    covered = (first.unionByName(on_pages(long, long, "often-long")).groupBy("key")
               .agg(F.flatten(F.collect_list("repeated")).alias("repeated")))
    found = (hit.where("hit").join(covered, "key", "left").select("page_id", "url", "article", "main", "repeated")
             .unionByName(hit.where("not hit").select("page_id", "url", "article", "main",
                                                      F.lit(None).cast("array<long>").alias("repeated"))))
    return found.select("page_id", "url", unique("article", "main", "repeated").alias("text"))
