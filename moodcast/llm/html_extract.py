"""Main text of web pages by tag-path ratios.

A small reader turns a page into blocks of text and a table of its
root-to-leaf tag paths, with the characters, the characters outside
links, the punctuation and the number of text nodes of each.  The ratios,
their smoothing along the page, the fused score, the threshold and what
follows from it are Spark expressions over that table.

What the score decides: where no article or main element holds text, the
paths at or above the threshold choose the regions that stay; everywhere, paths
of links (at least two nodes, nearly all text linked) below the threshold go.
Class words are a feature of a path: elements named like noise go unless they
hold a main element or first heading and half of all punctuated text.

Defined results: a null or empty page has the empty text; markup that is
never closed ends with its container, a comment or tag that is never
closed ends the page; every page is one row, repeated rows included;
other columns pass through untouched.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html.parser import HTMLParser
from typing import NamedTuple

import pandas as pd
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import common

# HTML elements by the part they play.
VOID = frozenset("area base br col embed hr img input link meta param source track wbr".split())
INLINE = frozenset("a abbr acronym b bdi bdo big cite code data del dfn em font i ins kbd label mark q rp rt ruby s "
                   "samp small span strike strong sub sup time tt u var".split())
NO_TEXT = frozenset("applet audio button canvas datalist dialog embed fieldset footer form frameset head iframe input "
                    "map math menu nav noframes noscript object optgroup option script select style svg template "
                    "textarea title video aside".split())
SELF_CLOSING = {"li": ("li",), "dt": ("dt", "dd"), "dd": ("dt", "dd"), "tr": ("tr", "td", "th"), "td": ("td", "th"),
                "th": ("td", "th"), "option": ("option",)}
SCOPES = frozenset("article aside body div footer form header main nav ol section table td th ul dl".split())
MAIN = frozenset(("article", "main"))
# Words in class or id, and roles, of what is no article.
NOISE_WORDS = frozenset("ad ads adv advert advertisement advertising banner breadcrumb breadcrumbs comment comments "
                        "consent cookie cookies disqus footer login menu modal nav navbar navigation newsletter notice "
                        "notices pager pagination popup promo promoted promotion related search share sharing sidebar "
                        "signup skip social sponsor sponsored subscribe toolbar widget".split())
NOISE_ROLES = frozenset("alert alertdialog banner complementary contentinfo dialog form menu menubar navigation search"
                        .split())
PUNCTUATION = re.compile(r"[.,;:!?、。，！？…]")
# Words that make a class name tell a state, not a part.
STATE_WORDS = frozenset("closed disabled enabled has no off on open with without".split())
HEADINGS = frozenset("h1 h2 h3 h4 h5 h6".split())
#: A path is one of links if this share of its characters or more is linked.
LINK_SHARE = 0.8
_WORDS = re.compile(r"[a-z]+")
_SPACE = re.compile(r"\s+")
#: A tag, comment or declaration that the end of the page cuts off.
_CUT = re.compile(r"<[a-zA-Z/!?]")


def is_hidden(tag: str, attrs: list[tuple[str, str | None]]) -> bool:
    """Whether the element itself says that it holds no text of the article."""
    if tag in NO_TEXT:
        return True
    if tag in ("html", "body"):
        return False
    for name, value in attrs:
        value = (value or "").lower()
        if name == "role" and value in NOISE_ROLES or name == "hidden" or name == "aria-hidden" and value == "true":
            return True
        if name == "style" and "display:none" in value.replace(" ", ""):
            return True
    return False


def named_noise(tag: str, attrs: list[tuple[str, str | None]]) -> bool:
    """Whether a class name or the id speaks of noise; an article or main
    element has to be named by that word alone."""
    if tag in ("html", "body"):
        return False
    for name, value in attrs:
        if name in ("class", "id"):
            for part in (value or "").lower().split():
                words = _WORDS.findall(part)
                if tag in MAIN and len(words) > 1 or not STATE_WORDS.isdisjoint(words):
                    continue
                if not NOISE_WORDS.isdisjoint(words):
                    return True
    return False


class Element(NamedTuple):
    tag: str
    hidden: bool
    region: int
    main: bool
    group: int  # the outermost element named like noise that it is in; 0: none
    step: str  # its part of a path: the tag and its classes


class PageReader(HTMLParser):
    """Blocks of a page: (path number, region number, in main, text)."""

    def __init__(self) -> None:
        super().__init__(convert_charrefs=True)
        self.stack: list[Element] = []
        self.mains = self.regions = self.groups = self.anchors = 0
        self.text: list[str] = []
        self.unlinked: list[str] = []
        self.blocks: list[tuple[int, int, bool, str]] = []
        self.paths: dict[tuple[str, int], list[int]] = {}
        self.heads: set[int] = set()

    def flush(self) -> None:
        text = _SPACE.sub(" ", "".join(self.text)).strip()
        plain = _SPACE.sub(" ", "".join(self.unlinked)).strip()
        self.text, self.unlinked = [], []
        if not text:
            return
        path = "/".join(e.step for e in self.stack if e.tag not in INLINE)
        if any(e.tag in HEADINGS for e in self.stack):  # a heading may link to its own page
            plain = text
        top = self.top()
        stats = self.paths.setdefault((path, top.group), [len(self.paths), 0, 0, 0, 0])
        stats[1] += 1
        stats[2] += len(text)
        stats[3] += len(plain)
        stats[4] += len(PUNCTUATION.findall(plain))
        self.blocks.append((stats[0], top.region, self.mains > 0, text))

    def top(self) -> Element:
        return self.stack[-1] if self.stack else Element("", False, 0, False, 0, "")

    def say(self, data: str) -> None:
        self.text.append(data)
        self.unlinked.append(" " if self.anchors else data)

    def pop_to(self, at: int) -> None:
        for e in self.stack[at:]:
            self.mains -= e.main
            self.anchors -= e.tag == "a"
        del self.stack[at:]

    def handle_starttag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        if tag in ("br", "hr", "wbr"):
            if not self.top().hidden and tag != "wbr":
                self.say(" ")
            return
        if tag in VOID:
            return
        if tag not in INLINE:
            if not self.top().hidden:
                self.flush()
            closes = SELF_CLOSING.get(tag, ("p",) if tag in ("p", "ul", "ol", "dl", "table", "pre", "blockquote", "div",
                                                            "section", "article", "h1", "h2", "h3", "h4", "h5", "h6",
                                                            "header", "footer", "nav", "aside", "form") else ())
            for at in range(len(self.stack) - 1, -1, -1):
                if self.stack[at].tag in closes:
                    self.pop_to(at)
                    break
                if self.stack[at].tag in SCOPES:
                    break
        top = self.top()
        named = named_noise(tag, attrs)
        code = tag in INLINE and any(e.tag in ("pre", "code") for e in self.stack)
        hidden = (top.hidden or is_hidden(tag, attrs) or tag == "header" and not self.mains
                  or named and tag in INLINE and not code)
        group = top.group
        if named and not hidden and not group and tag not in INLINE:
            self.groups += 1
            group = self.groups
        main = tag in MAIN and not hidden and not named
        if group and not hidden and (main or tag == "h1"):
            self.heads.add(group)
        region = top.region
        if tag in SCOPES and not self.mains:  # the outermost article or main is one region
            self.regions += 1
            region = self.regions
        self.mains += main
        self.anchors += tag == "a"
        if hidden and not top.hidden and tag in INLINE:
            self.say(" ")
        classes = next((value for name, value in attrs if name == "class" and value), "")
        self.stack.append(Element(tag, hidden, region, main, group, ".".join((tag, *classes.split()))))

    def handle_endtag(self, tag: str) -> None:
        for at in range(len(self.stack) - 1, -1, -1):
            if self.stack[at].tag == tag:
                if tag not in INLINE and not self.top().hidden:
                    self.flush()
                self.pop_to(at)
                return
            if tag in INLINE and self.stack[at].tag not in INLINE or tag == "p" and self.stack[at].tag in SCOPES:
                return

    def handle_startendtag(self, tag: str, attrs: list[tuple[str, str | None]]) -> None:
        self.handle_starttag(tag, attrs)

    def handle_data(self, data: str) -> None:
        if not self.top().hidden:
            self.say(data)


BLOCKS = "blocks array<struct<path int, region int, main boolean, text string>>"
PATHS = "paths array<struct<path string, group int, at int, nodes long, chars long, plain long, punct long>>"
HEADS = "heads array<int>"
_PATH = ("path", "group", "at", "nodes", "chars", "plain", "punct")


def read_page(html: str | None) -> PageReader:
    reader = PageReader()
    reader.feed(html or "")
    if _CUT.match(reader.rawdata):  # what is left over was never closed
        reader.rawdata = ""
    reader.close()
    reader.flush()
    return reader


def _read_batches(batches: Iterator[pd.Series]) -> Iterator[pd.DataFrame]:
    for pages in batches:
        got = [read_page(h if isinstance(h, str) else None) for h in pages]
        yield pd.DataFrame({"blocks": [[dict(zip(("path", "region", "main", "text"), b)) for b in r.blocks] for r in got],
                            "paths": [[dict(zip(_PATH, (*k, *v))) for k, v in r.paths.items()] for r in got],
                            "heads": [sorted(r.heads) for r in got]})


def _smoothed(values: Column) -> Column:
    """Weights 1-2-1 along the page, the ends repeated."""
    n = F.size(values)
    return F.transform(values, lambda v, i: (F.get(values, F.greatest(i - 1, F.lit(0))) + 2 * v
                                             + F.get(values, F.least(i + 1, n - 1))) / 4)


def _total(values: Column) -> Column:
    return F.aggregate(values, F.lit(0.0), lambda a, b: a + b)


def live_paths(rows: DataFrame) -> DataFrame:
    """``rows`` (he_page) with ``he_live``, the paths outside elements named
    like noise, and those inside the elements that hold the article after all."""
    def punctuated(kept):
        return F.aggregate(F.filter("he_page.paths", lambda p: kept(p) & (p["punct"] > 0)), F.lit(0).cast("long"),
                           lambda a, p: a + p["plain"])
    rows = rows.withColumn("he_total", punctuated(lambda p: F.lit(True)))
    rows = rows.withColumn("he_groups", F.filter("he_page.heads", lambda g: 2 * punctuated(lambda p: p["group"] == g)
                                                 >= F.col("he_total")))
    return rows.withColumn("he_live", F.filter("he_page.paths", lambda p: (p["group"] == 0)
                                               | F.array_contains(F.col("he_groups"), p["group"])))


def content_paths(rows: DataFrame) -> DataFrame:
    """``rows`` (he_live) with ``he_score``, the fused ratio of each path, and
    ``he_threshold``."""
    rows = rows.withColumn("he_text", _smoothed(F.transform("he_live", lambda p: p["plain"] / p["nodes"])))
    rows = rows.withColumn("he_punct", _smoothed(F.transform("he_live", lambda p: p["punct"] / p["nodes"])))
    # Fused: running text has both length and punctuation in each node, and few links.
    rows = rows.withColumn("he_fused", F.zip_with("he_text", "he_punct", lambda t, p: F.sqrt(t * (p + 0.5))))
    rows = rows.withColumn("he_score", F.zip_with("he_fused", "he_live", lambda s, p: s * p["plain"] / p["chars"]))
    n = F.size("he_score")
    mean = _total(F.col("he_score")) / n
    rows = rows.withColumn("he_mean", F.when(n > 0, mean))
    spread = F.sqrt(_total(F.transform("he_score", lambda s: (s - F.col("he_mean")) * (s - F.col("he_mean")))) / n)
    # One standard deviation, or the best path where the ratios differ less.
    return rows.withColumn("he_threshold", F.when(n > 0, F.least(spread, F.array_max("he_score"))))


def extract(pages: DataFrame, html: str = "html", out: str = "text", threshold: Column | None = None) -> DataFrame:
    """``pages`` with the main text of each page in column ``out``.
    ``threshold`` replaces the one that follows from the page's scores."""
    common.prepare(pages.sparkSession)
    read = F.pandas_udf(_read_batches, f"{BLOCKS}, {PATHS}, {HEADS}")
    rows = pages.select(common.row_struct(pages).alias("he_row"), read(F.col(html)).alias("he_page"))
    rows = content_paths(live_paths(rows))
    if threshold is not None:
        rows = rows.withColumn("he_threshold", threshold)
    scored = F.zip_with("he_live", "he_score", lambda p, s: F.struct(
        p["at"].alias("at"), (s >= F.col("he_threshold")).alias("chosen"),
        ((p["nodes"] > 1) & (p["chars"] - p["plain"] >= LINK_SHARE * p["chars"])).alias("links")))
    rows = rows.withColumn("he_scored", scored)
    rows = rows.withColumn("he_chosen", F.transform(F.filter("he_scored", lambda p: p["chosen"]), lambda p: p["at"]))
    rows = rows.withColumn("he_stay", F.transform(F.filter("he_scored", lambda p: p["chosen"] | ~p["links"]),
                                                  lambda p: p["at"]))
    blocks = F.col("he_blocks")
    rows = rows.withColumn("he_blocks", F.filter("he_page.blocks", lambda b: F.array_contains(F.col("he_stay"),
                                                                                           b["path"])))
    # An article or main region, where one holds text, goes before others.
    rows = rows.withColumn("he_main", F.exists(blocks, lambda b: b["main"]))
    voters = F.filter(blocks, lambda b: F.array_contains(F.col("he_chosen"), b["path"]) & (b["main"] == F.col("he_main")))
    rows = rows.withColumn("he_regions", F.array_distinct(F.transform(voters, lambda b: b["region"])))
    none = F.size("he_regions") == 0
    kept = F.filter(blocks, lambda b: (b["main"] == F.col("he_main"))
                    & (none | F.array_contains(F.col("he_regions"), b["region"])))
    text = F.array_join(F.transform(kept, lambda b: b["text"]), " ")
    rows = rows.select("he_row", F.coalesce(text, F.lit("")).alias("he_out"))
    return rows.select(*common.unpacked(pages, "he_row", {out: F.col("he_out")}))


def digest(pages: DataFrame) -> DataFrame:
    """The contract's columns, one row per page."""
    return extract(pages.select("page_id", "url", "html")).select(
        "page_id", "url", "text", F.char_length("text").cast("long").alias("n_chars"))
