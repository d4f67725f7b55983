"""Main text of web pages, with site templates removed.

A page is read into elements. Every block element outside the article is hashed with all it holds, unless it holds an
article or ``main`` itself. For each subtree of a host Spark counts the different texts that pages have besides it, so
copies of a page count once. Subtrees with ``MANY_PAGES`` such texts, or on a smaller host with as many as ``SHARE`` of
its different pages and ``LEAST_PAGES``, are template and are deleted from all the host's pages. Page furniture that
changes from page to page (adverts, footers with their own text) can't recur, so elements that say what they are by tag,
role, class or id go as well; outside articles a word of a class or id says so, inside only a whole one does, and ids of
headings, which are often made from their text, say nothing. Formulas in an article are its text. What stays is the text of the ``article`` elements, else of ``main``, else of the body.
Repeated passages inside an article are its text and stay.

A page is joined with those of its own subtrees that are template, never with the whole list of its host. Spark broadcasts
these short lists only while their measured size is small. Pages that differ in a few words are different pages.

Defined cases: null or empty html gives an empty text. A page whose url has no host takes part under the empty host.
Unclosed elements end with their parent, unclosed comments, scripts and tags with the page. ``<br>`` is white space.
Repeated rows stay as often as given, and count as one page. An empty table gives no rows. Other columns are ignored.
"""

from __future__ import annotations

import re
from collections.abc import Iterator
from html import unescape

import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from docloom.llm.common import text_key, written
from docloom.llm.url_rules import url_host

#: Part of a host's different pages on which a subtree recurs to be template, pages at least, and pages that do on any host.
SHARE, LEAST_PAGES, MANY_PAGES = 0.5, 5, 100

#: HTML's own element kinds.
VOID = set("area base br col embed hr img input link meta param source track wbr".split())
RAW = set("script style textarea title noscript iframe xmp noembed noframes".split())
BLOCK = set(("address article aside blockquote body caption center dd details dialog dir div dl dt fieldset figcaption figure footer form h1 h2 h3 h4 h5 h6 head header hgroup "
             "hr html legend li main menu nav ol optgroup option p pre search section summary table tbody td tfoot th thead tr ul").split())
CLOSES_P = BLOCK - set("body caption dd dt head html legend li option optgroup summary tbody td tfoot th thead tr".split())
SIBLINGS = {"li": {"li"}, "dt": {"dt", "dd"}, "dd": {"dt", "dd"}, "tr": {"tr", "td", "th"}, "td": {"td", "th"}, "th": {"td", "th"}, "option": {"option"}}
SIBLING_SCOPE = {"li": {"ul", "ol", "menu"}, "dt": {"dl"}, "dd": {"dl"}, "tr": {"table"}, "td": {"tr", "table"}, "th": {"tr", "table"}, "option": {"select", "datalist"}}
#: Elements that never hold article text; ``header`` does inside an article, and so do those of ``SHOWN``.
FURNITURE = set("nav footer aside form menu dialog button select datalist template svg math object canvas audio video map search head annotation annotation-xml".split())
SHOWN = set("math object".split())
HEADINGS = set("h1 h2 h3 h4 h5 h6".split())
ROLES = set("navigation banner contentinfo complementary search form dialog alertdialog alert menu menubar toolbar".split())
#: Words of class names and ids that say an element isn't article text.
NAMES = set(("ad ads advert adverts advertisement advertising sponsor sponsored promo promotion banner sidebar nav navbar navigation menu breadcrumb breadcrumbs footer masthead cookie "
             "cookies consent gdpr notice popup modal overlay newsletter subscribe signup comment comments disqus replies respond share sharing social related recommended widget toolbar "
             "pagination pager login").split())

_TOKEN = re.compile(r"""<!--.*?(?:-->|\Z)|<[!?][^>]*(?:>|\Z)|<(/?)([a-zA-Z][^\s/>]*)((?:"[^"]*"|'[^']*'|[^>"'])*+>|[^>]*(?:>|\Z))""", re.S)
_ATTRIBUTE = re.compile(r"""([^\s=/>"']+)(?:\s*=\s*("[^"]*"|'[^']*'|[^\s>]+))?""")
_NAME_PART = re.compile(r"[A-Z]+(?![a-z])|[A-Z]?[a-z]+|\d+")
_CLOSE = {tag: re.compile(rf"</{tag}(?=[\s/>]|\Z)[^>]*(?:>|\Z)", re.I) for tag in RAW}
#: 64 bits fit Spark's long as signed numbers.
_TOP, _WRAP = 1 << 63, 1 << 64


def _names(value: str) -> list[str]:
    return [p.lower() for p in _NAME_PART.findall(value)]


def _only_names(value: str) -> bool:
    """Whether a class or id consists of furniture names, with or without numbers."""
    parts = [p for p in _names(value) if not p.isdigit()]
    return bool(parts) and NAMES.issuperset(parts) and not re.search(r"[^\W\d_]", _NAME_PART.sub("", value))


def is_furniture(tag: str, attributes: str, in_article: bool) -> bool:
    """Whether an element says that it isn't article text."""
    if tag in FURNITURE and not (in_article and tag in SHOWN) or tag == "header" and not in_article:
        return True
    if "=" not in attributes and "hidden" not in attributes:
        return False
    for m in _ATTRIBUTE.finditer(attributes):
        name, value = m[1].lower(), unescape((m[2] or "").strip("\"'"))
        if name in ("class", "id"):
            if tag in ("html", "body", "main") or name == "id" and tag in HEADINGS:
                continue
            if in_article or tag == "article":
                if name == "id" and (tag not in BLOCK or tag == "p"):
                    continue
                if any(_only_names(x) for x in value.split()):
                    return True
            elif not {"header", *NAMES}.isdisjoint(_names(value)):
                return True
        elif name == "role" and value.lower() in ROLES or name == "hidden" and tag not in ("html", "body") or name == "aria-hidden" and value == "true" and not in_article:
            return True
        elif name == "style" and re.search(r"display\s*:\s*none", value, re.I):
            return True
    return False


def _signed(h: int) -> int:
    h %= _WRAP
    return h - _WRAP if h >= _TOP else h


class Page:
    """One pass over a page. ``subtrees`` has (hash, first block, last block) of block elements outside articles that hold none;
    ``blocks`` has (text, in an article, in main)."""

    def __init__(self, html: str, hashes: bool = True):
        self.html, self.hashes = html, hashes
        self.subtrees: list[tuple[int, int, int]] = []
        self.blocks: list[tuple[str, bool, bool]] = []
        # Open elements: tag, start, first block, furniture, block element, articles and mains begun before.
        self.open: list[tuple[str, int, int, bool, bool, int]] = []
        self.held: list[str] = []
        self.dropped = self.articles = self.mains = self.begun = 0
        self.has_article = self.has_main = False
        self._read()

    def _flush(self) -> None:
        if self.held:
            text = " ".join("".join(self.held).split())
            self.held = []
            if text:
                self.blocks.append((text, self.articles > 0, self.mains > 0))

    def _pop(self, depth: int, at: int) -> None:
        """Close elements until ``depth`` are open."""
        while len(self.open) > depth:
            tag, start, first, furniture, block, begun = self.open.pop()
            if block:
                self._flush()
                if self.hashes and not self.articles and begun == self.begun and first < len(self.blocks) and tag not in ("html", "body", "head", "main"):
                    h = xxhash.xxh3_64_intdigest(" ".join(self.html[start:at].split()))
                    self.subtrees.append((_signed(h), first, len(self.blocks)))
            self.dropped -= furniture
            self.articles -= tag == "article"
            self.mains -= tag == "main"

    def _start(self, tag: str, attributes: str, at: int) -> None:
        if tag in CLOSES_P:
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] == "p":
                    self._pop(i, at)
                if i >= len(self.open) or self.open[i][4]:
                    break
        elif tag in SIBLINGS:
            for i in range(len(self.open) - 1, -1, -1):
                if self.open[i][0] in SIBLING_SCOPE[tag]:
                    break
                if self.open[i][0] in SIBLINGS[tag]:
                    self._pop(i, at)
                    if tag != "tr":
                        break
        if tag in BLOCK:
            self._flush()
        if tag in VOID:
            if tag == "br" and not self.dropped:
                self.held.append(" ")
            return
        if attributes.endswith("/") and tag not in BLOCK:
            return
        furniture = is_furniture(tag, attributes, self.articles > 0)
        self.dropped += furniture
        if tag == "article":
            self.articles += 1
            self.has_article |= not self.dropped
        elif tag == "main":
            self.mains += 1
            self.has_main |= not self.dropped
        self.open.append((tag, at, len(self.blocks), furniture, tag in BLOCK, self.begun))
        self.begun += tag in ("article", "main") and not self.dropped

    def _text(self, first: int, last: int) -> None:
        if not self.dropped and first < last:
            text = self.html[first:last]
            self.held.append(unescape(text) if "&" in text else text)

    def _read(self) -> None:
        at, html = 0, self.html
        token = _TOKEN.search(html)
        while token:
            start, end = token.span()
            self._text(at, start)
            at = end
            tag = token[2]
            if tag:
                tag = tag.lower()
                if token[1]:
                    for i in range(len(self.open) - 1, -1, -1):
                        if self.open[i][0] == tag:
                            self._pop(i, end)
                            break
                    else:
                        if tag in BLOCK:
                            self._flush()
                elif not token[3].endswith(">"):
                    at = len(html)  # the page ends inside a tag
                elif tag in RAW:
                    close = _CLOSE[tag].search(html, end)
                    at = close.end() if close else len(html)
                else:
                    self._start(tag, token[3][:-1], start)
            token = _TOKEN.search(html, at)
        self._text(at, len(html))
        self._pop(0, len(html))
        self._flush()

    def besides(self) -> tuple[int, dict[int, int]]:
        """A digest of the page's blocks, and for each subtree hash a digest of the blocks outside such subtrees."""
        sums = [0]
        for text, _, _ in self.blocks:
            sums.append(sums[-1] + xxhash.xxh3_64_intdigest(text))
        rest: dict[int, int] = {}
        for h, first, last in self.subtrees:
            rest[h] = rest.get(h, sums[-1]) - sums[last] + sums[first]
        return _signed(sums[-1]), {h: _signed(r) for h, r in rest.items()}

    def text(self, template: set[int] | None = None) -> str:
        """The blocks left without template subtrees, joined by line ends."""
        keep = [True] * len(self.blocks)
        for h, first, last in self.subtrees if template else ():
            if h in template:
                keep[first:last] = [False] * (last - first)
        if self.has_article:
            keep = [k and b[1] for k, b in zip(keep, self.blocks)]
        elif self.has_main:
            keep = [k and b[2] for k, b in zip(keep, self.blocks)]
        return "\n".join(b[0] for k, b in zip(keep, self.blocks) if k)


def page_templates(pages: DataFrame, share: float = SHARE, least_pages: int = LEAST_PAGES, many_pages: int = MANY_PAGES) -> DataFrame:
    """host, page (hash of the html) and hashes: the subtrees of a page that recur across its host's pages."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            at, hashes, rests = [], [], []
            for i, html in enumerate(batch.column(2)):
                whole, rest = Page(html.as_py()).besides()
                at += [i] * (1 + len(rest))
                hashes += [None, *rest]
                rests += [whole, *rest.values()]
            yield pa.RecordBatch.from_arrays([batch.column(0).take(pa.array(at, pa.int64())), batch.column(1).take(pa.array(at, pa.int64())), pa.array(hashes, pa.int64()), pa.array(rests, pa.int64())],
                                             names=["host", "page", "hash", "rest"])

    # A row without a hash stands for the whole page.
    rows = pages.select(url_host().alias("host"), text_key("html").alias("page"), F.coalesce("html", F.lit("")).alias("html"))
    found = written(rows.mapInArrow(run, "host string, page long, hash long, rest long"), "subtrees")
    each = found.select("host", "hash", "rest").distinct()
    counted = each.filter("hash is null").groupBy("host").agg(F.count("*").alias("pages")).filter(F.col("pages") >= least_pages)
    often = each.filter("hash is not null").groupBy("host", "hash").agg(F.count("*").alias("times")).filter(F.col("times") >= least_pages).join(counted, "host")
    often = written(often.filter(F.col("times") >= F.least(F.col("pages") * share, F.lit(float(many_pages)))).select("host", "hash"), "host-templates")
    return written(found.join(often, ["host", "hash"]).groupBy("host", "page").agg(F.collect_set("hash").alias("hashes")), "page-templates")


def main_texts(pages: DataFrame, share: float = SHARE, least_pages: int = LEAST_PAGES, many_pages: int = MANY_PAGES) -> DataFrame:
    """page_id, url, text and n_chars of every row."""
    templates = page_templates(pages, share, least_pages, many_pages)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for batch in batches:
            texts = []
            for html, hashes in zip(batch.column(2), batch.column(3)):
                template = set(hashes.as_py() or ())
                texts.append(Page(html.as_py(), hashes=bool(template)).text(template))
            yield pa.RecordBatch.from_arrays([batch.column(0), batch.column(1), pa.array(texts, pa.string()), pa.array([len(t) for t in texts], pa.int64())],
                                             names=["page_id", "url", "text", "n_chars"])

    rows = pages.select("page_id", "url", F.coalesce("html", F.lit("")).alias("html"), url_host().alias("host"), text_key("html").alias("page")).join(templates, ["host", "page"], "left")
    return rows.select("page_id", "url", "html", "hashes").mapInArrow(run, f"page_id {pages.schema['page_id'].dataType.simpleString()}, url string, text string, n_chars long")
