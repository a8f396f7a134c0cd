"""Sections and websites of filings, from one pass over each page.

A page becomes its blocks of text in order, with the ids that stand before each, the links of its
table of contents and its tagged facts; every strategy reads from that and none parses again.
"""

from __future__ import annotations

import re
from collections.abc import Callable, Iterator
from functools import cached_property
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .text import best_website, section_of

_BLOCKS = {"p", "div", "li", "td", "th", "tr", "table", "ul", "ol", "br", "hr", "h1", "h2", "h3", "h4", "h5", "h6", "section", "body", "title"}
_VOID = {"br", "hr", "img", "input", "meta", "link"}
#: Characters that a section of text between two places may have.
MOST_CHARS = 2_000_000


class _Reader(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.blocks: list[tuple[str, bool]] = []  # text, whether it stands in a table
        self.ids: list[tuple[str, int]] = []
        self.links: list[tuple[str, str]] = []
        self.facts: list[tuple[str, str]] = []
        self.parts: list[str] = []
        self.hidden = self.tables = 0
        self.link: tuple[str, list[str]] | None = None
        self.tagged: list[tuple[str, str, list[str]]] = []

    def flush(self) -> None:
        text = re.sub(r"\s+", " ", "".join(self.parts)).strip()
        self.parts = []
        if text:
            self.blocks.append((text, self.tables > 0))

    def handle_starttag(self, tag, attrs):
        if tag in _BLOCKS:
            self.flush()
        values = {k: v or "" for k, v in attrs}
        for k in ("id", "name"):
            if k in values and not (k == "name" and ":" in values[k]):
                self.flush()
                self.ids.append((values[k], len(self.blocks)))
        told = " ".join(values.get(k, "") for k in ("name", "id", "data-ixbrl", "class"))
        if tag not in _VOID and "website" in told.lower() + tag:
            self.tagged.append((tag, f"{tag} {told}", []))
        self.hidden += tag in ("script", "style")
        self.tables += tag == "table"
        if tag == "a" and "href" in values:
            self.link = values["href"], []

    def handle_endtag(self, tag):
        if tag in _BLOCKS:
            self.flush()
        self.hidden -= tag in ("script", "style") and self.hidden > 0
        self.tables -= tag == "table" and self.tables > 0
        if tag == "a" and self.link:
            self.links.append((self.link[0], re.sub(r"\s+", " ", "".join(self.link[1])).strip()))
            self.link = None
        if self.tagged and self.tagged[-1][0] == tag:
            _, name, parts = self.tagged.pop()
            self.facts.append((name, "".join(parts).strip()))

    def handle_data(self, data):
        if not self.hidden:
            self.parts.append(data)
            if self.link:
                self.link[1].append(data)
            for _, _, parts in self.tagged:
                parts.append(data)


class Page:
    """A page's text, ids, links and facts."""

    def __init__(self, html: str | None):
        self.html = html or ""

    @cached_property
    def read(self) -> _Reader:
        r = _Reader()
        r.feed(self.html)
        r.close()
        r.flush()
        return r

    @property
    def blocks(self) -> list[tuple[str, bool]]:
        return self.read.blocks

    @cached_property
    def text(self) -> str:
        return "\n".join(t for t, _ in self.blocks)

    def place_of(self, wanted: str | re.Pattern, after: int = -1) -> int | None:
        """The block at the first id that is, or else holds, ``wanted``, after a block."""
        for same in (True, False):
            for name, at in self.read.ids:
                if at > after and (wanted.search(name) if isinstance(wanted, re.Pattern) else name == wanted if same else bool(wanted) and wanted in name):
                    return at
        return None

    def between(self, start: int, end: int | None, most: int = MOST_CHARS) -> str:
        """The texts from one block to another, each once, one to a line, at most ``most`` characters."""
        out = "\n".join(dict.fromkeys(t for t, _ in self.blocks[start:end]))
        return out[:most]

    def until(self, start: int, stop: re.Pattern) -> str:
        """The texts from a block to the first later one that says the section is over."""
        end = next((i for i in range(start + 1, len(self.blocks)) if stop.search(self.blocks[i][0])), None)
        return self.between(start, end)


def _rx(pattern: str) -> re.Pattern:
    return re.compile(pattern, re.I)


#: Of each section: hrefs of its line in the table of contents, the line's text, ids, ids of what follows, the text of
#: the following line, a heading, what ends it, and the least number of characters.
_RULES = {
    "business": (
        [_rx(r"#.*item.*1.*business"), _rx(r"^#(?:i1|item_?1)$")], _rx(r"^items?\s*1\.?(?:\s*$|[\s.:\-–—]*business)"), [_rx(r"item.*1.*business"), _rx(r"item.*1\b")],
        _rx(r"item.*1[abc]|^i1[abc]$|item.*2\b|^i2$|item.*10\b|^i10$"), _rx(r"^item\s*1a\.?"), _rx(r"^\s*items?\s*1\s*[.:\-–—]?\s*(?:and\s+2\.?\s*)?business\b"),
        _rx(r"^\s*(?:item\s*(?:1a|1b|1c|2|10)\b|risk\s+factors\b|part\s+ii\b)"), 500,
    ),
    "risk_factors": (
        [_rx(r"#.*item_?1a"), _rx(r"^#i1a$")], _rx(r"^item\s*1a\.?"), [_rx(r"item.*1a"), _rx(r"^i1a$")],
        _rx(r"item.*1b|^i1b$|item.*2\b|^i2$"), _rx(r"^item\s*(?:1b|2)\.?"), _rx(r"^\s*item\s*1a\s*[.:\-–—]?\s*(?:risk\s+factors)?"),
        _rx(r"^\s*item\s*(?:1b|2)\b"), 100,
    ),
}


def _by_contents(page: Page, name: str) -> str | None:
    """From where the table of contents points to where its next line does, or to a heading that ends the section."""
    hrefs, line, _, after, following, _, stop, _ = _RULES[name]
    links = [(h, t) for h, t in page.read.links if h.startswith("#")]
    target = next((h for rx in hrefs for h, _ in links if rx.search(h)), None) or next((h for h, t in links if line.search(t)), None)
    start = page.place_of(target.lstrip("#")) if target else None
    if start is None:
        return None
    end = page.place_of(after, start)
    if end is None:
        ends = (page.place_of(h.lstrip("#"), start) for h, t in links if following.search(t))
        end = next((e for e in ends if e is not None), None)
    return page.between(start, end) if end is not None else page.until(start, stop)


def _by_id(page: Page, name: str) -> str | None:
    _, _, ids, after, _, _, stop, _ = _RULES[name]
    start = next((at for rx in ids if (at := page.place_of(rx)) is not None), None)
    if start is None:
        return None
    end = page.place_of(after, start)
    return page.between(start, end) if end is not None else page.until(start, stop)


def _by_heading(page: Page, name: str) -> str | None:
    """From the first heading that stands in no table."""
    _, _, _, _, _, heading, stop, least = _RULES[name]
    for i, (text, in_table) in enumerate(page.blocks):
        if not in_table and heading.search(text) and len(found := page.until(i, stop)) >= least:
            return found
    return None


def _by_text(page: Page, name: str) -> str | None:
    """The longest stretch of the whole text from a heading to what ends it."""
    return section_of(page.text, name)


STRATEGIES: list[tuple[str, Callable[[Page, str], str | None]]] = [("contents", _by_contents), ("id", _by_id), ("heading", _by_heading), ("text", _by_text)]


def tidy(text: str) -> str:
    return re.sub(r"\.{3,}", "...", re.sub(r"\s+", " ", text)).strip()


def find_section(page: Page, name: str) -> tuple[str | None, str | None]:
    """The section and the strategy that found it: the first whose text is long enough.  Its own heading is left out."""
    heading, least = _RULES[name][5], _RULES[name][7]
    for strategy, find in STRATEGIES:
        found = tidy(find(page, name) or "")
        found = tidy(heading.sub("", found, count=1).lstrip(" .:-–—"))
        named = name != "risk_factors" or strategy != "contents" or _rx("risk|factors").search(found)
        if len(found) >= least and named:
            return found, strategy
    return None, None


_XMLNS = re.compile(r'\sxmlns:[a-zA-Z0-9_\-]+="([^"]+)"')
_HOST = re.compile(r"^(?:[a-z][a-z0-9+.\-]*://)?(?:www\.)?([a-z0-9\-]{2,63}(?:\.[a-z0-9\-]{2,63})*\.[a-z]{2,15})(?:[/:?#].*)?$", re.I)
#: Hosts of the formats themselves.
_FORMATS = re.compile(r"(?:^|\.)(?:xbrl\.org|sec\.gov|fasb\.org|w3\.org)$", re.I)


def site_of(url: str | None) -> str | None:
    """The registrable domain of an address, but for those of the formats and registries."""
    m = _HOST.match((url or "").strip())
    if not m or _FORMATS.search(m[1]):
        return None
    labels = m[1].lower().split(".")
    two = len(labels) > 2 and len(labels[-1]) == 2 and labels[-2] in ("co", "com", "org", "net", "ac", "gov")
    return ".".join(labels[-3 if two else -2:])


def find_website(page: Page) -> str | None:
    """The tagged website, else a namespace of the company's own, else the domain that the text names with most weight."""
    for _, value in page.read.facts:
        if site := site_of(value):
            return site
    spaces = [s for u in _XMLNS.findall(page.html[:20_000]) if (s := site_of(u))]
    told = site_of(best_website(page.text))
    return told if told in spaces or not spaces else spaces[0] if told is None else told


PARSERS: dict[str, Callable[[Page], str | None]] = {
    "website": find_website,
    "business": lambda page: find_section(page, "business")[0],
    "risk_factors": lambda page: find_section(page, "risk_factors")[0],
}


def parse_pages(pages: DataFrame, key: str, html: str = "html", parsers: dict[str, Callable[[Page], str | None]] | None = None, keep: list[str] | None = None) -> DataFrame:
    """key, a column for each parser, in their order, and the columns to ``keep``; every page is read once for all parsers.

    A parser that fails gives null for that page and the others go on.
    """
    parsers, keep = parsers or PARSERS, keep or []
    types = {c: pages.schema[c].dataType.simpleString() for c in (key, *keep)}

    def one(parse: Callable[[Page], str | None], page: Page) -> str | None:
        try:
            return parse(page)
        except Exception:  # noqa: BLE001 - one field of one page
            return None

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            read = [Page(h) for h in b.column(1).to_pylist()]
            yield pa.RecordBatch.from_arrays([b.column(0), *(pa.array([one(p, page) for page in read], pa.string()) for p in parsers.values()), *b.columns[2:]], [key, *parsers, *keep])

    ddl = [f"`{key}` {types[key]}", *(f"`{n}` string" for n in parsers), *(f"`{c}` {types[c]}" for c in keep)]
    return pages.select(key, html, *keep).mapInArrow(run, ", ".join(ddl))


def with_library(parsed: DataFrame, library: DataFrame, column: str = "business", path: str = "path") -> DataFrame:
    """``parsed`` with ``library(cik, <column>)`` first and its own value where that has none.

    A row without a cik takes the one that its file's folder is named by; if that is no number, the field is null.
    """
    folder: Column = F.nullif(F.regexp_extract(path, r"/(\d+)/[^/]+$", 1), F.lit(""))
    cik = F.coalesce(F.col("cik").cast("string"), folder)
    lib = library.select(F.lpad(F.col("cik").cast("string"), 10, "0").alias("__cik"), F.col(column).alias("__lib"))
    met = parsed.withColumn("__cik", F.lpad(cik, 10, "0")).join(lib, "__cik", "left")
    value = F.when(F.col("__cik").isNotNull(), F.coalesce("__lib", column))
    return met.select(*(value.alias(c) if c == column else F.col(c) for c in parsed.columns))
