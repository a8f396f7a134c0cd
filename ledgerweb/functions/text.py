"""Text functions: columns where a column can say it, one parser pass where it can't."""

from __future__ import annotations

import re
import unicodedata
from collections.abc import Callable, Iterator
from html.parser import HTMLParser

import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from . import fixed_values as V

CHUNK, OVERLAP, LEAST_CHUNK = 1000, 200, 100
CAPITALIZED = r"\b([A-Z][a-zA-Z&.\-]*(?:\s+[A-Z][a-zA-Z&.\-]*){0,3})\b"
TICKER = r"\b([A-Z]{2,5})\b"
QUOTED = r'"([^"]{2,50})"'
#: Public suffixes of two labels; all others count as one label.
DOUBLE_SUFFIXES = ["co.uk", "org.uk", "ac.uk", "gov.uk", "com.au", "net.au", "org.au", "co.jp", "co.kr", "co.in", "com.br", "com.cn", "com.mx", "co.za", "com.sg", "com.hk", "co.nz", "com.tr", "com.tw", "co.il"]
#: Every Latin letter that is one letter and marks (compatibility forms too), and that letter.
_ACCENTS = tuple(map("".join, zip(*(
    (c, base) for c in map(chr, [*range(0xAA, 0x250), *range(0x1E00, 0x1F00), *range(0xFF21, 0xFF5B)])
    if len(base := "".join(x for x in unicodedata.normalize("NFKD", c) if not unicodedata.combining(x))) == 1 and base != c and base.isascii() and base.isalnum()
))))


def strip(text: Column) -> Column:
    """Without white space at both ends, as Unicode has it."""
    return F.regexp_replace(text, r"(?U)^\s+|\s+$", "")


def text_hash(text: Column) -> Column:
    """sha256 of the stripped text; the empty text for nothing."""
    s = strip(text)
    return F.when(text.isNull() | (s == ""), "").otherwise(F.sha2(s, 256))


def token_estimate(text: Column) -> Column:
    return F.floor(F.length(text) / 4).cast("long")


def sentences(text: Column) -> Column:
    return F.split(text, r"(?<=[.!?])\s+")


def relationship_sentences(df: DataFrame, keywords: list[str], text: str = "text") -> DataFrame:
    """One row for each sentence that holds a keyword, with its place in the text."""
    out = df.select("*", F.posexplode(sentences(F.col(text))).alias("place", "sentence"))
    low = F.lower("sentence")
    return out.where(F.array_contains(F.array(*(low.contains(k) for k in keywords)), True))


def containing_sentence(text: Column, position: Column, most: int = 500) -> Column:
    """The sentence around a character of a text (from 0), stripped, its first ``most`` characters."""
    head, tail = F.substring(text, F.lit(1), position), F.substring(text, position + 1, F.length(text))
    before = F.regexp_extract(head, r"(?s)^.*[.!?]\s+(.*)$", 1)
    before = F.when(head.rlike(r"(?s)[.!?]\s+"), before).otherwise(head)
    after = F.regexp_extract(tail, r"(?s)^(.*?[.!?]\s+|.*$)", 1)
    return F.substring(strip(F.concat(before, after)), 1, most)


def truncate_tokens(text: Column, most: int) -> Column:
    """The beginning of a text that is estimated to have at most ``most`` tokens, at 3.5 characters each if it is too long."""
    return F.when(token_estimate(text) <= most, text).otherwise(F.substring(text, 1, int(most * 3.5)))


def char_chunks(text: Column, size: int = CHUNK, overlap: int = OVERLAP, least: int = LEAST_CHUNK) -> Column:
    """Overlapping windows of a text, stripped; short ones go, but a short text stays whole.

    Windows start every ``size - overlap`` characters up to the first that reaches the end, and
    a last one covers the final ``overlap`` characters if it starts later.
    """
    n, step = F.length(text), size - overlap
    last = F.greatest(F.lit(0), F.ceil((n - size) / step)).cast("int")
    starts = F.transform(F.sequence(F.lit(0), last), lambda i: i * step)
    starts = F.when(n - overlap > last * step, F.concat(starts, F.array((n - overlap).cast("int")))).otherwise(starts)
    pieces = F.transform(starts, lambda s: strip(F.substring(text, s + 1, F.lit(size))))
    return F.when(n < least, F.array(text)).otherwise(F.filter(pieces, lambda p: F.length(p) >= least))


def token_windows(tokens: Column, size: int = 7000, overlap: int = 200) -> Column:
    """Windows over an array of tokens, the last one as long as what is left."""
    n, step = F.size(tokens), size - overlap
    count = F.when(n <= size, 1).otherwise(F.ceil((n - size) / step).cast("int") + 1)
    return F.transform(F.sequence(F.lit(0), count - 1), lambda i: F.slice(tokens, i * step + 1, F.lit(size)))


def industry_code(code: Column, digits: int) -> Column:
    """The digits of a code, cut or filled with zeros on the left; null under two digits."""
    d = F.regexp_replace(code.cast("string"), "[^0-9]", "")
    return F.when(F.length(d) >= 2, F.lpad(F.substring(d, 1, digits), digits, "0"))


def host(url: Column) -> Column:
    """Lower-case host without scheme, ``www.``, port and path."""
    h = F.regexp_replace(F.lower(F.trim(url)), r"^[a-z][a-z0-9+.\-]*://", "")
    return F.regexp_replace(F.regexp_replace(h, r"[/?#:].*$", ""), r"^www\.", "")


def root_domain(url: Column) -> Column:
    """The registrable domain: the label before the public suffix, and the suffix."""
    labels = F.split(host(url), r"\.")
    n = F.size(labels)
    two = F.array_join(F.slice(labels, F.greatest(n - 1, F.lit(1)), F.lit(2)), ".")
    three = F.array_join(F.slice(labels, F.greatest(n - 2, F.lit(1)), F.lit(3)), ".")
    return F.when(n < 2, None).when(two.isin(*DOUBLE_SUFFIXES) & (n > 2), three).otherwise(two)


def valid_domain(domain: Column) -> Column:
    """A label of two or more characters and a suffix of 2 to 15 letters."""
    return F.coalesce(domain.rlike(r"^(?!-)[a-z0-9\-]{2,63}(?<!-)(\.[a-z]{2,15}){1,2}$"), F.lit(False))


def filing_date(path: Column) -> Column:
    """The date a filing's name tells, by the first rule that gives one."""
    def day(pattern: str, layout: str) -> Column:
        return F.try_to_timestamp(F.nullif(F.regexp_extract(path, pattern, 1), F.lit("")), F.lit(layout)).cast("date")

    def sane(d: Column) -> Column:
        return F.when(F.year(d).between(1990, 2100), d)

    year = F.nullif(F.regexp_extract(path, r"\d{10}[-_]?(\d{2})[-_]?\d{6}", 1), F.lit(""))
    return F.coalesce(
        sane(day(r"[a-z]+-(\d{8})\.htm", "yyyyMMdd")),
        sane(day(r"\d{10}(\d{8})(?!\d)", "yyyyMMdd")),
        F.to_date(F.concat(F.lit("20"), year, F.lit("-01-01"))),
        sane(day(r"(?:^|[^\d])((?:19|20)\d{6})(?!\d)", "yyyyMMdd")),
        sane(day(r"(\d{4}-\d{2}-\d{2})", "yyyy-MM-dd")),
    )


def accession_number(text: Column) -> Column:
    return F.nullif(F.regexp_extract(text, r"(\d{10}-\d{2}-\d{6})", 1), F.lit(""))


def candidates(df: DataFrame, text: str = "text", quoted: bool = False) -> DataFrame:
    """place, candidate, pattern: names and tickers of a text, the first of each spelling."""
    found = [("capitalized", CAPITALIZED), ("ticker", TICKER)] + [("quoted", QUOTED)] * quoted

    def tagged(rank: int, name: str, pattern: str) -> Column:
        hits = F.regexp_extract_all(F.col(text), F.lit(pattern), 1)
        return F.transform(hits, lambda c, i: F.struct(F.lit(rank).alias("rank"), i.alias("place"), c.alias("candidate"), F.lit(name).alias("pattern")))

    each = [tagged(rank, name, p) for rank, (name, p) in enumerate(found)]
    keep = F.filter(F.flatten(F.array(*each)), lambda c: (F.length(c["candidate"]) >= 2) & ((c["pattern"] != "quoted") | c["candidate"].rlike("[A-Z]")))
    # of one spelling the first: sorted by spelling, those that differ from the one before
    spelt = F.array_sort(F.transform(keep, lambda c: F.struct(F.lower(c["candidate"]).alias("low"), c.alias("c"))))
    out = df.select("*", spelt.alias("__s"))
    first = F.filter("__s", lambda x, i: (i == 0) | (x["low"] != F.get("__s", i - 1)["low"]))
    return out.select("*", F.explode(first).alias("__c")).select(*(F.col(f"`{c}`") for c in df.columns), "__c.c.rank", "__c.c.place", "__c.c.candidate", "__c.c.pattern")


def lookup_name(name: Column) -> Column:
    """A company's name as it is looked up: lower, without endings and edge punctuation."""
    endings = F.array(*(F.lit(s) for s in V.NAME_SUFFIXES))
    out = F.aggregate(endings, F.lower(F.trim(name)), lambda n, s: F.when(n.endswith(s), F.substring(n, F.lit(1), F.length(n) - F.length(s))).otherwise(n))
    return F.trim(F.regexp_replace(out, r"^[\s,.\-]+|[\s,.\-]+$", ""))


def folded_name(name: Column, drop_suffixes: bool = True) -> Column:
    """A company's name as it is compared: no accents, punctuation, suffixes and small words."""
    words = F.split(F.trim(F.regexp_replace(F.translate(F.lower(name), *_ACCENTS), r"[^\w\s]+|_", " ")), r"\s+")
    drop = [*V.NOISE_WORDS, *(V.CORPORATE_SUFFIXES if drop_suffixes else [])]
    return F.array_join(F.filter(words, lambda w: ~w.isin(*drop) & (w != "")), " ")


def _with(value: Column, f: Callable[[Column], Column]) -> Column:
    """``f`` of a value that is worked out once, however often ``f`` names it."""
    return F.get(F.transform(F.array(value), f), F.lit(0))


def char_ngrams(name: Column, low: int = 2, high: int = 5) -> Column:
    """Distinct character n-grams of the name without spaces between stars, and its starred words."""
    def grams(compact: Column, n: int) -> Column:
        return F.when(F.length(compact) >= n, F.transform(F.sequence(F.lit(1), F.length(compact) - (n - 1)), lambda i: F.substring(compact, i, F.lit(n)))).otherwise(F.array().cast("array<string>"))

    def every(folded: Column) -> Column:
        words = F.transform(F.filter(F.split(folded, " "), lambda w: F.length(w) >= 2), lambda w: F.concat(F.lit("*"), w, F.lit("*")))
        compact = F.concat(F.lit("*"), F.replace(folded, F.lit(" "), F.lit("")), F.lit("*"))
        of = _with(compact, lambda c: F.flatten(F.array(*(grams(c, n) for n in range(low, high + 1)))))
        return F.when(folded == "", F.array().cast("array<string>")).otherwise(F.array_distinct(F.concat(of, words)))

    return _with(folded_name(name), every)


def ngram_similarity(a: Column, b: Column) -> Column:
    """Jaccard of two sets of n-grams; 0 if one is empty."""
    def jaccard(s: Column) -> Column:
        x, y = s["x"], s["y"]
        return F.when((F.size(x) == 0) | (F.size(y) == 0), 0.0).otherwise(F.size(F.array_intersect(x, y)) / F.size(F.array_union(x, y)))

    return _with(F.struct(a.alias("x"), b.alias("y")), jaccard)


class _Text(HTMLParser):
    def __init__(self):
        super().__init__(convert_charrefs=True)
        self.parts, self.hidden = [], 0

    def handle_starttag(self, tag, attrs):
        self.hidden += tag in ("script", "style")

    def handle_endtag(self, tag):
        if tag in ("script", "style") and self.hidden:
            self.hidden -= 1

    def handle_data(self, data):
        if not self.hidden and data.strip():
            self.parts.extend(x.strip() for x in data.splitlines() if x.strip())


def visible_text(html: str | None, least: int = LEAST_CHUNK) -> str | None:
    """Text nodes one to a line, without scripts and styles; None under ``least`` characters."""
    if not html:
        return None
    p = _Text()
    p.feed(html)
    p.close()
    out = "\n".join(p.parts)
    return out if len(out) >= least else None


def html_text(df: DataFrame, key: str, html: str = "html") -> DataFrame:
    """key, text of every page, parsed once."""
    kind = df.schema[key].dataType.simpleString()

    def parse(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array([visible_text(x) for x in b.column(1).to_pylist()], pa.string())], [key, "text"])

    return df.select(key, html).mapInArrow(parse, f"`{key}` {kind}, text string")


#: Where a section starts and what ends it, on visible text; the longest match counts.
SECTIONS = {
    "business": (r"(?im)^\s*item\s*1\s*[.:\-]?\s*business\b", r"(?im)^\s*(?:item\s*(?:1a|1b|1c|2|10)\b|risk\s+factors|part\s+ii\b)", 500),
    "risk_factors": (r"(?im)^\s*item\s*1a\s*[.:\-]?\s*risk\s+factors\b", r"(?im)^\s*item\s*(?:1b|2)\b", 100),
}


def section(text: Column, name: str) -> Column:
    """A section of a filing's visible text: its longest stretch from a heading to the next stop."""
    start, stop, least = SECTIONS[name]
    start, stop = start.removeprefix("(?im)"), stop.removeprefix("(?im)")
    found = F.regexp_extract_all(text, F.lit(rf"(?ims){start}(.*?)(?={stop}|\z)"), 1)
    longest = F.aggregate(found, F.lit(""), lambda best, x: F.when(F.length(x) > F.length(best), x).otherwise(best))
    tidy = F.regexp_replace(F.regexp_replace(strip(longest), r"\s+", " "), r"\.{3,}", "...")
    return F.when(F.length(tidy) >= least, tidy)


_SITE = re.compile(r"\b(?:www\.)?([a-z0-9\-]{2,63}(?:\.[a-z0-9\-]{2,63})*\.(?:com|net|org|io|co|ai))\b", re.I)
_NEAR = re.compile(r"website|internet|web\s+site|www", re.I)


def best_website(text: str | None, around: int = 80) -> str | None:
    """The domain that a text names with most weight, the first of equal ones.

    Each time counts 1, and 10 more with a telling word within ``around`` characters; .com has 2 more.
    """
    score: dict[str, int] = {}
    for m in _SITE.finditer(text or ""):
        domain = ".".join(m[1].lower().split(".")[-2:])
        near = text[max(0, m.start() - around) : m.start()] + text[m.start() : m.start(1)] + text[m.end() : m.end() + around]
        score[domain] = score.get(domain, 2 * domain.endswith(".com")) + 1 + 10 * bool(_NEAR.search(near))
    return max(score, key=score.get) if score else None


def section_of(text: str | None, name: str) -> str | None:
    """As ``section``, for one text."""
    if not text:
        return None
    start, stop, least = SECTIONS[name]
    stops = [m.start() for m in re.finditer(stop, text)]
    best = ""
    for m in re.finditer(start, text):
        end = next((x for x in stops if x >= m.end()), len(text))
        best = max(best, text[m.end() : end], key=len)
    tidy = re.sub(r"\.{3,}", "...", re.sub(r"\s+", " ", best.strip()))
    return tidy if len(tidy) >= least else None
