"""Filings on disk: discovery, archives and the choice among them."""

from __future__ import annotations

import io
import re
import tarfile
from collections.abc import Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F

#: Members that are no main document.
SIDE_DOCUMENTS = r"xexx|exhibit|toc|cover|graphic|img"


def filing_files(spark: SparkSession, folder: str, limit: int | None = None, extensions: tuple[str, ...] = ("html", "xml")) -> DataFrame:
    """path, modificationTime, length below a folder, in order of path; contents are not read."""
    files = spark.read.format("binaryFile").option("recursiveFileLookup", True).option("pathGlobFilter", "*.{" + ",".join(extensions) + "}").load(folder)
    out = files.select("path", "modificationTime", "length").orderBy("path")
    return out.limit(limit) if limit else out


def newest_by_company(files: DataFrame) -> DataFrame:
    """cik, path: of each company's folder the newest HTML file."""
    cik = F.regexp_extract("path", r"/([^/]+)/[^/]+\.html?$", 1)
    return files.where(cik != "").groupBy(cik.alias("cik")).agg(F.max_by("path", F.struct("modificationTime", "path")).alias("path"))


def _main_document(content: bytes, name: str) -> tuple[str | None, str | None, int | None, int]:
    """Name and text of an archive's main HTML member, year of its newest member, number of members.

    The largest member that is no side document, or else the largest; members that point
    outside the archive do not count.
    """
    try:
        with tarfile.open(fileobj=io.BytesIO(content)) as tar:
            members = [m for m in tar.getmembers() if m.isfile() and not m.name.startswith("/") and ".." not in m.name.split("/")]
            pages = sorted((m for m in members if re.search(r"\.html?$", m.name, re.I)), key=lambda m: (-m.size, m.name))
            main = next((m for m in pages if not re.search(SIDE_DOCUMENTS, m.name, re.I)), pages[0] if pages else None)
            dates = [d for m in members if (d := re.search(r"((?:19|20)\d{2})(?:0[1-9]|1[0-2])(?:[0-2]\d|3[01])", m.name))]
            short = re.search(r"^\d{10}-?(\d{2})", name)
            year = max(int(d[1]) for d in dates) if dates else 2000 + int(short[1]) if short else None
            return (main.name, tar.extractfile(main).read().decode("utf-8", "replace"), year, len(members)) if main else (None, None, year, len(members))
    except tarfile.TarError:
        return None, None, None, 0


def archive_documents(archives: DataFrame) -> DataFrame:
    """path, member, html, year, members of every archive of a ``binaryFile`` table."""

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [(p, *_main_document(c, p.rsplit("/", 1)[-1])) for p, c in zip(b.column(0).to_pylist(), b.column(1).to_pylist())]
            types = (pa.string(), pa.string(), pa.string(), pa.int32(), pa.int32())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], t) for i, t in enumerate(types)], ["path", "member", "html", "year", "members"])

    return archives.select("path", "content").mapInArrow(read, "path string, member string, html string, year int, members int")


def latest_archive(archives: DataFrame) -> DataFrame:
    """Of each company the archive with the newest filing date; empty ones do not count, undated
    ones are the oldest, and of equal ones the first path wins."""
    order = Window.partitionBy("cik").orderBy(F.desc(F.coalesce("filed", F.to_date(F.lit("1900-01-01")))), F.asc("path"))
    return archives.where("members > 0").withColumn("r", F.row_number().over(order)).where("r = 1").drop("r")


def archive_order(name: Column, modified: Column | None = None) -> Column:
    """Sorts archives by the year and number in their name; batches come last, in order of the time ``modified`` (in seconds)."""
    year = F.regexp_extract(name, r"^\d{10}-?(\d{2})-?\d+", 1)
    number = F.regexp_extract(name, r"^\d{10}-?\d{2}-?(\d+)", 1)
    return F.when(name.startswith("batch_"), F.struct(F.lit(99).alias("year"), (F.lit(0) if modified is None else modified).cast("long").alias("number"))).otherwise(
        F.struct(F.coalesce(F.nullif(year, F.lit("")).cast("int"), F.lit(-1)).alias("year"), F.coalesce(F.nullif(number, F.lit("")).cast("long"), F.lit(0).cast("long")).alias("number"))
    )


def filing_metadata(pages: DataFrame, html: str = "html") -> DataFrame:
    """Adds accession, filed, fiscal_year_end from a filing's head: comments first, then text."""
    head, text = F.substring(html, 1, 5000), F.substring(html, 1, 20000)
    month = r"(January|February|March|April|May|June|July|August|September|October|November|December)"

    def day(source: Column, pattern: str, layout: str) -> Column:
        return F.try_to_timestamp(F.nullif(F.regexp_extract(source, pattern, 1), F.lit("")), F.lit(layout)).cast("date")

    filed = F.coalesce(day(head, r"(?is)<!--[^>]*?filed[^>]*?(\d{4}-\d{2}-\d{2})", "yyyy-MM-dd"), day(text, r"(?i)filed\s+(?:on\s+)?(\d{4}-\d{2}-\d{2})", "yyyy-MM-dd"))
    end = day(text, rf"(?i)fiscal\s+year\s+ended\s+({month}\s+\d{{1,2}},\s+\d{{4}})", "MMMM d, yyyy")
    sane = lambda d: F.when(F.year(d).between(1990, 2100), d)
    return pages.select("*", F.nullif(F.regexp_extract(text, r"(\d{10}-\d{2}-\d{6})", 1), F.lit("")).alias("accession"), sane(filed).alias("filed"), sane(end).alias("fiscal_year_end"))


def with_landed_metadata(pages: DataFrame, landed: DataFrame, key: str, body: str = "body") -> DataFrame:
    """``pages`` as ``filing_metadata`` gives them, with what ``landed(key, body)``, the filings' JSON files, says first.

    A body that is no JSON, or a date that is none, leaves the page's own values.
    """
    fields = "accessionNumber string, accession_number string, filingDate string, filing_date string, fiscalYearEnd string, fiscal_year_end string"
    told = landed.select(key, F.from_json(body, fields).alias("m")).select(
        key, F.coalesce("m.accessionNumber", "m.accession_number").alias("__accession"),
        *(F.try_to_timestamp(F.substring(F.coalesce(f"m.{a}", f"m.{b}"), 1, 10), F.lit("yyyy-MM-dd")).cast("date").alias(f"__{b}") for a, b in (("filingDate", "filing_date"), ("fiscalYearEnd", "fiscal_year_end"))),
    )
    first = {"accession": F.coalesce("__accession", "accession"), "filed": F.coalesce("__filing_date", "filed"), "fiscal_year_end": F.coalesce("__fiscal_year_end", "fiscal_year_end")}
    return pages.join(told, key, "left").select(*(first[c].alias(c) if c in first else F.col(c) for c in pages.columns))
