import datetime
import io
import tarfile

from pyspark.sql import functions as F

from ledgerweb.sources import filings, observations


def test_files_and_archives(spark, tmp_path):
    for cik, names in (("1", ("a.html", "b.html", "c.txt")), ("2", ("x.xml",))):
        (tmp_path / cik).mkdir()
        for n in names:
            (tmp_path / cik / n).write_text(n)
    files = filings.filing_files(spark, str(tmp_path))
    assert [r.path.rsplit("/", 1)[-1] for r in files.collect()] == ["a.html", "b.html", "x.xml"]
    assert filings.filing_files(spark, str(tmp_path), 1).count() == 1
    assert {r.cik for r in filings.newest_by_company(files).collect()} == {"1"}

    def archive(name, members):
        with tarfile.open(tmp_path / name, "w") as tar:
            for n, text in members:
                info = tarfile.TarInfo(n)
                info.size = len(text)
                tar.addfile(info, io.BytesIO(text.encode()))

    archive("0000320193-22-000108.tar", [("exhibit99.html", "x" * 50), ("main.html", "main"), ("../evil.html", "e" * 99)])
    archive("0000320193-21-000001.tar", [("r-20210304.html", "only")])
    (tmp_path / "broken.tar").write_text("no archive")
    raw = spark.read.format("binaryFile").option("pathGlobFilter", "*.tar").load(str(tmp_path))
    got = {r.path.rsplit("/", 1)[-1]: (r.member, r.html, r.year, r.members) for r in filings.archive_documents(raw).collect()}
    assert got == {"0000320193-22-000108.tar": ("main.html", "main", 2022, 2), "0000320193-21-000001.tar": ("r-20210304.html", "only", 2021, 1), "broken.tar": (None, None, None, 0)}


def test_choice_of_archives(spark):
    d = datetime.date
    rows = [("1", "b", d(2022, 1, 1), 3), ("1", "a", d(2022, 1, 1), 3), ("1", "c", d(2023, 1, 1), 0), ("2", "z", None, 1)]
    df = spark.createDataFrame(rows, "cik string, path string, filed date, members int")
    assert {(r.cik, r.path) for r in filings.latest_archive(df).collect()} == {("1", "a"), ("2", "z")}
    names = spark.createDataFrame([("batch_7",), ("0000320193-22-000108.tar",), ("0000320193-21-000999.tar",)], "n string")
    assert [r.n[:14] for r in names.orderBy(filings.archive_order(F.col("n"))).collect()] == ["0000320193-21-", "0000320193-22-", "batch_7"]


def test_metadata(spark):
    page = "<!-- filed 2022-10-28 -->\nAccession 0000320193-22-000108 For the fiscal year ended September 24, 2022"
    r = filings.filing_metadata(spark.createDataFrame([(page,), ("none",)], "html string")).collect()
    assert (r[0].accession, r[0].filed, r[0].fiscal_year_end) == ("0000320193-22-000108", datetime.date(2022, 10, 28), datetime.date(2022, 9, 24))
    assert (r[1].accession, r[1].filed, r[1].fiscal_year_end) == (None, None, None)


def test_directory_and_votes(spark):
    rows = spark.createDataFrame([(7, "ab", " A ", 2), (7, "xy", "B", 1)], "cik long, ticker string, name string, n int")
    assert [tuple(r) for r in observations.company_directory(rows, "n").collect()] == [("0000000007", "XY", "B")]
    votes = spark.createDataFrame([(1, "a.com", 0.7, "s"), (1, "b.com", 0.9, "t"), (2, None, 0.0, "s")], "cik int, domain string, confidence double, source string")
    assert [tuple(r) for r in observations.domain_votes(votes).collect()] == [(1, "b.com", "t", 0.9)]
    forms = spark.createDataFrame([(["10-K", "8-K"], ["2020-01-01", "2021-01-01"])], "f array<string>, d array<string>")
    assert forms.select(observations.has_annual_report(F.col("f"), F.col("d"), "2019-01-01", "2020-06-01")).first()[0]
    assert not forms.select(observations.has_annual_report(F.col("f"), F.col("d"), "2020-06-01", "2022-01-01")).first()[0]


def test_landed_metadata_comes_first(spark):
    pages = spark.createDataFrame([(1, "<!-- filed 2022-10-28 --> 0000320193-22-000108"), (2, "<!-- filed 2021-01-02 -->"), (3, "x")], "id int, html string")
    landed = spark.createDataFrame([(1, '{"accessionNumber":"0000000001-23-000001","filingDate":"2023-02-03"}'), (2, "oops"), (3, '{"filing_date":"soon","fiscal_year_end":"2020-12-31T00:00"}')], "id int, body string")
    got = {r.id: (r.accession, str(r.filed), str(r.fiscal_year_end)) for r in filings.with_landed_metadata(filings.filing_metadata(pages), landed, "id").collect()}
    assert got == {1: ("0000000001-23-000001", "2023-02-03", "None"), 2: (None, "2021-01-02", "None"), 3: (None, "None", "2020-12-31")}
