import pytest
from pyspark.sql import functions as F

from ledgerweb.functions import text


def one(spark, value, column):
    return spark.createDataFrame([(value,)], "v string").select(column(F.col("v")).alias("r")).first().r


@pytest.mark.parametrize("name, folded", [
    ("APPLE", "apple"), ("Apple Inc.", "apple"), ("Microsoft Corporation", "microsoft"), ("Alphabet Holdings LLC", "alphabet"),
    ("Toyota Motor Corp", "toyota motor"), ("Johnson & Johnson", "johnson johnson"), ("AT&T Inc.", "at t"), ("3M Company", "3m"),
    ("Nestlé", "nestle"), ("Société Générale", "societe generale"), ("", ""), ("   ", ""),
])
def test_folded_name(spark, name, folded):
    assert one(spark, name, text.folded_name) == folded


@pytest.mark.parametrize("name, key", [("Intel Corporation", "intel"), ("Amazon.com, Inc.", "amazon.com"), ("Foo Holdings Ltd", "foo"), ("Bar Group Inc", "bar group")])
def test_lookup_name(spark, name, key):
    assert one(spark, name, text.lookup_name) == key


def chunks_by_hand(s, size=1000, overlap=200, least=100):
    if len(s) < least:
        return [s]
    out, start = [], 0
    while True:
        out.append(s[start : start + size].strip())
        if start + size >= len(s):
            break
        start += size - overlap
    if len(s) - overlap > start:
        out.append(s[len(s) - overlap :].strip())
    return [x for x in out if len(x) >= least]


@pytest.mark.parametrize("n", [0, 50, 99, 100, 150, 999, 1000, 1001, 1100, 1800, 1801, 2600, 5003])
def test_char_chunks(spark, n):
    s = "".join(chr(97 + i * 7 % 26) for i in range(n))
    assert one(spark, s, text.char_chunks) == chunks_by_hand(s)


def test_token_windows(spark):
    df = spark.createDataFrame([(list(range(n)),) for n in (5, 10, 11, 27)], "t array<int>")
    got = [r.w for r in df.select(text.token_windows(F.col("t"), 10, 2).alias("w")).collect()]
    assert got[0] == [list(range(5))] and got[1] == [list(range(10))]
    assert got[2] == [list(range(10)), [8, 9, 10]]
    assert [w[0] for w in got[3]] == [0, 8, 16, 24] and got[3][-1][-1] == 26


@pytest.mark.parametrize("path, day", [
    ("x/aapl-20230930.htm", "2023-09-30"), ("0000320193_22_000108.html", "2022-01-01"), ("f_20210304_x.html", "2021-03-04"), ("f/2020-05-06/a.xml", "2020-05-06"), ("none.html", None),
])
def test_filing_date(spark, path, day):
    got = one(spark, path, text.filing_date)
    assert (str(got) if got else None) == day


@pytest.mark.parametrize("url, domain", [("https://www.shop.example.co.uk/x?y#z", "example.co.uk"), ("HTTP://Example.COM:80/", "example.com"), ("a.b.example.com", "example.com"), ("localhost", None)])
def test_root_domain(spark, url, domain):
    assert one(spark, url, text.root_domain) == domain


def test_small_functions(spark):
    assert one(spark, "   x\t", text.strip) == "x"
    assert one(spark, "  ", text.text_hash) == ""
    assert one(spark, "12-3", lambda c: text.industry_code(c, 4)) == "0123"
    assert one(spark, "1", lambda c: text.industry_code(c, 4)) is None
    assert one(spark, "see 0000320193-22-000108.", text.accession_number) == "0000320193-22-000108"
    assert text.best_website("See rival.org. Visit our website at www.acme.com or rival.org") == "rival.org"
    assert text.best_website("rival.org, " + "x" * 100 + " our website is www.shop.acme.com") == "acme.com"
    assert text.best_website("none") is None and text.best_website(None) is None


def test_sections(spark):
    body = "We make things. " * 40
    page = f"Item 1. Business\n{body}\nItem 1A. Risk Factors\n{'It may rain. ' * 20}\nItem 2. Properties"
    assert one(spark, page, lambda c: text.section(c, "business")) == body.strip()
    assert one(spark, page, lambda c: text.section(c, "risk_factors")).startswith("It may rain.")
    assert one(spark, "Item 1. Business\nshort\nItem 2", lambda c: text.section(c, "business")) is None
    assert text.section_of(page, "business") == body.strip() and text.section_of("Item 1. Business\nshort", "business") is None


def test_visible_text():
    assert text.visible_text("<p>a &amp; b</p><script>no</script><style>x</style><div>" + "c" * 100) == "a & b\n" + "c" * 100
    assert text.visible_text("<p>short</p>") is None and text.visible_text(None) is None


def test_ngrams(spark):
    df = spark.createDataFrame([("Apple Inc", "Apple"), ("Apple", "Orange"), ("", "x")], "a string, b string")
    got = [r.s for r in df.select(text.ngram_similarity(text.char_ngrams(F.col("a")), text.char_ngrams(F.col("b"))).alias("s")).collect()]
    assert got[0] == 1.0 and 0 <= got[1] < 0.3 and got[2] == 0.0


def test_candidates_keep_the_first_spelling(spark):
    df = spark.createDataFrame([("We met IBM and Intel Corp. INTEL CORP is big; ibm too.",)], "text string")
    rows = [(r.pattern, r.candidate) for r in text.candidates(df).collect()]
    assert ("capitalized", "IBM") in rows and ("ticker", "IBM") not in rows
    assert len({c.lower() for _, c in rows}) == len(rows)


def test_grams_fold_a_name_once(spark):
    """Not again for every gram: the folding stands in the expression once, and scores name each set of grams once."""
    df = spark.createDataFrame([("Société Générale & Sons, Inc.", "societe"), (None, "x"), ("...", "x")], "v string, w string")
    grams = df.select(text.char_ngrams(F.col("v")).alias("g"))
    assert grams._jdf.queryExecution().analyzed().toString().count("translate(") == 1
    both = df.select(text.ngram_similarity(text.char_ngrams(F.col("v")), text.char_ngrams(F.col("w"))).alias("s"))
    assert both._jdf.queryExecution().analyzed().toString().count("translate(") == 2
    whole, none, empty = (r.g for r in grams.collect())
    c = "*societegeneralesons*"
    assert none is None and empty == [] and set(whole) == {c[i : i + n] for n in range(2, 6) for i in range(len(c) - n + 1)} | {"*societe*", "*generale*", "*sons*"}
    assert both.first().s == pytest.approx(len(set(whole) & {x for x in both_grams("societe")}) / len(set(whole) | both_grams("societe")))


def both_grams(word):
    c = f"*{word}*"
    return {c[i : i + n] for n in range(2, 6) for i in range(len(c) - n + 1)} | {c}
