import pytest
from pyspark.sql import functions as F

from ledgerweb.functions import resolution
from ledgerweb.plans import competitors

COMPANIES = [(1045810, "NVDA", "NVIDIA CORP"), (50863, "INTC", "INTEL CORP"), (2488, "AMD", "ADVANCED MICRO DEVICES INC"), (789019, "MSFT", "MICROSOFT CORP"), (51143, "IBM", "INTERNATIONAL BUSINESS MACHINES CORP"), (999, "XY", "Xylo Corp")]


@pytest.fixture(scope="module")
def companies(spark):
    return spark.createDataFrame(COMPANIES, "cik long, ticker string, name string").cache()


def resolved(spark, companies, *names, own=0, least=0.8):
    asked = spark.createDataFrame([(own, n) for n in names], "src long, candidate string")
    return {r.candidate: (r.cik, round(r.confidence, 6)) for r in competitors.resolve_competitors(asked, competitors.spellings(companies), least).collect()}


def test_whole_and_partial_names(spark, companies):
    got = resolved(spark, companies, "intc", "Intel Corp", "Intel Corporation", "Intel", "intel corporation of america", "microsof", "International Business", "In", "zip")
    assert got == {"intc": (50863, 1.0), "Intel Corp": (50863, 1.0), "Intel Corporation": (50863, 0.9), "Intel": (50863, 1.0), "International Business": (51143, 0.95)}
    # "microsof" is 8 of the 9 letters of the looked-up name: .85 * 8 / 9 is under .8, and passes a lower bar
    assert resolved(spark, companies, "microsof", least=0.7) == {"microsof": (789019, round(0.85 * 8 / 9, 6))}


def test_a_company_is_no_competitor_of_itself(spark, companies):
    assert resolved(spark, companies, "Intel", "INTC", own=50863) == {}


def test_competitors_of_filings(spark, companies):
    business = "Our primary competitors include: Intel Corporation and Advanced Micro Devices, as well as many smaller makers of chips whose names we do not list here at all. Patents matter. We also compete with International Business Machines Corporation in servers."
    risk = "Competitors such as MSFT and Intel Corporation may harm us."
    filings = spark.createDataFrame([(1045810, business, risk), (789019, None, "We sell to Intel."), (5, "", None)], "cik long, business string, risk_factors string")
    got = {(r.src, r.dst): (r.confidence, r.raw_mention) for r in competitors.competitors(filings, companies).collect()}
    assert set(got) == {(1045810, 50863), (1045810, 2488), (1045810, 51143), (1045810, 789019)}
    assert got[1045810, 789019] == (1.0, "MSFT") and got[1045810, 50863][1] == "Intel"


def test_simple_competitors(spark, companies):
    filings = spark.createDataFrame([(1045810, "We face competition from Intel and AMD. We buy from IBM.", None)], "cik long, business string, risk_factors string")
    got = {r.dst: r.confidence for r in competitors.simple_competitors(filings, companies).collect()}
    assert got == {50863: 1.0, 2488: 1.0}


def test_short_candidates(spark, companies):
    asked = spark.createDataFrame([(1, c) for c in ("XY", "AMD", "NVDA", "Xylo", "Intel Corporation", "IT", "The", "Xylo Corp")], "src long, candidate string")
    got = {r.candidate: (r.cik, r.confidence) for r in competitors.resolve_candidates(asked, competitors.spellings(companies)).collect()}
    # a short match of a company that is not of high value decides: nothing else is tried
    assert "XY" not in got and "IT" not in got and "The" not in got and "Xylo" not in got
    assert got["NVDA"] == (1045810, 1.0) and got["Intel Corporation"] == (50863, 0.95) and got["Xylo Corp"] == (999, 1.0)


def test_fuzzy_names_meet_on_rare_words(spark):
    words = " ".join(f"w{i}" for i in range(7))
    companies = spark.createDataFrame([(1, None, f"{words} inc"), (2, None, "other inc"), (3, None, f"{words} ltd")] + [(10 + i, None, f"name{i} inc") for i in range(40)], "cik long, ticker string, name string")
    asked = spark.createDataFrame([(f"{words} inc usa",), ("nothing inc",)], "candidate string")
    got = [(r.candidate, r.cik, r.match_type, round(r.match_confidence, 6)) for r in resolution.match_candidates(asked, resolution.company_lookup(companies), fuzzy=True).collect()]
    assert got == [(f"{words} inc usa", 1, "fuzzy_name", round(8 / 9 * 0.9, 6))]


def test_labels_and_costs(spark):
    s = spark.createDataFrame([(0.5,), (0.3,), (0.15,), (0.1,), (0.75,)], "s double")
    assert [r.l for r in s.select(resolution.score_label(F.col("s"), "character").alias("l")).collect()] == [f"{x}_character_match" for x in ("strong", "moderate", "weak", "poor", "strong")]
    assert [r.l for r in s.select(resolution.score_label(F.col("s"), "semantic").alias("l")).collect()][3:] == ["poor_semantic_match", "strong_semantic_match"]
    cost = resolution.decision_costs(spark.createDataFrame([(1,), (3,), (3,), (4,)], "tier int")).first()
    assert (cost.tier1, cost.tier2, cost.tier3, cost.tier4) == (1, 0, 2, 1) and cost.cost == pytest.approx(0.012) and cost.per_decision == pytest.approx(0.003)
    assert resolution.decision_costs(spark.createDataFrame([], "tier int")).first().per_decision == 0
