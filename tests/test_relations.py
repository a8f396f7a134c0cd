import pytest
from pyspark.sql import functions as F

from ledgerweb.plans import relations

COMPANIES = [(789019, "MSFT", "Microsoft Corporation"), (50863, "INTC", "Intel Corporation"), (2488, "AMD", "Advanced Micro Devices, Inc.")]


def test_relations_of_a_filing(spark):
    companies = spark.createDataFrame(COMPANIES, "cik long, ticker string, name string")
    filings = spark.createDataFrame([(2488, "We compete with Intel Corporation. We purchase wafers from suppliers such as Microsoft. AMD is us.", "Our competitors include Intel and Microsoft.")], "cik long, business string, risk_factors string")
    got = {(r.src, r.dst, r.rel_type): r.raw_mention for r in relations.extracted_relations(filings, companies).collect()}
    assert got[2488, 50863, "HAS_COMPETITOR"] == "Intel Corporation" and got[2488, 789019, "HAS_COMPETITOR"] == "Microsoft"
    assert (2488, 789019, "HAS_SUPPLIER") in got and not any(d == 2488 for _, d, _ in got)
    rel = relations.extracted_relations(filings, companies)
    sim = spark.createDataFrame([(2488, 50863, 0.5)], "src long, dst long, similarity double")
    verdict = spark.createDataFrame([(2488, 789019, "HAS_SUPPLIER", "confirmed")], "src long, dst long, rel_type string, verdict string")
    decided = {(r.dst, r.rel_type): (r.decision, r.decided_by) for r in relations.decided_relations(rel, sim, verdict).collect()}
    assert decided[50863, "HAS_COMPETITOR"] == ("accept", 3) and decided[789019, "HAS_SUPPLIER"] == ("accept", 4) and decided[789019, "HAS_COMPETITOR"][0] == "reject"


def test_parsed_filings(spark):
    body = "We make things at www.acme.com. " * 30
    html = f"<!-- filed 2022-10-28 --><p>Item 1. Business</p><p>{body}</p><p>Item 1A. Risk Factors</p><p>{'It may rain. ' * 20}</p><p>Item 2. Properties</p>"
    r = relations.parsed_filings(spark.createDataFrame([(1, html), (2, "<p>x</p>")], "id int, html string"), "id").orderBy("id").collect()
    assert r[0].business == body.strip() and r[0].risk_factors.startswith("It may rain") and r[0].website == "acme.com" and str(r[0].filed) == "2022-10-28"
    assert (r[1].business, r[1].risk_factors, r[1].website) == (None, None, None)


def test_small_columns(spark):
    df = spark.createDataFrame([("Acme", "a" * 200 + ". " + "b" * 200, "ACM"), ("Acme", "short", None)], "m string, c string, h string")
    got = [r.t for r in df.select(relations.mention_text(F.col("m"), F.col("c"), F.col("h")).alias("t")).collect()]
    assert got == ["Acme (ACM) : " + "a" * 200 + ".", "Acme : short"]
    v = spark.createDataFrame([(True, 0.8), (False, 0.9), (True, 0.5)], "v boolean, c double")
    assert [r.r for r in v.select(relations.verdict_of(F.col("v"), F.col("c")).alias("r")).collect()] == ["confirmed", "rejected", "uncertain"]
    cost = relations.verification_cost(df.select(F.col("c").alias("context")), 1.0, 2.0).first()
    assert (cost.claims, cost.tokens_in, cost.tokens_out) == (2, 400 + 100 + 1, 200) and cost.cost == pytest.approx((501 + 400) / 1e6)
    assert relations.verification_cost(df.where("m = ''").select(F.col("c").alias("context")), 1.0, 2.0).first().cost == 0
