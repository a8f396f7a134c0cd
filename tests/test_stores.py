from datetime import datetime

import pytest
from pyspark.sql import functions as F

from ledgerweb import session
from ledgerweb.operators import ranking, similarity
from ledgerweb.plans import adoption, retrieval
from ledgerweb.sources import landed, loaders, observations
from ledgerweb.sources.stores import Store


def test_store(spark, tmp_path):
    s = Store(spark, str(tmp_path / "s"), datetime(2024, 5, 1))
    assert s.get("a", "x") is None and s.count() == 0 and s.clear() == 0
    s.put("a", spark.createDataFrame([("x", "1"), ("y", "2"), ("y", "3")], "key string, value string"), 30)
    s.put("b", spark.createDataFrame([("x", "9")], "key string, value string"))
    assert (s.get("a", "x"), s.get("b", "x"), s.get("a", "y"), s.count("a"), s.count()) == ("1", "9", "2", 2, 3)
    assert {tuple(r) for r in s.get_many("a", spark.createDataFrame([("x",), ("z",), ("x",)], "key string")).collect()} == {("x", "1")}
    s.put("a", spark.createDataFrame([("x", "7")], "key string, value string"), 30)
    assert [r.key for r in s.keys("a").collect()] == ["x", "y"] and s.get("a", "x") == "7"
    assert {tuple(r) for r in s.stats().collect()} == {("a", 2, 2), ("b", 1, 1)}
    later = Store(spark, str(tmp_path / "s"), datetime(2024, 6, 15))
    assert later.count("a") == 0 and later.get("b", "x") == "9"
    s.delete("a", spark.createDataFrame([("y",), ("q",)], "key string"))
    assert s.count("a") == 1 and s.clear("a") == 1 and s.count() == 1


def test_store_of_companies_without_a_filing_and_its_size(spark, tmp_path):
    s = Store(spark, str(tmp_path / "s"), datetime(2024, 5, 1))
    s.mark_no_filing(spark.createDataFrame([(7,), (8,), (7,)], "cik long"))
    assert [r.cik for r in s.no_filing().collect()] == ["7", "8"]
    for day in (2, 3):
        Store(spark, str(tmp_path / "s"), datetime(2024, 5, day)).put("v", spark.createDataFrame([(f"k{day}", "12345")], "key string, value string"))
    s = Store(spark, str(tmp_path / "s"), datetime(2024, 5, 4))
    s.trim(7)
    assert [r.key for r in s.keys("v").collect()] == ["k3"]
    s.trim(100)
    assert s.count("v") == 1


def test_updates_add_no_rows(spark):
    old = spark.createDataFrame([(1, "a", None), (2, "b", 5)], "k int, p string, q int")
    new = spark.createDataFrame([(1, None, 7), (3, "z", 9)], "k int, p string, q int")
    assert sorted(map(tuple, observations.update(old, new, ["k"]).collect())) == [(1, "a", 7), (2, "b", 5)]
    left, gone = observations.delete_where(old, F.col("q") > 1)
    assert gone == 1 and [r.k for r in left.collect()] == [1]


def test_unreadable_filings_count_as_there(spark):
    forms = spark.createDataFrame([(None, None)], "f array<string>, d array<string>")
    assert forms.select(observations.has_annual_report(F.col("f"), F.col("d"), "2019-01-01", "2020-06-01")).first()[0]


def test_landed_answers(spark):
    bodies = spark.createDataFrame([(1, '{"sic":"7372","name":["Acme","x"],"naics":541511}'), (2, '{"sic":"7","name":"B"}'), (3, "oops"), (4, None)], "cik long, body string")
    got = {r.cik: (r.sic, r.naics, r.name) for r in landed.registry_info(bodies).collect()}
    assert got == {1: ("7372", "541511", "Acme"), 2: (None, None, "B")}
    market = spark.createDataFrame([("A", '{"currentPrice":1.5,"sector":""}'), ("B", '{"sector":"x"}'), ("C", "oops")], "ticker string, body string")
    assert [(r.ticker, r.price, r.sector) for r in landed.market_info(market).collect()] == [("A", 1.5, None)]


def test_both_directions_and_rewriting(spark):
    pairs = spark.createDataFrame([(1, 2, 0.5)], "a long, b long, score double")
    new = loaders.both_directions(pairs, "S")
    old = spark.createDataFrame([(5, 6, "S", 0.1), (5, 6, "T", 0.2)], "src long, dst long, rel_type string, score double")
    assert {tuple(r) for r in loaders.rewritten(old, new, "S").collect()} == {(5, 6, "T", 0.2), (1, 2, "S", 0.5), (2, 1, "S", 0.5)}


def test_numbering_without_one_task(spark):
    rows = spark.range(1000).select((F.col("id") * 7919 % 1000).alias("v"))
    got = sorted((r.place, r.v) for r in ranking.numbered(rows, "place", F.asc("v")).collect())
    assert got == [(i + 1, i) for i in range(1000)]


def test_adoption_from_all_targets_together(spark, sf):
    from ledgerweb.graph import BusinessGraph

    g = BusinessGraph(spark, sf)
    got = adoption.adoption(g.uses, top_k=3, batch=True).collect()
    uses = {(r.domain, r.technology) for r in g.uses.collect()}
    best: dict = {}
    for r in got:
        best.setdefault(r.technology, []).append(r)
        assert (r.domain, r.technology) not in uses
    scores = {r.domain: r.score for r in got}
    for rows in best.values():
        assert len(rows) == 3
        worst = min(r.score for r in rows)
        owners = {d for d, t in uses if t == rows[0].technology}
        assert all(s <= worst or d in owners or d in {r.domain for r in rows} for d, s in scores.items())


def test_jaccard_by_rare_items(spark):
    import random

    r = random.Random(3)
    sets = {n: {"common", *(f"i{r.randrange(12)}" for _ in range(r.randrange(1, 7)))} for n in range(60)}
    rows = spark.createDataFrame([(n, i) for n, s in sets.items() for i in s], "n long, i string")
    for least in (0.5, 0.6, 0.8, 1.0):
        got = {(x.a, x.b): (x.shared, round(x.score, 9)) for x in similarity.set_jaccard_pairs(rows, "n", "i", least).collect()}
        assert got == {(a, b): (len(s & t), round(len(s & t) / len(s | t), 9)) for a, s in sets.items() for b, t in sets.items() if a < b and len(s & t) / len(s | t) >= least}
    one = similarity.set_jaccard_pairs(rows, "n", "i", 0.5, around=7)
    assert all(7 in (x.a, x.b) for x in one.collect()) and one.count() == sum(7 in p for p in ((a, b) for a in sets for b in sets if a < b and len(sets[a] & sets[b]) / len(sets[a] | sets[b]) >= 0.5))


def test_combined_embeddings(spark):
    v = spark.createDataFrame([(1, 0, [1.0, -1.0, 0.5]), (1, 1, [0.5, 0.0, 1.0]), (1, 2, [-0.5, 0.5, 0.0]), (2, 0, [3.0]), (3, 0, None)], "k long, i int, embedding array<double>")
    assert {r.k: r.embedding for r in retrieval.combined_embeddings(v, "k", "i", "max").collect()} == {1: [1.0, 0.5, 1.0], 2: [3.0], 3: None}
    with pytest.raises(ValueError):
        retrieval.combined_embeddings(v, "k", "i", "median")


def test_scratch_tables(spark):
    with session.scratch() as kept:
        a = session.cut(spark.range(3).toDF("x"), "a")
        b = session.cut(spark.range(3).toDF("x"), "b")
        kept.append(b)
    assert b.count() == 3
    with pytest.raises(Exception):
        spark.read.parquet(a._cut_path).count()
    session.release(b)


def test_related_companies(spark):
    start = spark.createDataFrame([(1,)], "node long")
    edges = spark.createDataFrame([(1, 2, "HAS_COMPETITOR"), (3, 1, "HAS_SUPPLIER"), (2, 4, "HAS_PARTNER"), (4, 5, "HAS_PARTNER")], "src long, dst long, rel_type string")
    got = [(r.node, r.relation, r.hops, r.via) for r in retrieval.related_companies(start, edges).collect()]
    assert got == [(3, "HAS_SUPPLIER", 1, None), (2, "HAS_COMPETITOR", 1, None), (4, "HAS_COMPETITOR", 2, 2)]
