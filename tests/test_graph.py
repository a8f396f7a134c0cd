import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerweb import queries
from ledgerweb.functions import resolution
from ledgerweb.graph import BusinessGraph, blank_to_null, duplicate_keys, undirected
from ledgerweb.operators import algorithms, paths, similarity
from ledgerweb.plans import adoption, retrieval
from ledgerweb.sources import observations


@pytest.fixture(scope="module")
def edges(spark):
    return spark.createDataFrame([(1, 2), (2, 1), (2, 3), (3, 4), (1, 3), (5, 6)], "src long, dst long")


@pytest.fixture(scope="module")
def nodes(spark):
    return spark.createDataFrame([(i,) for i in range(1, 8)], "node long")


def test_patterns(edges):
    assert {tuple(r) for r in paths.mutual(edges).collect()} == {(1, 2)}
    assert {tuple(r) for r in paths.one_sided(edges).collect()} == {(2, 3), (3, 4), (1, 3), (5, 6)}
    assert {tuple(r) for r in paths.co_neighbours(edges).collect()} == {(1, 2, 3)}
    assert undirected(edges).count() == 12


def test_hops(spark, edges):
    start = spark.createDataFrame([(1,)], "node long")
    got = {(r.node, r.hops) for r in paths.hops_from(start, edges, 3).collect()}
    assert got == {(2, 1), (3, 1), (4, 2)}
    typed = paths.typed_paths(start, edges.withColumn("rel_type", F.lit("T")), 2)
    assert sorted(tuple(r.path) for r in typed.collect()) == [(1, 2), (1, 2, 3), (1, 3), (1, 3, 4)]


def test_degrees(edges, nodes):
    got = {r.node: (r.in_degree, r.out_degree) for r in algorithms.degrees(edges, nodes).collect()}
    assert got[2] == (1, 2) and got[4] == (1, None) and got[7] == (None, None)


def test_pagerank(edges, nodes):
    rank = {i: 0.15 for i in range(1, 8)}
    pairs = [tuple(r) for r in edges.collect()]
    out = {s: sum(a == s for a, _ in pairs) for s, _ in pairs}
    for _ in range(20):
        rank = {n: 0.15 + 0.85 * sum(rank[s] / out[s] for s, d in pairs if d == n) for n in rank}
    got = {r.node: r.rank for r in algorithms.pagerank(nodes, edges).collect()}
    assert got == pytest.approx(rank)


def test_betweenness(edges, nodes):
    got = {r.node: r.betweenness for r in algorithms.betweenness(nodes, edges).collect()}
    assert got == {1: 0.0, 2: 0.0, 3: 2.0, 4: 0.0, 5: 0.0, 6: 0.0, 7: 0.0}


def test_betweenness_of_a_random_graph_by_hand_and_over_tasks(spark):
    rng = np.random.default_rng(5)
    pairs = sorted({(int(a), int(b)) for a, b in rng.integers(0, 40, (110, 2))})
    follow = {}
    for a, b in pairs:
        follow.setdefault(a, []).append(b)
    want = dict.fromkeys(range(42), 0.0)
    for s in range(42):
        far, ways, before, order = {s: 0}, {s: 1}, {}, [s]
        for v in order:
            for w in follow.get(v, ()):
                if w not in far:
                    far[w], ways[w] = far[v] + 1, 0
                    order.append(w)
                if far[w] == far[v] + 1:
                    ways[w] += ways[v]
                    before.setdefault(w, []).append(v)
        owed = dict.fromkeys(order, 0.0)
        for w in reversed(order[1:]):
            for v in before[w]:
                owed[v] += ways[v] / ways[w] * (1 + owed[w])
            want[w] += owed[w]
    e = spark.createDataFrame([(a * 10**10, b * 10**10) for a, b in pairs] + [(None, 0)], "src long, dst long")
    out = algorithms.betweenness(spark.createDataFrame([(i * 10**10,) for i in range(42)], "node long"), e)
    got = {r.node // 10**10: r.betweenness for r in out.collect()}
    assert got == pytest.approx(want) and max(want.values()) > 10
    plan = out._jdf.queryExecution().executedPlan().toString()
    assert "REPARTITION_BY_NUM" in plan  # the sources' tasks are not merged into one
    assert algorithms.betweenness(spark.createDataFrame([(1,)], "node long"), e.limit(0)).first().betweenness == 0


def test_betweenness_by_joins(spark, nodes, edges, monkeypatch):
    want = {r.node: round(r.betweenness, 9) for r in algorithms.betweenness(nodes, edges).collect()}
    monkeypatch.setattr(algorithms, "MOST_ADJACENCY", 0)
    monkeypatch.setattr(algorithms, "SOURCES_AT_ONCE", 3)
    assert {r.node: round(r.betweenness, 9) for r in algorithms.betweenness(nodes, edges).collect()} == want and any(want.values())


def test_communities(spark):
    two = [(a, b) for g in (range(0, 5), range(5, 10)) for a in g for b in g if a < b] + [(4, 5)]
    e = spark.createDataFrame(two, "src long, dst long")
    n = spark.createDataFrame([(i,) for i in range(10)], "node long")
    label = algorithms.communities(n, e)
    assert algorithms.modularity(label, e) > 0.4


def test_similar_pairs(spark):
    v = spark.createDataFrame([("a", [1.0, 0.0, 0.0]), ("b", [1.0, 0.0, 0.0]), ("c", [0.0, 1.0, 0.0]), ("z", [0.0, 0.0, 0.0]), ("n", None)], "key string, embedding array<float>")
    assert [tuple(r) for r in similarity.top_k_similar_pairs(v, 0.9).collect()] == [("a", "b", 1.0)]
    assert similarity.top_k_similar_pairs(v.where("key = 'a'"), 0.0).count() == 0


def test_similar_pairs_in_blocks(spark, monkeypatch):
    monkeypatch.setattr(similarity, "BLOCK_ROWS", 7)
    x = np.random.default_rng(3).standard_normal((40, 5))
    v = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)], "key long, embedding array<double>")
    got = {(r.key1, r.key2): r.score for r in similarity.top_k_similar_pairs(v, 0.3, 4).collect()}
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -2)
    want = {}
    for i in range(40):
        for j in np.argsort(-s[i])[:4].tolist():
            if s[i, j] >= 0.3:
                want[min(i, j), max(i, j)] = s[i, j]
    assert got == pytest.approx(want)


def test_similar_pairs_around_one_and_without_shuffling_blocks(spark, monkeypatch):
    monkeypatch.setattr(similarity, "BLOCK_ROWS", 8)
    x = np.random.default_rng(4).standard_normal((60, 5))
    v = spark.createDataFrame([(i, r.tolist()) for i, r in enumerate(x)] + [(5, x[9].tolist()), (90, None), (91, [0.0] * 5)], "key long, embedding array<double>")
    whole = similarity.top_k_similar_pairs(v, 0.2, 6)
    assert whole._jdf.queryExecution().executedPlan().toString().count("Exchange") <= 3 and whole.where("key1 = key2").isEmpty()
    rows = [tuple(r) for r in whole.collect()]
    for k in (5, 7, 90, 91, 1000):
        assert sorted(tuple(r) for r in similarity.similar_pairs_around(v, k, 0.2, 6).collect()) == sorted(r for r in rows if k in r[:2])


def test_questions_on_alike_descriptions_make_no_pairs_of_whole_classes(spark, monkeypatch):
    from ledgerweb.plans import catalogue

    def never(*_, **__):
        raise AssertionError("pairs of whole classes")

    for name in ("same_class_pairs", "size_pairs", "set_jaccard_pairs"):
        monkeypatch.setattr(similarity, name, never)
    g = BusinessGraph(spark, "/root/testdata/sf0.01")
    assert catalogue.explainable_similarity(g).count() == 25 and catalogue.multi_dimensional_similarity(g).count() > 0


@pytest.mark.parametrize("again", [[], [(3, 0, "x"), (8, 1, "y")]])
def test_class_pairs_by_parts(spark, monkeypatch, again):
    monkeypatch.setattr(similarity, "PART_ROWS", 4)
    rows = [(i, None if i % 9 == 0 else i % 4 // 2, None if i % 7 == 0 else "xyz"[i % 3]) for i in range(60)] + again
    c = spark.createDataFrame(rows, "cik long, sic long, sector string")
    want = {}
    for n, s, t in rows:
        for m, u, v in rows:
            if n < m and (s is not None and s == u or t is not None and t == v):
                want[n, m] = min(want.get((n, m), "z"), "sector" if s is None or s != u else "sic", key=["sic", "sector", "z"].index)
    out = similarity.same_class_pairs(c, ["sic", "sector"])
    got = [tuple(r) for r in out.collect()]
    assert len(got) == len(want) and {(a, b): m for a, b, m in got} == want
    if not again:
        assert "HashAggregate(keys=[a#" not in out._jdf.queryExecution().executedPlan().toString()  # pairs are not grouped


def test_size_and_industry_pairs_by_parts(spark, monkeypatch):
    monkeypatch.setattr(similarity, "PART_ROWS", 3)
    rows = [(i, None if i % 5 == 0 else 10.0 ** (i % 4 + 7), None if i % 5 == 0 else 10.0 ** (i % 3 + 8), i * 97 % 2000, ["", "a", "b", None][i % 4]) for i in range(40)]
    c = spark.createDataFrame(rows, "cik long, revenue double, market_cap double, employees long, sector string")
    level = lambda v, at: None if v is None else sum(v >= x for x in at)
    sized = [(r[0], [level(r[1], similarity.MONEY_BUCKETS), level(r[2], similarity.MONEY_BUCKETS), level(r[3], similarity.STAFF_BUCKETS)]) for r in rows]
    want = {(a, b, similarity.SIZE_METRICS[k], x[k]) for a, x in sized for b, y in sized if a < b for k in [next((k for k in range(3) if x[k] is not None and x[k] == y[k]), None)] if k is not None}
    got = [tuple(r) for r in similarity.size_pairs(c).collect()]
    assert len(got) == len(want) and set(got) == want
    got = [(r.a, r.b, r.classification) for r in similarity.industry_pairs(c, "SECTOR").collect()]
    assert sorted(got) == [(p[0], q[0], p[4]) for p in rows for q in rows if p[0] < q[0] and p[4] and p[4] == q[4]]


def test_best_sets_by_blocks_make_no_candidate_rows(spark, monkeypatch):
    monkeypatch.setattr(similarity, "SET_ROWS", 9)
    rng = np.random.default_rng(6)
    held = {i: set(map(int, rng.integers(0, 12, rng.integers(1, 6)))) for i in range(50)}
    m = spark.createDataFrame([(n, str(x)) for n, s in held.items() for x in s], "n long, item string")
    want = {}
    for a, s in held.items():
        scores = sorted((-round(len(s & t) / len(s | t), 9), b) for b, t in held.items() if b != a and len(s & t) / len(s | t) >= 0.2)
        want[a] = [b for _, b in scores[:3]]
    out = similarity.best_by_jaccard(m, "n", "item", 0.2, 3)
    got = {}
    for r in sorted(out.collect(), key=lambda r: (-round(r.score, 9), r.dst)):
        got.setdefault(r.src, []).append(r.dst)
    assert got == {a: b for a, b in want.items() if b}
    assert "Join" not in out._jdf.queryExecution().executedPlan().toString()


def test_companies_of_alike_sets_are_those_of_alike_domains(spark):
    rng = np.random.default_rng(8)
    uses = spark.createDataFrame([(d, f"t{x}") for d in range(80) for x in sorted(set(map(int, rng.integers(0, 5, rng.integers(1, 5)))))], "domain long, technology string")
    owns = spark.createDataFrame([(d % 11, d) for d in range(90)] + [(3, 5), (7, 5)], "src long, dst long")
    want = similarity.via_domains(owns, similarity.set_jaccard_pairs(uses, "domain", "technology", 0.6), 0.6)
    asked = []
    matches = similarity.set_matches
    similarity.set_matches = lambda a, b, *rest: asked.append(a.count()) or matches(a, b, *rest)
    try:
        got = similarity.via_alike_sets(owns, uses, "domain", "technology", 0.6)
    finally:
        similarity.set_matches = matches
    assert sorted(map(tuple, got.collect())) == sorted(map(tuple, want.collect())) and asked[0] < 40  # sets, not domains


def test_scores_of_nine_digits_are_rounded_as_doubles(spark):
    df = spark.createDataFrame([(0.5047875,), (-0.5047875,), (0.25,), (0.1234567,), (None,)], "s double")
    assert [r.r for r in df.select(similarity.rounded("s").alias("r")).collect()] == [0.504787, -0.504787, 0.25, 0.123457, None]


def test_ranked_names_meet_as_classes(spark):
    m = spark.createDataFrame([("Alpha Inc.",), ("ALPHA",), ("Beta",), ("...",), (None,)], "mention string")
    c = spark.createDataFrame([(i, ["Alpha Corp", "alpha", "Alphabet", "Betamax", "zzz"][i % 5]) for i in range(20)], "cik long, name string")
    out = resolution.ranked_by_characters(m, c, 3)
    got = {}
    for r in out.collect():
        got.setdefault(r.mention, []).append(r.cik)
    assert {k: sorted(v) for k, v in got.items()} == {"Alpha Inc.": [0, 1, 5], "ALPHA": [0, 1, 5], "Beta": [3, 8, 13]}


def test_validation_and_cosine(spark):
    df = spark.createDataFrame([([1.0, 0.0],), ([float("nan"), 0.0],), ([float("inf"), 0.0],), ([1.0],), (None,), ([0.0, 0.0],)], "e array<double>")
    assert [r.v for r in df.select(similarity.valid_embedding(F.col("e"), 2).alias("v")).collect()] == [True, False, False, False, False, True]
    c = spark.createDataFrame([([1.0, 0.0], [-1.0, 0.0]), ([1.0, 0.0], [0.0, 0.0])], "a array<double>, b array<double>")
    assert [r.c for r in c.select(similarity.cosine(F.col("a"), F.col("b")).alias("c")).collect()] == [-1.0, 0.0]


def test_upserts(spark):
    rows = spark.createDataFrame([(1, 1, "a", None), (1, 2, None, "x"), (1, 3, "b", None), (2, 1, None, None)], "k int, t int, p string, q string")
    got = {r.k: (r.p, r.q) for r in observations.latest_values(rows, ["k"], ["t"], ["p", "q"]).collect()}
    assert got == {1: ("b", "x"), 2: (None, None)}
    old = spark.createDataFrame([(1, "o", None), (2, None, "y")], "k int, p string, q string")
    new = spark.createDataFrame([(1, None, "n"), (3, "z", None)], "k int, p string, q string")
    assert {tuple(r) for r in observations.upsert(old, new, ["k"]).collect()} == {(1, "o", "n"), (2, None, "y"), (3, "z", None)}
    assert {tuple(r) for r in observations.fill_only(old, new, ["k"]).collect()} == {(1, "o", "n"), (2, None, "y")}
    assert blank_to_null(spark.createDataFrame([(" ", " a ")], "p string, q string")).first() == (None, " a ")
    assert [tuple(r) for r in duplicate_keys(rows, "k").collect()] == [(1, 3)]


def test_domain_store(spark):
    status = spark.createDataFrame([(1, "example.com", "www.example.com", 200, 0), (2, None, "x", 404, 1000)], "id int, final_domain string, initial_domain string, http_status int, observed_at_ms long")
    whois = spark.createDataFrame([], "id int, url_status_id int, creation_date_ms long, expiration_date_ms long, registrar string")
    row = observations.observed_domains(status, whois).collect()
    assert [(r.domain, r.status, r.timestamp, r.creation_date) for r in row] == [("www.example.com", 200, None, None)]


def test_tiers_and_cleanup(spark):
    df = spark.createDataFrame([("HAS_COMPETITOR", 0.35), ("HAS_COMPETITOR", 0.3), ("HAS_PARTNER", 0.2), ("HAS_SUPPLIER", None), ("OTHER", 0.9)], "rel_type string, embedding_similarity double")
    got = df.select(resolution.confidence_tier(F.col("rel_type"), F.col("embedding_similarity")).alias("t"), resolution.cleanup_action(F.col("rel_type"), F.col("embedding_similarity")).alias("a")).collect()
    assert [tuple(r) for r in got] == [("high", "keep"), ("medium", "convert"), ("low", "delete"), ("medium", "delete"), ("low", "delete")]
    kept = resolution.split_edges(df.withColumn("src", F.lit(1))).collect()
    assert {(r.rel_type, r.confidence_tier, r.converted_from) for r in kept} == {("HAS_COMPETITOR", None, None), ("CANDIDATE_COMPETITOR", "medium", "HAS_COMPETITOR")}


def test_filters_and_verdicts(spark):
    df = spark.createDataFrame([
        ("IT", "IT is here"), ("target", "our target is near"), ("Intel", "He serves as a director of Intel."), ("Apple", "Available in the Apple App Store"), ("Intel", "We compete with Intel."),
    ], "c string, s string")
    got = [r.r for r in df.select(resolution.filter_reason(F.col("c"), F.col("s")).alias("r")).collect()]
    assert got == ["ticker_blocklist", "name_blocklist", "biographical", "platform", None]
    v = [tuple(r.v) for r in df.select(resolution.verified_relation(F.lit("HAS_COMPETITOR"), F.col("s")).alias("v")).collect()]
    assert v[4] == ("confirmed", None, 0.9) and v[0] == ("uncertain", None, 0.3) and v[2][0] == "contradicted"
    d = df.select(resolution.tiered_decision(F.col("c"), F.col("s"), F.lit("HAS_COMPETITOR"), F.lit(None), F.lit(0.4)).alias("d")).collect()
    assert [tuple(r.d) for r in d] == [("reject", 1), ("reject", 1), ("reject", 2), ("reject", 1), ("accept", 3)]


def test_scores(spark):
    df = spark.createDataFrame([("exact_ticker", "MSFT", "our competitor MSFT", "Microsoft Corporation")], "m string, c string, s string, n string")
    got = df.select(resolution.rule_confidence(F.col("m"), F.col("c"), F.col("s"), F.col("n")).alias("x")).first().x
    assert got == pytest.approx(0.4 + 0.2 * 0.6 + 0.2 * 0.8 + 0.1 + 0.1 * 0.5)
    score, tier = resolution.combined_confidence(F.lit(0.5), F.lit(0.5), F.lit(False), F.lit(True))
    assert tuple(df.select(score, tier).first()) == (pytest.approx(0.6), "medium")


def test_token_batches(spark):
    df = spark.createDataFrame([("a", i, n) for i, n in enumerate([3, 3, 3, 9, 1])], "g string, i int, t int")
    got = {r.i: r.batch for r in retrieval.token_batches(df, "g", "i", "t", 7).collect()}
    assert got == {0: 0, 1: 0, 2: 1, 3: 2, 4: 3}


def test_flagship(spark, sf):
    from ledgerweb.plans.catalogue import market_leaders

    assert market_leaders(BusinessGraph(spark, sf)).count() == 10


def test_adoption_of_every_technology_that_at_most_half_use(spark, sf):
    """By brute force: ranks of each target by itself, the 50 likeliest domains of each."""
    uses = BusinessGraph(spark, sf).uses.toPandas()
    of = {d: set(x) for d, x in uses.groupby("domain").technology}
    names = sorted(set(uses.technology))
    holds = np.array([[t in of[d] for t in names] for d in sorted(of)], float)
    co = holds.T @ holds
    np.fill_diagonal(co, 0)
    share = co / np.maximum(co.sum(axis=1, keepdims=True), 1)
    want = {}
    for j in np.flatnonzero(holds.sum(axis=0) <= 0.5 * len(of)):
        restart = 0.15 * np.eye(len(names))[j]
        rank = restart
        for _ in range(20):
            rank = restart + 0.85 * rank @ share
        score = (holds * rank).max(axis=1) * (1 + np.log(holds.sum(axis=1) + 1))
        want[names[j]] = sorted(np.round(score[holds[:, j] == 0], 6), reverse=True)[:50]
    got = queries.queries()["gra06_adoption"](spark, sf).toPandas()
    assert set(got.technology) == set(want) and len({t.split("/")[0] for t in want}) > 1
    for t, rows in got.groupby("technology"):
        assert sorted(rows.score, reverse=True) == pytest.approx(want[t], abs=2e-6)
        assert rows.domain.is_unique and not any(t in of[d] for d in rows.domain)


def test_adoption_shuffles_uses_not_domains_times_targets(spark, monkeypatch):
    """Of 4,000 domains and 30 targets: ties, batches, blocks of ranks and owners, by brute force; and what was shuffled."""
    r = np.random.default_rng(5)
    holds = r.random((400, 30)) < 0.15
    holds[:, 0] = True  # more than half use it
    holds[:, 29] = False
    holds[7, 29] = holds[0, 29] = True
    holds[1] = False
    holds[1, 28] = True  # one technology only
    holds = np.tile(holds, (10, 1))
    rows = [(int(d) * 3 - 50, f"t{t:02}") for d, t in np.argwhere(holds)]
    uses = spark.createDataFrame(rows, "domain long, technology string").repartition(4)
    co = holds.astype(float).T @ holds
    np.fill_diagonal(co, 0)
    share = co / np.maximum(co.sum(axis=1, keepdims=True), 1)
    want, ranks = set(), []
    for j in np.flatnonzero(holds.sum(axis=0) <= 0.5 * len(holds)):
        rank = restart = 0.15 * np.eye(30)[j]
        for _ in range(20):
            rank = restart + 0.85 * rank @ share
        ranks += [(f"t{j:02}", f"t{t:02}", float(x)) for t, x in enumerate(rank)]
        score = np.floor((holds * rank).max(axis=1) * (1 + np.log(holds.sum(axis=1) + 1)) * 1e6 + 0.5) / 1e6
        best = sorted((-score[d], int(d) * 3 - 50) for d in np.flatnonzero(~holds[:, j]))[:15]
        want |= {(d, f"t{j:02}", -s) for s, d in best}
    store = spark.sparkContext._jsc.sc().statusStore()

    def shuffled():
        stages = store.stageList(None, False, False, getattr(store, "stageList$default$4")(), None)
        return {stages.apply(i).stageId(): stages.apply(i).shuffleWriteRecords() for i in range(stages.size())}

    before = shuffled()
    got = adoption.adoption(uses, top_k=15).collect()
    assert {tuple(x) for x in got} == want and len(got) == len(want) == 29 * 15
    assert max(n for stage, n in shuffled().items() if stage not in before) <= len(rows)
    monkeypatch.setattr(adoption, "RANKS_AT_ONCE", 100)  # blocks of a few targets, a few rows at once
    given = spark.createDataFrame(ranks, "source string, technology string, rank double")
    assert {(x.domain, x.source, x.score) for x in adoption.likeliest(uses, given, 30, 29, 15).collect()} == want


def test_adoption_of_none(spark):
    empty = spark.createDataFrame([], "domain string, technology string")
    assert adoption.adoption(empty).collect() == []
    uses = spark.createDataFrame([("b", "x"), ("a", "y"), (None, "y"), ("c", "z"), ("d", None)], "domain string, technology string")
    assert {tuple(x) for x in adoption.adoption(uses, top_k=2).where("technology = 'x'").collect()} == {(None, "x", 0.0), ("a", "x", 0.0)}
