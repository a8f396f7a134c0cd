"""Language ID, substring dedup, Order MinHash, quality, fingerprints: small tables and brute force."""

import hashlib
import random
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

from ledgerweb.llm import components, langid, minhash, quality, simhash, substring
from ledgerweb.llm.common import cut

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"


def docs(spark, texts, langs=None):
    langs = langs or ["en"] * len(texts)
    return spark.createDataFrame([(i, t, g, None, None) for i, (t, g) in enumerate(zip(texts, langs))], SCHEMA).repartition(3)


def prose(seed, n, words=400):
    r = random.Random(seed)
    vocabulary = [f"w{r.randrange(10**6)}" for _ in range(words)]
    return [r.choice(vocabulary) for _ in range(n)]


EDGE = [None, "", " \n\t", "a", "x y z", "é ü " * 3, "!!! ???"]


# language ID


def test_language_id(spark):
    texts = ["the cat sat on the mat and the dog"] * 12 + ["der hund und die katze sind nicht da"] * 12 + EDGE
    got = {r.doc_id: r for r in langid.language_id(docs(spark, texts, ["en"] * 12 + ["de"] * 12 + [None] * len(EDGE))).collect()}
    assert len(got) == len(texts)
    assert {got[i].lang_pred for i in range(12)} == {"en"} and {got[i].lang_pred for i in range(12, 24)} == {"de"}
    assert [got[24 + i].lang_pred for i in (0, 1, 2, 6)] == ["und"] * 4
    assert all(0 <= r.score <= 1 for r in got.values())


def test_language_id_without_anything_to_learn(spark):
    assert langid.language_id(docs(spark, [])).count() == 0
    assert {r.lang_pred for r in langid.language_id(docs(spark, ["abc", None], [None, None])).collect()} == {"und"}


def test_ngrams_by_hand():
    def by_hand(t):
        low = "".join(c.lower() if c.isalpha() else " " for c in t)
        s = " " + " ".join(low.split()) + " "
        grams = [c for c in s if c != " "] + [s[i : i + 2] for i in range(len(s) - 1)] + [s[i : i + 3] for i in range(len(s) - 2) if s[i + 1] != " "]
        return Counter(sum(ord(c) << 21 * k for k, c in enumerate(g)) for g in grams)

    for t in ("Hello, World!", "a", "ÀB  c9d", "日本語 x"):
        assert Counter(langid.ngram_codes(t).tolist()) == by_hand(t)
    assert not len(langid.ngram_codes("12 !"))


def test_language_stage_keeps_columns(spark):
    out = langid.language_stage(docs(spark, ["the cat and the dog are here"] * 6 + [None, "123"]).withColumn("score", F.lit(1)))
    assert out.columns == ["doc_id", "text", "lang", "source", "n_chars", "score"] and out.count() == 6


# substring dedup


def by_hand(texts):
    words = [t.encode().split() if t else [] for t in texts]
    seen = Counter(tuple(w[p : p + 35]) for w in words for p in range(len(w) - 34))
    out = []
    for w in words:
        gone = [False] * len(w)
        for p in range(len(w) - 34):
            if seen[tuple(w[p : p + 35])] > 1:
                gone[p : p + 35] = [True] * 35
        kept = [x for x, g in zip(w, gone) if not g]
        out.append((len(w), len(w) - len(kept), hashlib.sha256(b" ".join(kept)).hexdigest()))
    return out


def repeats():
    passage, texts = prose(1, 60), []
    for i in range(12):
        own = prose(100 + i, random.Random(i).randrange(20, 150))
        at = random.Random(i).randrange(len(own))
        texts.append(" ".join(own[:at] + passage[i % 5 : 60 - i % 7] + own[at:]) if i % 3 else " ".join(own))
    twice = prose(7, 40)
    return texts + [texts[1], " ".join(twice + ["x"] + twice), "la " * 80, " ".join(prose(9, 34)), "\x1c".join(prose(11, 40)), *EDGE]


def test_substring_dedup(spark):
    texts = repeats()
    got = {r.doc_id: (r.n_words, r.n_removed, r.kept_sha256) for r in substring.drop_repeats(docs(spark, texts), ["doc_id"]).collect()}
    assert [got[i] for i in range(len(texts))] == by_hand(texts)
    assert sum(x[1] for x in got.values()) > 500


def test_substring_dedup_from_files(spark, tmp_path):
    texts = repeats()
    docs(spark, texts).write.parquet(str(tmp_path / "d"))
    got = {r.doc_id: r.n_removed for r in substring.drop_repeats(spark.read.parquet(str(tmp_path / "d")), ["doc_id"]).collect()}
    assert [got[i] for i in range(len(texts))] == [x[1] for x in by_hand(texts)]


def test_substring_stage(spark):
    own = " ".join(prose(3, 50))
    shared = " ".join(prose(4, 50))
    d = docs(spark, [own, f"a  {shared} b", f"c {shared}", None]).withColumn("chunk", F.lit("mine")).withColumn("kind", F.lit(5))
    out = substring.substring_stage(d)
    assert out.columns == d.columns
    got = {r.doc_id: (r.text, r.n_chars, r.chunk) for r in out.collect()}
    assert got == {0: (own, len(own), "mine"), 1: ("a b", 3, "mine"), 2: ("c", 1, "mine"), 3: (None, None, "mine")}
    assert substring.drop_repeats(docs(spark, []), ["doc_id"]).count() == 0


def test_substring_dedup_of_a_very_long_text_and_rows_without_ids(spark):
    passage = prose(21, 60)
    long = [f"{i:x}" for i in range(7_000_000)]
    texts = [" ".join(long + passage), " ".join(["a", *passage, "b"]), " ".join(prose(22, 40)), " ".join(prose(22, 40)), None]
    assert len(texts[0]) > 45_000_000
    rows = spark.createDataFrame([(None, t) for t in texts], "doc_id long, text string").withColumn("n_removed", F.lit("mine"))
    got = Counter((r.doc_id, r.n_words, r.n_removed) for r in substring.drop_repeats(rows, ["doc_id"]).collect())
    assert got == Counter([(None, 7_000_060, 60), (None, 62, 60), (None, 40, 40), (None, 40, 40), (None, 0, 0)])
    kept = substring.drop_repeats(rows.limit(2), ["n_removed"], with_text=True)
    assert kept.columns == ["n_removed", "text"]


def test_windows_among_keys_that_share_their_first_hash():
    r = np.random.default_rng(3)
    hot = np.unique(r.integers(0, 6, (20, 2)).astype(np.uint64), axis=0)
    keys = r.integers(0, 7, (200, 2)).astype(np.uint64)
    want = [tuple(k) in set(map(tuple, hot)) for k in keys]
    assert substring._windows_among(keys, hot).tolist() == want
    assert not substring._windows_among(keys, hot[:0]).any()


# Order MinHash


def lcs(a, b):
    row = [0] * (len(b) + 1)
    for x in a:
        last = 0
        for j, y in enumerate(b):
            last, row[j + 1] = row[j + 1], last + 1 if x == y else max(row[j + 1], row[j])
    return row[-1]


def test_banded_alignment():
    r = random.Random(5)
    for _ in range(60):
        a = [r.randrange(6) for _ in range(r.randrange(0, 40))]
        b = a[:]
        for _ in range(r.randrange(6)):
            b.insert(r.randrange(len(b) + 1), r.randrange(6))
        x, y = (np.array(v, "<u8") for v in (a, b))
        assert minhash.banded_alignment(x, y, len(a) + len(b)) == lcs(a, b)
        assert minhash.banded_alignment(x, y, 6) == lcs(a, b)
        n = len(a) + len(b)
        exact = lcs(a, b) / (n - lcs(a, b)) if n else 0
        assert minhash.similarity(x, y) == pytest.approx(exact if exact >= 0.8 else 0) or exact < 0.8


def families():
    texts = []
    for f in range(6):
        base = prose(50 + f, 120)
        for e in range(8):
            w, r = base[:], random.Random(f * 10 + e)
            for _ in range(e):
                w[r.randrange(len(w))] = f"new{r.randrange(10**6)}"
            texts.append(" ".join(w))
    return texts + [texts[0], texts[0].upper(), "one two", "one two", "three", *EDGE]


def classes_by_hand(texts):
    codes = [minhash.kmers(t) for t in texts]
    up = list(range(len(texts)))

    def top(i):
        while up[i] != i:
            i = up[i]
        return i

    for i, (n, x) in enumerate(codes):
        for j in range(i):
            m, y = codes[j]
            if n is not None and m is not None and (n == m or minhash.similarity(x, y) >= 0.8):
                a, b = sorted((top(i), top(j)))
                up[b] = a
    return [top(i) for i in range(len(texts))]


@pytest.mark.parametrize("small, part", [(32, 256), (1, 3)])
def test_near_duplicates(spark, monkeypatch, small, part):
    monkeypatch.setattr(minhash, "SMALL", small)
    monkeypatch.setattr(minhash, "PART", part)
    texts = families()
    rows = minhash.near_duplicates(docs(spark, texts)).collect()
    got = {r.doc_id: r.class_id for r in rows}
    assert [got[i] for i in range(len(texts))] == classes_by_hand(texts)
    assert all(r.kept == (r.doc_id == r.class_id) for r in rows)


def test_near_duplicates_of_odd_rows(spark):
    t = " ".join(prose(2, 60))
    d = spark.createDataFrame([(None, t, "en", None, None), (4, t, None, None, None), (4, t, None, None, None), (None, None, None, None, None)], SCHEMA).withColumn("node", F.lit(1))
    got = sorted((str(r.doc_id), str(r.class_id), r.kept) for r in minhash.near_duplicates(d).collect())
    assert got == [("4", "4", True), ("4", "4", True), ("None", "4", False), ("None", "None", True)]
    assert minhash.near_duplicates(docs(spark, [])).count() == 0
    assert minhash.near_duplicate_stage(docs(spark, [t, t, "other"])).columns == docs(spark, []).columns
    assert {r.doc_id for r in minhash.near_duplicate_stage(docs(spark, [t, t, "other"])).collect()} == {0, 2}


def test_all_links_of_documents_at_the_threshold(spark):
    """Recall on the documents table: every pair of different texts at 0.8 or more is joined, and no other."""
    table = spark.read.parquet("/root/testdata/sf0.001/documents.parquet")
    texts = {r.doc_id: r.text for r in table.collect()}
    codes = {}
    for t in texts.values():
        node, c = minhash.kmers(t)
        if node is not None:
            codes[node] = c
    real = {(a, b) for a in codes for b in codes if a < b and min(len(codes[a]), len(codes[b])) >= 0.8 * max(len(codes[a]), len(codes[b])) and minhash.similarity(codes[a], codes[b]) >= 0.8}
    up = {n: n for n in codes}

    def top(n):
        while up[n] != n:
            n = up[n]
        return n

    for a, b in real:
        x, y = sorted((top(a), top(b)))
        up[y] = x
    least: dict = {}
    nodes = {i: minhash.kmers(t)[0] for i, t in texts.items()}
    for i, n in sorted(nodes.items()):
        if n is not None:
            least.setdefault(top(n), i)
    got = {r.doc_id: r.class_id for r in minhash.near_duplicates(table).collect()}
    assert real and got == {i: i if n is None else least[top(n)] for i, n in nodes.items()}


def test_many_texts_without_an_id(spark):
    """Rows are found again by their text: this ends in the time that as many rows with ids take."""
    texts = [" ".join(prose(i, 12)) for i in range(3000)]
    rows = spark.createDataFrame([(None, t) for t in texts + texts[:500]], "doc_id long, text string")
    got = minhash.near_links(rows)
    assert got[0].count() == 3500 and got[0].distinct().count() == 3000 and got[1].count() == 0


def test_a_very_long_text_and_its_near_copy(spark):
    words = [f"{i:x}" for i in range(400_000)]
    rows = spark.createDataFrame([(1, " ".join(words)), (2, " ".join(words[:-9])), (3, "a b c d e f")], "doc_id long, text string")
    assert {r.doc_id: r.class_id for r in minhash.near_duplicates(rows).collect()} == {1: 1, 2: 1, 3: 3}


def test_few_files_between_the_steps(spark, monkeypatch):
    """Each file costs a task and, in a local folder, child processes of the executor: no table of unverified pairs, no copy of links."""
    written = Counter()

    def counted(df, name):
        out = cut(df, name)
        written[name] += len(out.inputFiles())
        return out

    for module in (minhash, components):
        monkeypatch.setattr(module, "cut", counted)
    monkeypatch.setattr(minhash, "SMALL", 3)
    texts = families() + [" ".join(prose(f, 40)) for f in range(40)]
    held = {"spark.sql.shuffle.partitions": "11", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in held}
    try:
        for k, v in held.items():
            spark.conf.set(k, v)
        got = {r.doc_id: r.class_id for r in minhash.near_duplicates(docs(spark, texts)).collect()}
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    assert [got[i] for i in range(len(texts))] == classes_by_hand(texts)
    assert not {"pairs", "led"} & set(written) and written.total() <= 140


# quality


def test_quality_on_held_out_rows(spark):
    r = random.Random(8)
    texts, kind = [], []
    for i in range(400):
        w, good = prose(i, r.randrange(20, 60)), i % 3 > 0
        texts.append(" ".join(w) if good else " ".join(f"{x}$$$" if i % 2 else "w1" for x in w))
        kind.append(int(good))
    labels = spark.createDataFrame([(i, k, 0) for i, k in enumerate(kind)] + [(None, 1, 0), (3, None, 0)], "doc_id long, quality int, toxic int")
    rows = quality.quality_scores(docs(spark, texts + EDGE), labels).collect()
    assert len(rows) == 407 and all(0 <= x.score <= 1 and x.predicted == int(x.score >= 0.5) for x in rows)
    held = [x for x in rows if x.held_out and x.doc_id < 400]
    assert len(held) > 80 and np.mean([x.predicted == kind[x.doc_id] for x in held]) > 0.97


def test_quality_without_labels(spark):
    none = spark.createDataFrame([], "doc_id long, quality int, toxic int")
    assert {r.score for r in quality.quality_scores(docs(spark, ["a", None]), none).collect()} == {0.5}
    one = spark.createDataFrame([(0, 1, 0), (1, 1, 0)], "doc_id long, quality int, toxic int")
    assert all(r.score > 0.5 for r in quality.quality_scores(docs(spark, ["a", "b", None]), one).collect())
    assert quality.quality_scores(docs(spark, []), none).count() == 0


def test_compiled_rules_score_as_the_rules_do(spark):
    x = np.random.default_rng(1).random((300, len(quality.STATS)))
    y = (x[:, 0] + x[:, 3] > 1).astype(float)
    b, rules = quality.fit(x, y)
    frame = spark.createDataFrame([(i, *map(float, v)) for i, v in enumerate(x)], "i int, " + ", ".join(f"stat_{s} double" for s in quality.STATS))
    got = {r.i: r.s for r in frame.select("i", quality.compiled(b, rules).alias("s")).collect()}
    want = 1 / (1 + np.exp(-(b + sum(w * quality.fires(r, x) for w, r in rules))))
    assert [got[i] for i in range(300)] == pytest.approx(want.tolist())
    assert ((want >= 0.5) == y).mean() > 0.85


# fingerprints


def test_fingerprints(spark):
    texts = [" ".join(prose(i, 80)) for i in range(40)] + [" ".join(prose(3, 80)), *EDGE]
    rows = {r.doc_id: r for r in simhash.document_fingerprints(docs(spark, texts)).collect()}
    assert len(rows) == len(texts)
    prints = [simhash.fingerprint(t) for t in texts]
    for i, t in enumerate(texts):
        following = texts[(i + 1) % len(texts)] or ""
        other, r = simhash.edited(t or "", following), rows[i]
        assert (r.n_chars, r.edited_sha256, r.fingerprint, r.edited_fingerprint) == (len(t or ""), hashlib.sha256(other.encode()).hexdigest(), prints[i].hex(), simhash.fingerprint(other).hex())
        assert r.near_next == simhash.likeness(prints[i], simhash.fingerprint(following))
        if i % 20 == 0:
            assert r.near_docs == sum(simhash.likeness(prints[i], p) >= 1 - simhash.RADIUS / simhash.BITS for p in prints) - 1
    assert np.mean([rows[i].near_edited - rows[i].near_next for i in range(40)]) > 0.2


def test_fingerprint_edges(spark):
    assert simhash.document_fingerprints(docs(spark, [])).count() == 0
    alone = simhash.fingerprints(docs(spark, ["abcdefgh"])).first()
    assert alone.edited_sha256 == hashlib.sha256(b"abcdefab").hexdigest() and alone.near_next == 1.0


def test_radius_search(spark):
    r = random.Random(4)
    base = [r.getrandbits(128) for _ in range(20)]
    near = [b ^ sum(1 << x for x in r.sample(range(128), r.randrange(1, 6))) for b in base for _ in range(5)]
    every = sorted({f"{x:032x}" for x in base + near})
    df = spark.createDataFrame([(x,) for x in every], "fingerprint string")
    got = {tuple(x) for x in simhash.within_radius(df, df).collect()}
    assert got == {(a, b) for a in every for b in every if (int(a, 16) ^ int(b, 16)).bit_count() <= 3}


def test_stage_keeps_rows_without_an_id(spark):
    t, u = " ".join(prose(2, 60)), " ".join(prose(3, 60))
    d = spark.createDataFrame([(None, t, "en", None, None), (None, u, "en", None, None), (4, t, None, None, None), (5, t, None, None, None), (5, u + " x", None, None, None)], SCHEMA)
    got = sorted((str(r.doc_id), r.text) for r in minhash.near_duplicate_stage(d).collect())
    assert got == sorted([("None", t), ("None", u), ("4", t), ("5", t), ("5", u + " x")])


def test_radius_of_near_copies(spark):
    """Of texts of 400 words with one word changed, more than half lie within the radius; none of other texts does."""
    texts, near = [], []
    for i in range(100):
        w = prose(i, 400)
        texts += [" ".join(w), " ".join([*w[:200], f"other{i}", *w[201:]])]
        a, b = map(simhash.fingerprint, texts[-2:])
        near.append(simhash.likeness(a, b) >= 1 - simhash.RADIUS / simhash.BITS)
    assert np.mean(near) > 0.5
    rows = spark.createDataFrame([(20 * i, t, "en", None, None) for i, t in enumerate(texts)], SCHEMA)
    got = {r.doc_id // 20: r.near_docs for r in simhash.document_fingerprints(rows).collect()}
    assert got == {i: int(near[i // 2]) for i in range(200)}
