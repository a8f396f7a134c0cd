"""Brute-force versions of what SQL can't say, and odd tables: ties, repeated rows, very long texts, clashing names."""

import hashlib
import random
import zlib
from collections import Counter

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerweb.llm import langid, mixing, packing, quality, simhash, sstable
from ledgerweb.llm.common import cut
from ledgerweb.llm.tokens import encoder

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
LONG = " ".join(f"w{i % 977} Long, {i}" for i in range(120_000))


def docs(spark, rows):
    """Rows of (doc_id, text), dealt to some partitions, with columns named as results are."""
    frame = spark.createDataFrame([(i, t, "en", None, None) for i, t in rows], SCHEMA).repartition(3)
    for name in ("score", "rate", "copies", "n_tokens", "start", "length", "node", "class_id", "fingerprint", "near_next", "h", "chunk", "lang_pred", "held_out", "words"):
        frame = frame.withColumn(name, F.lit("mine"))
    return frame


# language ID


def nearest_by_hand(profiles, text):
    counts = Counter(langid.ngram_codes(text).tolist())
    if not counts or not profiles:
        return "und", 0.0
    own = sorted(counts, key=lambda c: (-counts[c], c))[: langid.PROFILE_SIZE]
    away = {}
    for lang, profile in profiles.items():
        rank = {c: i for i, c in enumerate(profile)}
        away[lang] = sum(abs(rank[c] - i) if c in rank else langid.PROFILE_SIZE for i, c in enumerate(own))
    best = min(sorted(away), key=lambda g: away[g])
    return best, 1 - away[best] / (langid.PROFILE_SIZE * len(own))


def test_language_distances_by_brute_force(spark, sf):
    table = spark.read.parquet(f"{sf}/documents.parquet")
    rows = table.collect()
    taught = [r for r in rows if r.lang and r.text and zlib.crc32(str(r.doc_id).encode()) % 4 != 2]
    profiles = {}
    for lang in sorted({r.lang for r in taught}):
        counts = Counter(c for r in taught if r.lang == lang for c in langid.ngram_codes(r.text).tolist())
        profiles[lang] = sorted(counts, key=lambda c: (-counts[c], c))[: langid.PROFILE_SIZE]
    got = {r.doc_id: r for r in langid.language_id(table).collect()}
    for r in rows:
        lang, score = nearest_by_hand(profiles, r.text)
        assert got[r.doc_id].lang_pred == lang and got[r.doc_id].score == pytest.approx(score, abs=1e-12)
        assert got[r.doc_id].held_out == (zlib.crc32(str(r.doc_id).encode()) % 4 == 2)


def test_language_ties_repeats_and_long_texts(spark):
    both = [(i, "ab ab cd") for i in (0, 1, 3, 4)]
    rows = spark.createDataFrame([(i, t, g) for i, t in both for g in ("bb", "aa")] + [(90, LONG, None), (None, "ab", None), (None, "ab", None)], "doc_id long, text string, lang string").withColumn("lang_pred", F.lit(1))
    got = langid.language_id(rows).collect()
    assert len(got) == 11 and {r.lang_pred for r in got} == {"aa"}  # both profiles are the same: the first wins


# mixing


def test_rates_by_brute_force(spark):
    rng = np.random.default_rng(4)
    posterior, tokens = rng.dirichlet([0.5, 0.5, 0.5], 200), rng.integers(0, 500, 200)
    shares = [0.7, 0.2, 0.1]
    table = spark.createDataFrame([(int(n), *map(float, p)) for n, p in zip(tokens, posterior)], "n long, a double, b double, c double")
    steps = mixing.fit_rates(table, "n", ["a", "b", "c"], shares)
    total, rate = tokens.sum(), np.ones(200)
    moments = np.einsum("n,ni,nj->ij", tokens, posterior, posterior) / total
    for _ in range(len(steps)):
        off = (tokens * rate) @ posterior / total - shares
        rate = np.maximum(0, rate - posterior @ (np.linalg.pinv(moments) @ off))
    got = np.array([r.r for r in table.select(mixing.rate_after(steps, ["a", "b", "c"]).alias("r")).collect()])
    assert got == pytest.approx(rate, abs=1e-9)
    assert (tokens * got) @ posterior / total == pytest.approx(shares, abs=1e-6)


def test_targets_that_no_rates_meet(spark):
    """One membership for all rows: the steps come to rest at the closest shares."""
    table = spark.createDataFrame([(10, 0.5, 0.5)] * 4, "n long, a double, b double")
    steps = mixing.fit_rates(table, "n", ["a", "b"], [0.9, 0.1])
    rate = table.select(mixing.rate_after(steps, ["a", "b"]).alias("r")).first().r
    assert rate == pytest.approx(1.0)


def test_mixing_of_repeated_ids_and_long_texts(spark):
    rows = docs(spark, [(1, "fair words"), (1, "fair words"), (2, LONG), (None, "x"), (None, None), (3, "idiot idiot")])
    labels = spark.createDataFrame([(1, "clean"), (3, "toxic"), (2, "clean"), (None, "toxic"), (9, "junk")], "doc_id long, domain string")
    out = mixing.mix(rows, labels).collect()
    assert len(out) == 6 and len({r.copies for r in out if r.doc_id == 1}) == 1
    assert {r.n_tokens for r in out if r.doc_id == 2} == {len(LONG.split())}
    staged = mixing.mixing_stage(rows, labels)
    assert staged.columns == rows.columns and staged.where("score <> 'mine'").count() == 0


def test_held_out_shares(spark):
    """Half of the labelled rows teach; of the others each domain's tokens are near their target."""
    r, texts, kinds = random.Random(6), [], []
    for i in range(1500):
        kind = r.choices(["clean", "junk", "toxic"], [70, 20, 10])[0]
        w = [f"w{r.randrange(300)}" for _ in range(r.randrange(40, 80))]
        if kind == "junk":
            w = ["again"] * 50 if r.random() < 0.9 else w
        if kind == "toxic" and r.random() < 0.7:  # the others can't be told from clean ones
            w += ["idiot", "clown"]
        texts.append(" ".join(w))
        kinds.append(kind)
    labels = spark.createDataFrame([(i, k) for i, k in enumerate(kinds) if i % 2], "doc_id long, domain string")
    out = mixing.mix(docs(spark, list(enumerate(texts))), labels).collect()
    held = [x for x in out if x.doc_id % 2 == 0]
    total = sum(x.rate * x.n_tokens for x in held)
    for d, share in mixing.TARGETS.items():
        assert sum(x.rate * x.n_tokens for x in held if kinds[x.doc_id] == d) / total == pytest.approx(share, abs=0.03)


# packing and shards


def ids_of(text):
    return np.append(np.frombuffer(encoder().encode(text), "<u4"), 1).astype("<u4")


def test_packing_of_repeated_and_null_ids(spark):
    rows = [(None, "a b"), (None, "a b"), (7, "c"), (7, "c"), (8, LONG), (9, None)]
    got = packing.pack(docs(spark, rows)).collect()
    assert Counter(r.doc_id for r in got if r.piece == 0) == Counter(i for i, _ in rows)
    assert sum(r.length for r in got) == sum(len(ids_of(t)) for _, t in rows)
    ends = {}
    for r in sorted(got, key=lambda r: (r.sequence_id, r.offset)):
        assert r.offset == ends.get(r.sequence_id, 0)
        ends[r.sequence_id] = r.offset + r.length
    assert max(ends.values()) <= 4096


def test_shards_roll_over(spark, monkeypatch):
    monkeypatch.setattr(sstable, "SHARD_BYTES", 1 << 17)
    rows = [(i, f"text number {i} " * 400) for i in range(400)] + [(1000, LONG), (None, None)]
    manifest = sstable.write_shards(docs(spark, rows), sstable.fresh_path(spark, "test"))
    assert manifest.count() > 8 and manifest.select("uri").distinct().count() == manifest.count()
    got, before = {r.doc_id: r for r in sstable.read_shards(spark, manifest).collect()}, 0
    for i, t in sorted(rows, key=lambda r: (r[0] is not None, r[0] or 0)):
        ids = ids_of(t)
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (before, len(ids), zlib.crc32(ids.tobytes()))
        before += len(ids)
    assert sstable.lookup(manifest, 399).tolist() == ids_of(rows[399][1]).tolist()


# quality


def test_weights_are_the_lasso_optimum():
    """The conditions of an optimum, by brute force: no gradient beyond the penalty, and just the penalty where a weight is."""
    rng = np.random.default_rng(2)
    z = (rng.random((400, 12)) < 0.4).astype(np.float32)
    y = (z[:, 0] + z[:, 3] + 0.3 * rng.standard_normal(400) > 0.8).astype(float)
    b, w = quality.lasso_logistic(z, y, 0.01, 4000)
    scale = z.std(axis=0)
    gradient = ((1 / (1 + np.exp(-(z @ w + b))) - y) @ ((z - z.mean(axis=0)) / scale)) / len(y)
    on = np.abs(w) > 1e-6
    assert on[[0, 3]].all() and not on.all()
    assert gradient[on] == pytest.approx(-0.01 * np.sign(w[on]), abs=1e-3) and np.abs(gradient).max() < 0.011


def test_quality_of_repeated_ids_and_long_texts(spark):
    rows = docs(spark, [(i, "good words here" if i % 2 else "$$$ ###") for i in range(40)] * 2 + [(50, LONG), (None, "x")])
    labels = spark.createDataFrame([(i, i % 2) for i in range(40)] * 2, "doc_id long, quality int")
    got = quality.quality_scores(rows, labels).collect()
    assert len(got) == 82 and all(0 <= r.score <= 1 for r in got)
    assert all(len({r.score for r in got if r.doc_id == i}) == 1 for i in range(40))


# fingerprints


def test_fingerprints_of_repeated_and_null_ids(spark):
    rows = [(None, "n n n"), (20, "a b c"), (20, "a b c"), (40, LONG), (60, None)]
    got = simhash.document_fingerprints(docs(spark, rows)).collect()
    assert Counter(r.doc_id for r in got) == Counter(i for i, _ in rows)
    assert {r.fingerprint for r in got if r.doc_id == 20} == {simhash.fingerprint("a b c").hex()}
    assert {r.n_chars for r in got if r.doc_id == 40} == {len(LONG)}


# pipeline


def odd_table(spark):
    """Nulls, repeated rows, copies, a long text, a shared passage and an extra column with a clashing name."""
    r = random.Random(14)
    words = ["the", "and", "of", "river", "stone", "house", "green", "walk", "under", "long", "night", "bread"]
    prose = [" ".join(r.choice(words) + r.choice(["", "s", "ed"]) for _ in range(r.randrange(60, 120))) for _ in range(24)]
    passage = " ".join(f"shared{i}" for i in range(60))
    rows = list(enumerate(prose)) + [(100 + i, f"{prose[i]} {passage}") for i in range(2)] + [(200, prose[5]), (5, prose[5]), (None, prose[6]), (None, None), (300, ""), (301, "12 34"), (302, " ".join(prose) * 20)]
    return docs(spark, rows)


def test_pipeline_of_odd_and_empty_tables(spark, sf):
    for d in (odd_table(spark), odd_table(spark).limit(0)):
        columns, empty = d.columns, d.isEmpty()
        for name, stage in corpus_pipeline.STAGES[:-1]:
            d = cut(stage(spark, d, sf), name)
            assert d.columns == columns and d.where("score <> 'mine'").count() == 0
        packed = corpus_pipeline.STAGES[-1][1](spark, d, sf)
        assert packed.isEmpty() == empty


def test_pipeline_by_brute_force(spark, sf):
    """Every stage of the chain against a plain version on that stage's own input."""
    from test_texts import by_hand, classes_by_hand

    stages = dict(corpus_pipeline.STAGES)
    d = spark.read.parquet(f"{sf}/documents.parquet")
    rows = d.collect()
    taught = [r for r in rows if r.lang and r.text and zlib.crc32(str(r.doc_id).encode()) % 4 != 2]
    profiles = {}
    for lang in sorted({r.lang for r in taught}):
        counts = Counter(c for r in taught if r.lang == lang for c in langid.ngram_codes(r.text).tolist())
        profiles[lang] = sorted(counts, key=lambda c: (-counts[c], c))[: langid.PROFILE_SIZE]
    d = cut(stages["language_id"](spark, d, sf), "t")
    found = {r.doc_id: nearest_by_hand(profiles, r.text) for r in rows}
    assert {r.doc_id for r in d.collect()} == {i for i, (g, s) in found.items() if g != "und" and s >= langid.MIN_SCORE}

    rows = sorted(d.collect())
    classes = classes_by_hand([r.text for r in rows])
    d = cut(stages["near_dedup"](spark, d, sf), "t")
    assert {r.doc_id for r in d.collect()} == {rows[c].doc_id for c in classes}

    rows = sorted(d.collect())
    want = {r.doc_id: h for r, h in zip(rows, by_hand([r.text for r in rows]))}
    d = cut(stages["substring_dedup"](spark, d, sf), "t")
    before = {r.doc_id: r.text for r in rows}
    for r in d.collect():
        text = r.text if want[r.doc_id][1] else " ".join(w.decode() for w in (before[r.doc_id] or "").encode().split())
        assert hashlib.sha256(text.encode()).hexdigest() == want[r.doc_id][2]

    mixed = mixing.mix(d, mixing.domains_of(spark.read.parquet(f"{sf}/labels.parquet")))
    copies = {r.doc_id: r.copies for r in mixed.collect()}
    d = cut(stages["mixing"](spark, d, sf), "t")
    assert Counter(r.doc_id for r in d.collect()) == Counter({i: n for i, n in copies.items() if n})

    rows = d.collect()
    packed = stages["packing"](spark, d, sf).collect()
    assert Counter(r.ids_crc32 for r in packed) == Counter(zlib.crc32(ids[p : p + 4096].tobytes()) for r in rows for ids in [ids_of(r.text)] for p in range(0, len(ids), 4096))
    assert len({r.sequence_id for r in packed}) >= sum(r.length for r in packed) / 4096
    again = corpus_pipeline.run(spark, sf).collect()
    assert Counter((r.doc_id, r.piece, r.ids_crc32) for r in again) == Counter((r.doc_id, r.piece, r.ids_crc32) for r in packed)
