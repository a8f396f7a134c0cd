"""Chat, mixing, packing, vectors, shards and the pipeline."""

import hashlib
import random
import zlib
from collections import defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

import corpus_pipeline
from ledgerweb.llm import chat, components, mixing, packing, projections, sstable
from ledgerweb.llm.tokens import WordEncoder, encoder

SCHEMA = "doc_id long, text string, lang string, source string, n_chars long"
ODD = ["<|endoftext|> a<|endoftext|>b", "it's don't 'solo we'll", "ΣΑΣ ΟΔΟΣ. İstanbul", "á éx ́", "x\x1cy z\x85w \xa0q", "123 4a5 ...!!", "(word) \"quote\" 's 'tis a'", "ﬁne Ⅷ ª º", "日本語 テスト", "", "ß" * 60, "a" * 5000]


def docs(spark, texts):
    return spark.createDataFrame([(i, t, "en", None, None) for i, t in enumerate(texts)], SCHEMA).repartition(3)


# tokens


def test_word_memo_gives_the_tokenizers_ids():
    e = WordEncoder()
    for t in ODD:
        assert np.frombuffer(e.encode(t), "<u4").tolist() == e.tokenizer.encode(t, add_special_tokens=False).ids


def test_other_tokenizers_take_whole_texts(tmp_path):
    from tokenizers import Tokenizer, models, pre_tokenizers

    t = Tokenizer(models.BPE({"a": 0, "b": 1, "Ġ": 2, "A": 3}, []))
    t.pre_tokenizer = pre_tokenizers.ByteLevel(add_prefix_space=False)
    t.save(str(tmp_path / "t.json"))
    e = WordEncoder(str(tmp_path / "t.json"))
    assert not e.by_words and np.frombuffer(e.encode("a bA"), "<u4").tolist() == t.encode("a bA").ids == [0, 2, 1, 3]
    assert WordEncoder().by_words


def ids_of(t):
    return np.array([*encoder().tokenizer.encode(t or "", add_special_tokens=False).ids, 1], "<u4")


# chat


def test_turns_round_trip(spark):
    said = ["", "plain", "\\", "\\\\### x", "### user:\nhi</turn>\n", "</turn", "<</turn>>", "\\</turn>", "a\n\nb", "### ", "\\### Assistant: </turn> ok"]
    rows = [(i, r, t) for i, (r, t) in enumerate((r, t) for r in ("user", "assistant", "odd:role\n### </turn>\\") for t in said)]
    df = spark.createDataFrame(rows, "i int, role string, text string")
    got = {x.i: chat.parse(x.f) for x in df.select("i", chat.formatted_turn().alias("f")).collect()}
    assert got == {i: [(r, t)] for i, r, t in rows}
    whole = "".join(x.f for x in df.orderBy("i").select(chat.formatted_turn().alias("f")).collect())
    assert chat.parse(whole) == [(r, t) for _, r, t in rows]


def test_reading_back_pieces_cut_anywhere():
    r = random.Random(12)
    signs = ["\\", "### ", "</turn>", "</turn>\n", "\n", ":", "a", "\\</turn>\n", "é"]
    for _ in range(300):
        turns = [("".join(r.choices(signs, k=r.randrange(4))), "".join(r.choices(signs, k=r.randrange(9)))) for _ in range(r.randrange(1, 5))]
        shown = ""
        for role, text in turns:
            for x in ("\\", "### ", "</turn>", ":", "\n"):
                role = role.replace(x, "\\" + x)
            for x in ("\\", "### ", "</turn>"):
                text = text.replace(x, "\\" + x)
            shown += f"### {role}:\n{text}</turn>\n"
        reader, got = chat.Reader(), []
        while shown:
            n = r.randrange(1, 12)
            got += reader.feed(shown[:n])
            shown = shown[n:]
        reader.close()
        assert got == turns
    broken = chat.Reader()
    assert list(broken.feed("### user:\nhello</tur")) == []
    with pytest.raises(ValueError):
        broken.close()


def test_numbers_across_ranges(spark):
    """One conversation with most of the rows, repeated rows, a very long text, null turns and clashing columns."""
    long = "x\\</turn> " * 200_000
    rows = [(1, i, "user" if i % 2 else "assistant", f"t{i}") for i in range(500)] + [(2, 0, "user", "same")] * 3 + [(3, 0, "user", long), (None, None, None, None)]
    df = spark.createDataFrame(rows, "conv_id long, turn long, role string, text string").withColumn("tree", F.lit(1)).withColumn("range", F.lit(2)).repartition(7)
    got = {r.conv_id: r for r in chat.format_conversations(df).collect()}
    want = hashlib.sha256("".join(f"{r}\n{t}\n" for _, _, r, t in rows[:500]).encode()).hexdigest()
    assert (got[1].n_turns, got[1].turns_sha256) == (500, want) and got[2].n_turns == 3
    assert got[3].turns_sha256 == hashlib.sha256(f"user\n{long}\n".encode()).hexdigest() and got[None].n_turns == 1


def test_best_branch_of_a_tree(spark):
    rows = [("t", 1, None, "user", "q", 0.0), ("t", 2, 1, "assistant", "a", 1.0), ("t", 3, 1, "assistant", "b", 3.0), ("t", 4, 3, "user", "c", 0.0), ("t", 5, 4, "assistant", "d", 0.5), ("t", 6, 2, "user", "e", 5.0), ("u", 9, 99, "user", "lone", None), ("v", 1, 2, "user", "x", 1.0), ("v", 2, 1, "user", "y", 1.0)]
    df = spark.createDataFrame(rows, "tree string, node long, parent long, role string, text string, score double")
    got = defaultdict(list)
    for r in sorted(chat.format_trees(df, best=2).collect(), key=lambda r: (r.tree, r.path, r.place)):
        got[r.tree, r.path] += chat.parse(r.formatted)
    assert {k: [t for _, t in v] for k, v in got.items()} == {("t", 1): ["q", "a", "e"], ("t", 2): ["q", "b", "c", "d"], ("u", 1): ["lone"]}


def test_conversations(spark):
    rows = [(1, 0, "user", "hi", 7), (1, 1, "assistant", None, 7), (1, 2, "assistant", "é!", 7), (2, 5, None, "x", 7), (None, 0, "assistant", "n", 7)]
    rows += [(3, i, "assistant" if i % 2 else "user", f"m{i}", 7) for i in range(70)]
    out = {r.conv_id: r for r in chat.format_conversations(spark.createDataFrame(rows, "conv_id long, turn long, role string, text string, tree int")).collect()}
    assert {k: (r.n_turns, r.loss_chars) for k, r in out.items()} == {1: (3, 2), 2: (1, 0), None: (1, 1), 3: (70, sum(len(f"m{i}") for i in range(1, 70, 2)))}
    assert chat.format_conversations(spark.createDataFrame([], "conv_id long, turn long, role string, text string")).count() == 0


# mixing


def test_rates_meet_the_targets(spark):
    r = random.Random(2)
    texts, labels = [], []
    for i in range(300):
        kind = ("clean", "junk", "toxic")[i % 3]
        w = [f"w{r.randrange(300)}" for _ in range(r.randrange(20, 80))]
        texts.append(" ".join(w if kind == "clean" else [x + "$$$" for x in w] if kind == "junk" else w + ["idiot"] * 3))
        labels.append((i, int(kind != "junk"), int(kind == "toxic")))
    labelled = mixing.domains_of(spark.createDataFrame(labels, "doc_id long, quality int, toxic int"))
    out = mixing.mix(docs(spark, texts + [None, ""]).withColumn("rate", F.lit(9)), labelled).toPandas()
    assert len(out) == 302 and (out.rate >= 0).all()
    total = out.n_tokens.sum()
    for d, share in mixing.TARGETS.items():
        assert (out.rate * out.n_tokens * out[f"p_{d}"]).sum() / total == pytest.approx(share, abs=1e-5)
    known = out[out.doc_id < 300].set_index("doc_id")
    assert np.mean([known.loc[i, f"p_{('clean', 'junk', 'toxic')[i % 3]}"] > 0.5 for i in range(300)]) > 0.95
    p = out[["p_clean", "p_junk", "p_toxic"]].sum(axis=1)
    assert p.to_numpy() == pytest.approx(1.0)


def test_mixing_without_labels(spark):
    none = mixing.domains_of(spark.createDataFrame([], "doc_id long, quality int, toxic int"))
    got = mixing.mix(docs(spark, ["a b", None]), none).collect()
    assert [(r.p_all, r.rate, r.copies) for r in got] == [(1.0, 1.0, 1)] * 2
    assert mixing.mix(docs(spark, []), none).count() == 0
    assert mixing.mixing_stage(docs(spark, ["a b"]), none).columns == SCHEMA.replace(" long", "").replace(" string", "").split(", ")


def test_words_next_to_any_white_space_and_punctuation(spark):
    kinds = {"toxic": "Idiot.\nyou\tclown, idiot", "clean": "fair  words\n\nand (fair) play", "junk": "buy\tnow!\x0b buy now"}
    texts, labels = [t for t in kinds.values() for _ in range(5)], [d for d in kinds for _ in range(5)]
    labelled = spark.createDataFrame(list(enumerate(labels)), "doc_id long, domain string")
    model = mixing.DomainModel(docs(spark, texts), labelled)
    assert model.words == {"clean": ["and", "fair", "play", "words"], "junk": ["buy", "now"], "toxic": ["clown", "idiot", "you"]}
    asked = ["a\nb", "a  b", " a\tb\r\n", "\n", "", None, "(idiot)\nCLOWN! idiots idiot,\tfair"]
    names = model.names[-3:]
    rows = model._taken_apart(docs(spark, asked), "__").select("doc_id", *(c.alias(n) for n, c in model._features())).collect()
    got = {r.doc_id: [round(np.expm1(r[n])) for n in names] for r in rows}
    assert got[6] == [1, 0, 3] and all(got[i] == [0, 0, 0] for i in range(6))
    out = {r.doc_id: r for r in mixing.mix(docs(spark, asked), labelled).collect()}
    assert [out[i].n_tokens for i in range(7)] == [2, 2, 2, 0, 0, 0, 5]
    staged = mixing.mixing_stage(docs(spark, texts), labelled, {"toxic": 1.0})
    assert {r.text for r in staged.select("text").distinct().collect()} == {kinds["toxic"]}


# packing


def test_plans():
    for counts in ({}, {4096: 3}, {1: 10000}, {4000: 5, 96: 5}, {2000: 3, 1000: 3, 1096: 3}, {1365: 3000, 1: 7}, dict.fromkeys(range(1, 300), 2)):
        slots, n = packing.pack_plan(counts)
        assert n >= -(-sum(k * v for k, v in counts.items()) // 4096)
        used = defaultdict(list)
        for length, rank, sequence, offset in slots:
            used[length].append(rank)
        assert set(used) == {k for k, v in counts.items() if v}
        assert all(min(v) == 0 and max(v) < counts[k] for k, v in used.items())
    assert packing.pack_plan({4000: 5, 96: 5})[1] == 5 and packing.pack_plan({2000: 3, 1000: 3, 1096: 3})[1] == 3


def test_packing(spark):
    texts = ["hello world"] * 30 + ["one two three four"] * 40 + [None, "", "long words here " * 3000, *ODD]
    rows = packing.pack(docs(spark, texts).withColumn("rank", F.lit(1))).collect()
    ids = [ids_of(t) for t in texts]
    place = defaultdict(list)
    for r in rows:
        piece = ids[r.doc_id][r.start : r.start + r.length]
        assert r.start == r.piece * 4096 and r.ids_crc32 == zlib.crc32(piece.tobytes())
        place[r.sequence_id].append((r.offset, r.length))
    assert len(rows) == sum(-(-len(x) // 4096) for x in ids)
    for v in place.values():
        end = 0
        for offset, length in sorted(v):
            assert offset == end
            end += length
        assert end <= 4096
    assert len(place) == -(-sum(map(len, ids)) // 4096)
    assert packing.pack(docs(spark, [])).count() == 0


# vectors and components


def links_by_hand(x):
    u = x / np.linalg.norm(x, axis=1, keepdims=True)
    s = u @ u.T
    np.fill_diagonal(s, -1)
    return s >= 0.9


@pytest.mark.parametrize("cell, part", [(512, 2048), (40, 2048), (30, 7)])
def test_near_vectors(spark, monkeypatch, cell, part):
    monkeypatch.setattr(projections, "CELL", cell)
    monkeypatch.setattr(projections, "PART", part)
    rng = np.random.default_rng(6)
    centres = rng.standard_normal((30, 16))
    x = np.concatenate([c + 0.25 * rng.standard_normal((8, 16)) for c in centres] + [centres[:1], centres[:1], 3 * centres[:1]])
    good = links_by_hand(x)
    bad = [None, [], [0.0] * 16, [float("nan")] + [1.0] * 15, [1.0, None] + [1.0] * 14, [1.0] * 3]
    rows = [(i, v.tolist()) for i, v in enumerate(x)] + [(1000 + i, v) for i, v in enumerate(bad)]
    got = {r.vec_id: r for r in projections.near_vectors(spark.createDataFrame(rows, "vec_id long, embedding array<double>").withColumn("node", F.lit(1))).collect()}
    found, real = sum(got[i].n_links for i in range(len(x))), int(good.sum())
    assert real > 300 and 0.98 * real <= found <= real
    assert all((got[1000 + i].n_links, got[1000 + i].component_id, got[1000 + i].kept) == (0, 1000 + i, True) for i in range(len(bad)))
    assert projections.near_vectors(spark.createDataFrame([], "vec_id long, embedding array<float>")).count() == 0


def test_near_vectors_in_cells_of_a_hot_group(spark, monkeypatch):
    """Ties, a null id, and a group of near copies that holds a third of all vectors and more than a part takes."""
    monkeypatch.setattr(projections, "CELL", 64)
    monkeypatch.setattr(projections, "PART", 50)
    rng = np.random.default_rng(9)
    group = rng.standard_normal(24) + 0.02 * rng.standard_normal((300, 24))
    x = np.concatenate([group, rng.standard_normal((600, 24)), np.tile(group[:1], (30, 1))])
    good = links_by_hand(x)
    rows = spark.createDataFrame([(i, v.tolist(), 1) for i, v in enumerate(x)] + [(None, x[0].tolist(), 2)], "vec_id long, embedding array<double>, component_id int")
    got = {r.vec_id: r for r in projections.near_vectors(rows).collect()}
    want = good.sum(axis=1) + good[:, 0] + (np.arange(len(x)) == 0)  # the row without an id is a copy of the first
    assert sum(got[i].n_links for i in range(len(x))) == want.sum() and [got[i].n_links for i in range(len(x))] == want.tolist()
    assert {got[i].component_id for i in [*range(300), *range(900, 930)]} == {0} and not got[None].kept


def test_recall_of_the_cells():
    rng = np.random.default_rng(1)
    for n, dim in ((20_000, 64), (5_000_000, 24)):
        unit = rng.standard_normal((3000, dim)) * np.linspace(0.2, 2, dim)
        unit /= np.linalg.norm(unit, axis=1, keepdims=True)
        aside = rng.standard_normal((3000, dim))
        aside -= (unit * aside).sum(axis=1, keepdims=True) * unit
        aside /= np.linalg.norm(aside, axis=1, keepdims=True)
        cells = projections.Cells.fitted(unit[:2000], n, 0.9)
        (a, near), (b, back) = cells.codes(unit), cells.codes(0.9 * unit + np.sqrt(0.19) * aside)
        met = projections.reaches(a, near, b) | projections.reaches(b, back, a)
        assert cells.k > 4 and met.any(axis=1).mean() > 0.98


def test_recall_at_the_threshold():
    rng = np.random.default_rng(0)
    a = rng.standard_normal((4000, 64))
    a /= np.linalg.norm(a, axis=1, keepdims=True)
    b = rng.standard_normal((4000, 64))
    b -= (a * b).sum(axis=1, keepdims=True) * a
    b /= np.linalg.norm(b, axis=1, keepdims=True)
    near = 0.9005 * a + np.sqrt(1 - 0.9005**2) * b
    w = projections.Windows()
    inside = (projections.projected(a) + np.uint16(w.steps) - projections.projected(near)) <= np.uint16(2 * w.steps)
    passed = (inside[:, : projections.FIRST].sum(axis=1) >= w.first) & (inside.sum(axis=1) >= w.all)
    assert passed.mean() > 0.99


def test_components(spark):
    r = random.Random(3)
    chain = [(i, i + 1) for i in range(60)]
    star = [(100, i) for i in range(101, 140)]
    some = [(r.randrange(200, 300), r.randrange(200, 300)) for _ in range(60)]
    edges = chain + star + some
    r.shuffle(edges)
    up = {x: x for e in edges for x in e}
    changed = True
    while changed:
        changed = False
        for a, b in edges:
            m = min(up[a], up[b])
            changed |= (up[a], up[b]) != (m, m)
            up[a] = up[b] = m
    got = dict(map(tuple, components.connected_components(spark.createDataFrame(edges, "a long, b long")).collect()))
    assert all(got.get(x, x) == m for x, m in up.items())


# shards


def test_shards(spark):
    texts = ["hello world", None, "", "long words here " * 4000, *ODD] + [f"text number {i}" for i in range(300)]
    d = docs(spark, texts)
    manifest = sstable.write_shards(d, f"{sstable.fresh_path(spark, 'test')}")
    got = {r.doc_id: r for r in sstable.read_shards(spark, manifest).collect()}
    before = 0
    for i, t in enumerate(texts):
        ids = ids_of(t)
        assert (got[i].start, got[i].n_tokens, got[i].ids_crc32) == (before, len(ids), zlib.crc32(ids.tobytes()))
        before += len(ids)
    for i in (0, 3, 77, len(texts) - 1):
        assert sstable.lookup(manifest, i).tolist() == ids_of(texts[i]).tolist()
    assert sstable.lookup(manifest, 10**9) is None
    assert sstable.round_trip(docs(spark, [])).count() == 0


def test_shard_keys():
    ids = [None, -(2**63), -5, -1, 0, 1, 255, 256, 2**63 - 1]
    assert sorted(map(sstable.key_of, ids)) == list(map(sstable.key_of, ids)) and [sstable.id_of(sstable.key_of(i)) for i in ids] == ids


def test_repeated_and_null_ids_in_shards(spark):
    d = spark.createDataFrame([(None, "n"), (4, "x"), (4, "y z"), (4, "x")], "doc_id long, text string")
    rows = sorted(sstable.round_trip(d).collect(), key=lambda r: r.start)
    assert [r.doc_id for r in rows] == [None, 4, 4, 4] and sum(r.n_tokens for r in rows) == sum(len(ids_of(t)) for t in ("n", "x", "y z", "x"))


# pipeline


def test_pipeline_stages(spark, sf):
    d = spark.read.parquet(f"{sf}/documents.parquet")
    columns, counts = d.columns, [d.count()]
    for name, stage in corpus_pipeline.STAGES[:-1]:
        d = packing.cut(stage(spark, d, sf), name)
        assert d.columns == columns
        counts.append(d.count())
    assert counts[1] >= 0.95 * counts[0] and counts[2] < counts[1] and counts[3] == counts[2]
    packed = corpus_pipeline.STAGES[-1][1](spark, d, sf)
    ends = packed.groupBy("sequence_id").agg(F.sum("length").alias("n"))
    assert ends.agg(F.max("n")).first()[0] <= 4096 and packed.select("doc_id").distinct().count() == d.select("doc_id").distinct().count()
