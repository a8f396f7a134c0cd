"""Similarity of vectors, sets and buckets."""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyarrow import dataset
from pyarrow import fs as pafs
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from ..session import cut

#: Vectors of one block; a task holds two blocks.
BLOCK_ROWS = 2048
#: Smallest sizes of the buckets above the lowest.
MONEY_BUCKETS, STAFF_BUCKETS = (1e8, 1e9, 1e10), (100, 1000, 10000)
SIZE_METRICS = ("revenue", "market_cap", "employees")


def valid_embedding(embedding: Column, dim: int) -> Column:
    """Exactly ``dim`` finite components; the zero vector is valid."""
    finite = F.forall(embedding, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < float("inf")))
    return F.coalesce((F.size(embedding) == dim) & finite, F.lit(False))


def valid_score(score: Column) -> Column:
    return F.coalesce(score.between(-1, 1) & ~F.isnan(score), F.lit(False))


def cosine(a: Column, b: Column) -> Column:
    """Of two arrays; 0 where a norm is 0 or the lengths differ."""
    def dot(x: Column, y: Column) -> Column:
        return F.aggregate(F.zip_with(x, y, lambda p, q: p.cast("double") * q.cast("double")), F.lit(0.0), lambda s, v: s + v)

    norms = F.sqrt(dot(a, a)) * F.sqrt(dot(b, b))
    return F.when((F.size(a) == F.size(b)) & (norms > 0), dot(a, b) / norms).otherwise(0.0)


def rounded(score: Column | str, digits: int = 6) -> Column:
    """To ``digits``, half away from zero, of the double itself: scores have 9 digits, and Spark would round their decimal text again."""
    s, scale = F.col(score) if isinstance(score, str) else score, 10.0**digits
    return F.signum(s) * F.floor(F.abs(s) * scale + 0.5) / scale


def _bundled(rows: DataFrame, count: int) -> DataFrame:
    """block, keys, dim, x: unit vectors of ``rows(key, e)`` in blocks of about ``BLOCK_ROWS``."""
    kind = rows.schema["key"].dataType.simpleString()

    def bundle(table: pa.Table) -> pa.Table:
        x = np.array(table.column("e").to_pylist(), np.float64)
        norm = np.linalg.norm(x, axis=1, keepdims=True)
        x = x / np.where(norm == 0, 1, norm)
        return pa.table([pa.array([table.column("block")[0].as_py()], pa.int32()), pa.array([table.column("key").to_pylist()], pa.list_(table.schema.field("key").type)), pa.array([x.shape[1]], pa.int32()), pa.array([x.tobytes()], pa.binary())], names=["block", "keys", "dim", "x"])

    placed = rows.withColumn("block", F.pmod(F.xxhash64("key"), F.lit(max(1, -(-count // BLOCK_ROWS)))).cast("int"))
    return placed.groupBy("block").applyInArrow(bundle, f"block int, keys array<{kind}>, dim int, x binary")


def top_k_similar_pairs(vectors: DataFrame, threshold: float = 0.7, top_k: int = 50, key: str = "key", embedding: str = "embedding", of: DataFrame | None = None) -> DataFrame:
    """key1 < key2, score: pairs that are in the top k of either side and reach the threshold.

    Vectors are packed into blocks and written once to the shared folder.  A task takes a block and
    reads all blocks from there, one at a time, keeping the best k of each of its vectors: what is
    written and shuffled grows with the vectors, only the comparisons with their square.  Zero vectors
    have cosine 0; null ones drop out.  With ``of(key)`` only the lists of those vectors are made.
    """
    kind = vectors.schema[key].dataType.simpleString()
    rows = vectors.select(F.col(key).alias("key"), F.col(embedding).cast("array<double>").alias("e")).where("key IS NOT NULL AND e IS NOT NULL AND size(e) > 0")
    blocks = cut(_bundled(rows, rows.count()), "blocks")
    asked = blocks
    if of is not None:
        rows = cut(rows.join(of.select("key").distinct(), "key", "left_semi"), "asked")
        asked = _bundled(rows, rows.count())
    uri = blocks._cut_path

    def best(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = pafs.FileSystem.from_uri(uri)
        for batch in batches:
            for one in batch.to_pylist():
                a = np.frombuffer(one["x"], np.float64).reshape(-1, one["dim"])
                keys, field = np.array(one["keys"]), batch.schema.field("keys").type.value_type
                i, found, s = np.zeros(0, np.int64), keys[:0], np.zeros(0)
                least = np.full(len(keys), threshold)
                for other in dataset.dataset(path, filesystem=store, format="parquet").to_batches(batch_size=1, batch_readahead=1, fragment_readahead=1):
                    for two in other.to_pylist():
                        b, keys2 = np.frombuffer(two["x"], np.float64).reshape(-1, two["dim"]), np.array(two["keys"])
                        score = np.round(a @ b.T, 9)
                        x, y = np.nonzero(score >= least[:, None])
                        x, y = (z[keys[x] != keys2[y]] for z in (x, y))
                        i, found, s = np.concatenate([i, x]), np.concatenate([found, keys2[y]]), np.concatenate([s, score[x, y]])
                        order = np.lexsort((found, -s, i))
                        place = np.arange(len(i)) - np.searchsorted(i[order], i[order], side="left")
                        order = order[place < top_k]
                        i, found, s = i[order], found[order], s[order]
                        full = np.flatnonzero(np.bincount(i, minlength=len(keys)) == top_k)
                        least[full] = s[np.searchsorted(i, full, side="right") - 1]
                yield pa.RecordBatch.from_arrays([pa.array(keys[i].tolist(), field), pa.array(found.tolist(), field), pa.array(s)], names=["a", "b", "score"])

    # a number of its own, or adaptive execution makes one task of a few blocks
    tasks = max(1, -(-rows.count() // BLOCK_ROWS))
    kept = asked.repartition(tasks).mapInArrow(best, f"a {kind}, b {kind}, score double")
    return kept.groupBy(F.least("a", "b").alias("key1"), F.greatest("a", "b").alias("key2")).agg(F.max("score").alias("score"))


def similar_pairs_around(vectors: DataFrame, around: object, threshold: float = 0.7, top_k: int = 50, key: str = "key", embedding: str = "embedding") -> DataFrame:
    """As ``top_k_similar_pairs``, but only the pairs of one node: its own list, and those of vectors alike enough to have it in theirs."""
    one = vectors.where(F.col(key) == around).select(F.col(embedding).cast("array<double>").alias("__one")).where("__one IS NOT NULL")
    alike = vectors.join(one, cosine(F.col(embedding), F.col("__one")) >= threshold - 1e-6)
    of = alike.select(F.col(key).alias("key")).unionByName(vectors.where(F.col(key) == around).select(F.col(key).alias("key")))
    return top_k_similar_pairs(vectors, threshold, top_k, key, embedding, of).where((F.col("key1") == around) | (F.col("key2") == around))


def similar_nodes(nodes: DataFrame, threshold: float, top_k: int, text: str | None = None, least_chars: int = 0, key: str = "key", embedding: str = "embedding") -> DataFrame:
    """As ``top_k_similar_pairs`` for nodes of any kind; with ``text`` only those whose text has ``least_chars`` characters."""
    kept = nodes.where(F.length(text) >= least_chars) if text else nodes
    return top_k_similar_pairs(kept, threshold, top_k, key, embedding)


#: From this Jaccard on, sets meet on their rarest items only.
RARE_FROM = 0.5


def _pairs(left: DataFrame, key: str, around: object | None) -> DataFrame:
    """a < b of rows ``left(n, <key>)`` that share the key; with ``around`` only pairs of that node, joined from its side."""
    x, y = left.withColumnRenamed("n", "a"), left.withColumnRenamed("n", "b")
    if around is None:
        return x.join(y, key).where("a < b")
    met = x.where(F.col("a") == around).join(y, key).where("a <> b")
    return met.select(*(c for c in met.columns if c not in ("a", "b")), F.least("a", "b").alias("a"), F.greatest("a", "b").alias("b"))


def set_jaccard_pairs(members: DataFrame, node: str, item: str, least: float = 0.0, around: object | None = None) -> DataFrame:
    """a < b, shared, score for all pairs of nodes with a common item and a score of at least ``least``.

    One equi-join on the item; the pairs' counts combine on the map side.  With a high ``least`` two
    sets of n items share one of the n - ceil(least n) + 1 rarest of each, so only those are joined
    and an item that all have makes no pairs; candidates are then compared whole.
    """
    m = members.select(F.col(node).alias("n"), F.col(item).alias("i")).distinct()
    jaccard = F.col("shared") / (F.col("sa") + F.col("sb") - F.col("shared"))
    if least >= RARE_FROM:
        often = m.groupBy("i").agg(F.count("*").alias("__often"))
        each = m.join(often, "i").withColumn("size", F.count("*").over(Window.partitionBy("n"))).withColumn("r", F.row_number().over(Window.partitionBy("n").orderBy("__often", "i")))
        rare = each.where(F.col("r") <= F.col("size") - F.ceil(F.round(F.lit(least) * F.col("size"), 9)) + 1).select("n", "i")
        met = _pairs(rare, "i", around).select("a", "b").distinct()
        sets = m.groupBy("n").agg(F.collect_set("i").alias("s"))
        both = met.join(sets.select(F.col("n").alias("a"), F.col("s").alias("x")), "a").join(sets.select(F.col("n").alias("b"), F.col("s").alias("y")), "b")
        sized = both.select("a", "b", F.size(F.array_intersect("x", "y")).cast("long").alias("shared"), F.size("x").alias("sa"), F.size("y").alias("sb"))
    else:
        size = m.groupBy("n").agg(F.count("*").alias("size"))
        shared = _pairs(m, "i", around).groupBy("a", "b").agg(F.count("*").alias("shared"))
        sized = shared.join(size.select(F.col("n").alias("a"), F.col("size").alias("sa")), "a").join(size.select(F.col("n").alias("b"), F.col("size").alias("sb")), "b")
    out = sized.select("a", "b", "shared", jaccard.alias("score"))
    return out.where(F.col("score") >= least) if least > 0 else out


#: Sets of one block of ``set_matches``; a task holds one block and one batch of asked sets.
SET_ROWS = 8192


def set_matches(asked: DataFrame, known: DataFrame, least: float, top_k: int | None = None) -> DataFrame:
    """a, b, score: of each set of ``asked(n, items)`` the sets of ``known(n, items)`` of another n that share an item and have a Jaccard of at least ``least``.

    With ``top_k`` only the best of each, by score to 9 digits and then n.  Blocks of known sets are
    written once to the shared folder and read one at a time; what is shared is counted in them item
    by item, so candidates are never rows and what is shuffled grows with the sets and the result.
    """
    spark, kind = asked.sparkSession, asked.schema["n"].dataType.simpleString()
    asked = cut(asked.where("n IS NOT NULL AND size(items) > 0"), "asked")
    known = known.where("n IS NOT NULL AND size(items) > 0")
    count = max(1, -(-known.count() // SET_ROWS))
    placed = known.withColumn("block", F.pmod(F.xxhash64("n"), F.lit(count)).cast("int"))
    blocks = cut(placed.groupBy("block").agg(F.collect_list(F.struct("n", "items")).alias("sets")), "sets")
    uri, field = blocks._cut_path, {"bigint": pa.int64(), "int": pa.int32()}.get(kind, pa.string())

    def match(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        store, path = pafs.FileSystem.from_uri(uri)
        for batch in batches:
            rows = batch.to_pylist()
            kept = [(np.zeros(0, field.to_pandas_dtype()), np.zeros(0))] * len(rows)
            bound = np.full(len(rows), least)
            for other in dataset.dataset(path, filesystem=store, format="parquet").to_batches(batch_size=1, batch_readahead=1, fragment_readahead=1):
                for sets in other.column("sets").to_pylist():
                    keys, sizes, places = np.array([x["n"] for x in sets]), np.array([len(x["items"]) for x in sets]), {}
                    for at, x in enumerate(sets):
                        for item in x["items"]:
                            places.setdefault(item, []).append(at)
                    places = {item: np.array(x, np.int32) for item, x in places.items()}
                    for i, row in enumerate(rows):
                        hits = [places[item] for item in row["items"] if item in places]
                        if not hits:
                            continue
                        shared = np.bincount(np.concatenate(hits), minlength=len(keys))
                        score = shared / (sizes + len(row["items"]) - shared)
                        at = np.flatnonzero((score >= bound[i]) & (shared > 0))
                        at = at[keys[at] != row["n"]]
                        if not len(at):
                            continue
                        b, s = np.concatenate([kept[i][0], keys[at]]) if len(kept[i][0]) else keys[at], np.concatenate([kept[i][1], score[at]])
                        if top_k and len(s) >= top_k:
                            best = np.lexsort((b, -np.round(s, 9)))[:top_k]
                            b, s = b[best], s[best]
                            bound[i] = max(least, s[-1] - 1e-9)
                        kept[i] = (b, s)
            for row, (b, s) in zip(rows, kept):
                if len(b):
                    yield pa.RecordBatch.from_arrays([pa.array([row["n"]] * len(b), field), pa.array(b.tolist(), field), pa.array(s)], names=["a", "b", "score"])

    tasks = int(spark.conf.get("spark.sql.shuffle.partitions"))
    return asked.repartition(tasks).mapInArrow(match, f"a {kind}, b {kind}, score double")


def best_by_jaccard(members: DataFrame, node: str, item: str, least: float, top_k: int) -> DataFrame:
    """src, dst, score: each node's best partners by the Jaccard of their items; as ``top_k_of_either_side`` of all pairs, which are not made."""
    sets = cut(members.groupBy(F.col(node).alias("n")).agg(F.collect_set(F.col(item).cast("string")).alias("items")), "members")
    return set_matches(sets, sets, least, top_k).select(F.col("a").alias("src"), F.col("b").alias("dst"), "score")


def jaccard_of(pairs: DataFrame, members: DataFrame, node: str, item: str) -> DataFrame:
    """``pairs(src, dst)`` with score: Jaccard of their sets; pairs with nothing in common go."""
    sets = members.groupBy(F.col(node).alias("n")).agg(F.collect_set(item).alias("s"))
    both = pairs.join(sets.select(F.col("n").alias("src"), F.col("s").alias("x")), "src").join(sets.select(F.col("n").alias("dst"), F.col("s").alias("y")), "dst")
    shared = F.size(F.array_intersect("x", "y"))
    return both.where(shared > 0).select("src", "dst", (shared / (F.size("x") + F.size("y") - shared)).alias("score"))


def top_k_of_either_side(pairs: DataFrame, cutoff: float, top_k: int) -> DataFrame:
    """src, dst, score: each node's best partners, both directions of ``pairs(a, b, score)``."""
    both = pairs.where(F.col("score") >= cutoff).select(F.col("a").alias("src"), F.col("b").alias("dst"), "score")
    both = both.unionByName(both.select(F.col("dst").alias("src"), F.col("src").alias("dst"), "score"))
    rank = Window.partitionBy("src").orderBy(F.desc(F.round("score", 9)), F.asc("dst"))
    return both.withColumn("r", F.row_number().over(rank)).where(F.col("r") <= top_k).drop("r")


#: The column of each classification.
CLASSIFICATIONS = {"SIC": "sic", "NAICS": "naics", "SECTOR": "sector", "INDUSTRY": "industry"}


#: Members of one part of a class; two parts meet in one row and are unfolded there.
PART_ROWS = 2048


def _within(rows: DataFrame, earlier: list[str] | None = None) -> DataFrame:
    """a < b, class of rows of ``rows(n, class, <earlier>)`` with one class and none of the earlier classes in common.

    Members are dealt into parts by all these classes and, within them, by a number that grows with
    the members.  Only pairs of parts are shuffled, into a number of tasks that adaptive execution
    leaves alone; pairs of rows are made where they are used.
    """
    earlier = earlier or []
    group = ["class", *earlier]
    held = rows.where("class IS NOT NULL AND n IS NOT NULL")
    key = held.withColumn("__g", F.struct(*group))  # a null within is equal to a null
    parts = key.groupBy("__g").agg(F.ceil(F.count("*") / PART_ROWS).alias("parts"))
    held = key.join(parts, "__g").withColumn("part", F.pmod(F.xxhash64("n"), F.col("parts"))).groupBy(*group, "part").agg(F.collect_list("n").alias("m"))
    left, right = held.select("class", F.struct(*earlier, "part").alias("p"), F.col("m").alias("left")), held.select("class", F.struct(*earlier, "part").alias("q"), F.col("m").alias("right"))
    met = left.join(right, "class").where("p <= q")
    for e in earlier:
        met = met.where(~F.coalesce(F.col(f"p.{e}") == F.col(f"q.{e}"), F.lit(False)))
    met = met.select("class", F.expr("p = q").alias("same"), "left", "right").repartition(int(rows.sparkSession.conf.get("spark.sql.shuffle.partitions")))
    pairs = met.select("class", "same", F.explode("left").alias("x"), "right").select("class", "same", "x", F.explode("right").alias("y"))
    return pairs.where("x <> y AND (NOT same OR x < y)").select(F.least("x", "y").alias("a"), F.greatest("x", "y").alias("b"), "class")


def _first_class_pairs(rows: DataFrame, classes: list[str]) -> DataFrame:
    """a < b, method, class: pairs of ``rows(n, <classes>)`` and the first of the classes that both share.

    Every pair comes once without being grouped: it is not made where an earlier class has paired it.
    Only where ids repeat with other classes are pairs grouped.
    """
    rows = rows.distinct()
    out = None
    for rank, c in enumerate(classes):
        one = _within(rows.select("n", F.col(c).alias("class"), *classes[:rank]), classes[:rank]).select("a", "b", F.lit(c).alias("method"), "class")
        out = one if out is None else out.unionByName(one)
    if rows.groupBy("n").count().where("count > 1").isEmpty():
        return out
    rank = F.array_position(F.array(*map(F.lit, classes)), F.col("method"))
    return out.groupBy("a", "b").agg(F.min(F.struct(rank.alias("rank"), "method", "class")).alias("s")).select("a", "b", "s.method", "s.class")


def industry_pairs(companies: DataFrame, method: str = "SIC") -> DataFrame:
    """a < b, method, classification, score 1: companies of one class by ``method``; blank and zero classes are none."""
    column = CLASSIFICATIONS[method]
    if column not in companies.columns:
        return companies.select(F.col("cik").alias("a"), F.col("cik").alias("b"), F.lit(method).alias("method"), F.lit("").alias("classification"), F.lit(1.0).alias("score")).limit(0)
    kept = companies.where(F.col(column).isNotNull() & ~F.col(column).cast("string").isin("", "0"))
    met = _within(kept.select(F.col("cik").alias("n"), F.col(column).cast("string").alias("class")))
    return met.select("a", "b", F.lit(method).alias("method"), F.col("class").alias("classification"), F.lit(1.0).alias("score"))


def same_class_pairs(companies: DataFrame, methods: list[str], around: object | None = None) -> DataFrame:
    """a < b, method: companies of one class; the first method that pairs them wins."""
    if around is None:
        met = _first_class_pairs(companies.select(F.col("cik").alias("n"), *(F.col(m).cast("string").alias(m) for m in methods)), methods)
        return met.select("a", "b", "method")
    out = None
    for rank, m in enumerate(methods):
        c = companies.where(F.col(m).isNotNull()).select(F.col("cik").alias("n"), F.col(m).cast("string").alias("class"))
        one = _pairs(c, "class", around).select("a", "b", F.lit(m).alias("method"), F.lit(rank).alias("rank"))
        out = one if out is None else out.unionByName(one)
    return out.groupBy("a", "b").agg(F.min_by("method", "rank").alias("method"))


def size_bucket(metric: str) -> Column:
    """Half-open buckets 0 to 3; null has none."""
    value = F.col(metric)
    low, mid, high = STAFF_BUCKETS if metric == "employees" else MONEY_BUCKETS
    return F.when(value < low, 0).when(value < mid, 1).when(value < high, 2).when(value.isNotNull(), 3)


#: The metrics of each method; any other name means all of them.
SIZE_METHODS = {"REVENUE": ("revenue",), "MARKET_CAP": ("market_cap",), "EMPLOYEES": ("employees",)}


def size_pairs(companies: DataFrame, method: str = "COMPOSITE", around: object | None = None) -> DataFrame:
    """a < b, method, bucket: companies of one bucket of the first metric that pairs them."""
    metrics = SIZE_METHODS.get(method, SIZE_METRICS)
    buckets = companies.select("cik", *(size_bucket(m).alias(m) for m in metrics))
    if around is None:
        met = _first_class_pairs(buckets.withColumnRenamed("cik", "n"), list(metrics))
        return met.select("a", "b", "method", F.col("class").alias("bucket"))
    out = None
    for rank, m in enumerate(metrics):
        c = buckets.where(F.col(m).isNotNull()).select(F.col("cik").alias("n"), F.col(m).alias("bucket"))
        one = _pairs(c, "bucket", around).select("a", "b", F.struct(F.lit(rank).alias("rank"), F.lit(m).alias("method"), "bucket").alias("s"))
        out = one if out is None else out.unionByName(one)
    return out.groupBy("a", "b").agg(F.min("s").alias("s")).select("a", "b", "s.method", "s.bucket")


def via_domains(has_domain: DataFrame, domain_pairs: DataFrame, least: float) -> DataFrame:
    """src, dst, score, domain_pair_count: companies whose domains are alike, both orders."""
    both = domain_pairs.select("a", "b", "score").unionByName(domain_pairs.select(F.col("b").alias("a"), F.col("a").alias("b"), "score"))
    x = has_domain.select(F.col("src"), F.col("dst").alias("a"))
    y = has_domain.select(F.col("src").alias("to"), F.col("dst").alias("b"))
    met = both.where(F.col("score") >= least).join(x, "a").join(y, "b").where("src <> to")
    return met.groupBy("src", F.col("to").alias("dst")).agg(F.max("score").alias("score"), F.count("*").alias("domain_pair_count"))


def via_alike_sets(has_domain: DataFrame, uses: DataFrame, domain: str, item: str, least: float) -> DataFrame:
    """As ``via_domains`` of the domains whose sets of items have a Jaccard of at least ``least`` > 0.

    Domains of one set are a class; different sets are compared once, and companies are joined to
    the sets with their number of domains, so copies of a set are not compared again.
    """
    held = cut(uses.select(domain, F.col(item).cast("string").alias("i")).distinct().groupBy(domain).agg(F.array_sort(F.collect_list("i")).alias("items")), "held")
    sets = cut(held.groupBy("items").agg(F.min(domain).alias("n")), "sets")  # a set goes by its smallest domain
    owned = has_domain.select("src", F.col("dst").alias(domain)).join(held, domain).join(sets, "items").select("src", domain, "n")
    owned = cut(owned, "owned")
    number = cut(owned.groupBy("src", "n").agg(F.count("*").alias("k")), "number")
    alike = set_matches(sets.select("n", "items"), sets.select("n", "items"), least)
    x, y = number.select("src", F.col("n").alias("a"), F.col("k").alias("k1")), number.select(F.col("src").alias("to"), F.col("n").alias("b"), F.col("k").alias("k2"))
    other = alike.join(x, "a").join(y, "b").where("src <> to").select("src", "to", "score", (F.col("k1") * F.col("k2")).alias("pairs"))
    x, y = owned.select("src", F.col(domain).alias("d"), "n"), owned.select(F.col("src").alias("to"), F.col(domain).alias("e"), "n")
    same = x.join(y, "n").where("src <> to AND d <> e").select("src", "to", F.lit(1.0).alias("score"), F.lit(1).cast("long").alias("pairs"))
    return other.unionByName(same).groupBy("src", F.col("to").alias("dst")).agg(F.max("score").alias("score"), F.sum("pairs").alias("domain_pair_count"))


def weighted_similar(similar: DataFrame, weights: dict[str, float]) -> DataFrame:
    """src, dst, score and a count for each type over undirected pairs ``similar(src, dst, rel_type, score)``.

    A pair stored both ways counts once.
    """
    one = similar.groupBy(F.least("src", "dst").alias("x"), F.greatest("src", "dst").alias("y"), "rel_type").agg(F.max("score").alias("score"))
    both = one.select(F.col("x").alias("src"), F.col("y").alias("dst"), "rel_type", "score").unionByName(one.select(F.col("y").alias("src"), F.col("x").alias("dst"), "rel_type", "score"))
    total = sum((F.when(F.col("rel_type") == t, F.col("score") * w).otherwise(0.0) for t, w in weights.items()), F.lit(0.0))
    counts = [F.count(F.when(F.col("rel_type") == t, 1)).alias(f"{t.lower()}_matches") for t in weights]
    return both.groupBy("src", "dst").agg(F.sum(total).alias("score"), *counts)
