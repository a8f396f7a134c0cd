"""Near-duplicate detection with Order MinHash, verified by banded alignment.

The k-mers of a document are its runs of five words (letters and digits, lower case), each
labelled with its occurrence.  A sketch takes, for each of several hash functions, the three
k-mers with the smallest hashes and keeps them in text order; texts that agree in one sketch
are candidates.  With similarity s a sketch agrees with probability about s ** 3, so 16
sketches miss a pair at 0.8 once in 100,000.

A pair is a link if the longest common subsequence of the two k-mer sequences, of length L, has
L / (n + m - L) >= 0.8: the Jaccard similarity of their k-mers, but counting only what a common
order can align.  Such an alignment leaves the diagonal by at most (n + m) / 9, which is the
band.

Equal texts (after folding) are one node, so copies cost one row each.  Within a bucket every
text is first compared with one leader, whose k-mers meet it once for each part of a large bucket.  Links make components, and only texts of one bucket
that are in different components then are compared with each other: a bucket full of copies of
one text costs as many comparisons as it has texts.  Small buckets become pairs; large ones are
cut into parts, and a task compares two parts and gives back links, never pairs.  Before a
comparison, 512 one-bit minhashes of both must be as close as those of a pair at 0.8 are but
once in about 30,000.

Defined results
* null text, or no word: never a duplicate
* fewer than five words: the whole text is the one k-mer
* the class id is the smallest doc_id of the class; that document is the one kept
* a document with a null id is marked kept only if no document of its class has an id; the
  stage drops none without an id
* rows that share an id stay or go together in the stage: they stay if one of them is kept
* a very long text is compared whole; its k-mers are 8 bytes each in one task
* columns beside doc_id and text are not looked at, whatever their names; the stage keeps them
* empty table: no rows
"""

from __future__ import annotations

import re
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, release, small_batches
from .components import connected_components
from .substring import rolling, word_hashes

K = 5
SIMILARITY = 0.8
SKETCHES = 16
TAKEN = 3
#: One-bit minhashes, and how many of them may differ: the mean of a pair at 0.8 and four deviations.
BITS = 512
MAY_DIFFER = int(BITS * (1 - SIMILARITY) / 2 + 4 * (BITS * (1 + SIMILARITY) / 2 * (1 - SIMILARITY) / 2) ** 0.5)

#: Buckets of more texts than this are cut into parts of about ``PART`` texts.
SMALL, PART = 32, 256

_word = re.compile(r"\w+")
_rng = np.random.default_rng(20240229)
_seeds = _rng.integers(1, 1 << 63, SKETCHES, dtype=np.uint64)
_bit_seeds = _rng.integers(1, 1 << 63, BITS, dtype=np.uint64)
_ODD = np.uint64(0x9E3779B97F4A7C15)


def _mix(x: np.ndarray) -> np.ndarray:
    x = x * np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(29)
    return x


def folded_words(text: str | None) -> list[bytes]:
    return [w.encode() for w in _word.findall(text.lower())] if text else []


def kmers(text: str | None) -> tuple[int | None, np.ndarray]:
    """A hash of the folded text (None without words) and its k-mers' hashes in text order."""
    words = folded_words(text)
    if not words:
        return None, np.empty(0, np.uint64)
    hashes = word_hashes(words)
    return xxhash.xxh64_intdigest(hashes.tobytes()) - (1 << 63), rolling(hashes, min(K, len(words)))


def labelled(codes: np.ndarray) -> np.ndarray:
    """The codes, told apart by occurrence."""
    order = np.argsort(codes, kind="stable")
    ranked = codes[order]
    new = np.concatenate([[True], ranked[1:] != ranked[:-1]])
    if new.all():
        return codes
    at = np.arange(len(codes))
    number = at - np.maximum.accumulate(np.where(new, at, 0))
    out = np.empty_like(codes)
    out[order] = ranked + _ODD * number.astype(np.uint64)
    return out


def sketch(codes: np.ndarray) -> np.ndarray:
    """One key for each hash function: its smallest k-mers in text order."""
    marked, taken = labelled(codes), min(TAKEN, len(codes))
    least = np.empty((SKETCHES, taken), np.int64)
    for i, seed in enumerate(_seeds):
        least[i] = np.argpartition(_mix(marked ^ seed), taken - 1)[:taken]
    least.sort(axis=1)
    keys = _seeds.copy()
    for code in codes[least].T:
        keys = _mix(keys * _ODD ^ code)
    return keys


def bit_signature(codes: np.ndarray) -> np.ndarray:
    marked = labelled(codes)
    least = np.full(BITS, np.iinfo(np.uint64).max, np.uint64)
    for a in range(0, len(marked), 256):
        np.minimum(least, _mix(marked[None, a : a + 256] ^ _bit_seeds[:, None]).min(axis=1), out=least)
    return np.packbits((least >> np.uint64(7) & np.uint64(1)).astype(np.uint8)).view("<i8")


def common_kmers(a: np.ndarray, b: np.ndarray) -> int:
    """Size of the intersection as multisets: no alignment is longer."""
    x, nx = np.unique(a, return_counts=True)
    y, ny = np.unique(b, return_counts=True)
    _, i, j = np.intersect1d(x, y, assume_unique=True, return_indices=True)
    return int(np.minimum(nx[i], ny[j]).sum())


def banded_alignment(a: np.ndarray, b: np.ndarray, band: int) -> int:
    """Longest common subsequence by matches at most ``band`` off the diagonal, bit-parallel."""
    short = min(len(a), len(b))
    differ = np.flatnonzero(a[:short] != b[:short])
    head = int(differ[0]) if len(differ) else short
    a, b, short = a[head:], b[head:], short - head
    differ = np.flatnonzero(a[len(a) - short :][::-1] != b[len(b) - short :][::-1])
    tail = int(differ[0]) if len(differ) else short
    a, b = a[: len(a) - tail].tolist(), b[: len(b) - tail].tolist()
    places: dict[int, int] = {}
    for i, x in enumerate(a):
        places[x] = places.get(x, 0) | 1 << i
    full = (1 << len(a)) - 1
    free, window = full, (1 << 2 * band + 1) - 1
    for j, y in enumerate(b):
        if match := places.get(y):
            hit = free & match & (window << j - band if j >= band else window >> band - j)
            free = (free + hit | free - hit) & full
    return head + tail + len(a) - free.bit_count()


def similarity(a: np.ndarray, b: np.ndarray, least: float = SIMILARITY) -> float:
    """Aligned Jaccard similarity of two k-mer sequences, or 0 where it is surely below ``least``."""
    n = len(a) + len(b)
    if not n or (c := common_kmers(a, b)) < least * (n - c):
        return 0.0
    aligned = banded_alignment(a, b, int(n * (1 - least) / (1 + least)) + 1)
    return aligned / (n - aligned)


def _meeting(table: pa.Table) -> pa.Table:
    """Links between the texts of two parts of a bucket that no component joins yet.

    A pair that an earlier sketch has in common belongs to that sketch's bucket.
    """
    node, component, part = (table.column(c).to_numpy() for c in ("node", "component", "part"))
    keys = np.array(table.column("keys").to_pylist(), np.int64)
    bits = np.array(table.column("bits").to_pylist(), np.int64)
    codes = [np.frombuffer(c, "<u8") for c in table.column("codes").to_pylist()]
    slot = int(np.flatnonzero(keys[0] == table.column("key")[0].as_py())[0])
    lo, hi = table.column("lo")[0].as_py(), table.column("hi")[0].as_py()
    size = np.array([len(c) for c in codes])
    left, right = np.flatnonzero(part == lo), np.flatnonzero(part == hi)
    apart = np.array(component)
    unique = [labelled(codes[j]) for j in right]
    joined = np.concatenate(unique) if unique else np.empty(0, np.uint64)
    starts = np.concatenate([[0], np.cumsum(size[right])])
    links = []
    for i in left.tolist():
        may = (apart[right] != apart[i]) & (size[right] >= SIMILARITY * size[i]) & (size[i] >= SIMILARITY * size[right])
        may &= ~(keys[right, :slot] == keys[i, :slot]).any(axis=1)
        may &= np.bitwise_count(bits[right] ^ bits[i]).sum(axis=1) <= MAY_DIFFER
        if lo == hi:
            may &= right > i
        if not may.any():
            continue
        own = np.sort(labelled(codes[i]))
        at = np.minimum(np.searchsorted(own, joined), len(own) - 1)
        common = np.add.reduceat((own[at] == joined).astype(np.int64), starts[:-1])
        both = size[right] + size[i]
        may &= common >= SIMILARITY * (both - common)
        for j in right[may].tolist():
            if apart[i] != apart[j] and similarity(codes[i], codes[j]) >= SIMILARITY:
                links.append((node[i], node[j]))
                apart[apart == apart[j]] = apart[i]
    return pa.table([pa.array([v[k] for v in links], pa.int64()) for k in (0, 1)], names=["a", "b"])


def near_links(docs: DataFrame) -> tuple[DataFrame, DataFrame]:
    """(doc_id, node) of every row of ``docs`` and the links (a, b) between different nodes."""
    rows, first, _, rest = _linked(docs)
    return rows, first.unionByName(rest)


def _linked(docs: DataFrame) -> tuple[DataFrame, DataFrame, DataFrame, DataFrame]:
    """(doc_id, node) of every row, links to leaders, their components, and links between those components."""
    small_batches(docs.sparkSession)
    kind = docs.schema["doc_id"].dataType.simpleString()
    # a text is found again by its row's id and its own hash: many rows can share an id or have none
    source = docs.select("doc_id", F.xxhash64("text").alias("h"), "text")

    def sketches(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            nodes, keys = [], []
            for text in b.column(2).to_pylist():
                node, codes = kmers(text)
                nodes.append(node)
                keys.append(None if node is None else sketch(codes).view(np.int64))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(nodes, pa.int64()), pa.array(keys, pa.list_(pa.int64()))], ["doc_id", "h", "node", "keys"])

    rows = cut(source.mapInArrow(sketches, f"doc_id {kind}, h long, node long, keys array<long>"), "sketches")
    texts = rows.where("node is not null").groupBy("node").agg(F.min(F.struct("doc_id", "h")).alias("row"), F.first("keys").alias("keys"))
    buckets = texts.select("node", F.posexplode("keys").alias("slot", "key"))
    # written first, as other tables below that a large bucket joins: the join's hot keys can then be split
    shared = cut(buckets.groupBy("key").agg(F.min("node").alias("leader"), F.count("*").alias("texts")).where("texts > 1"), "shared")
    members = cut(buckets.join(shared, "key"), "buckets")
    release(shared)
    wanted = texts.join(members.select("node").distinct(), "node", "left_semi").select(F.col("node").alias("wanted"), F.col("row.doc_id").alias("id"), F.col("row.h").alias("hash"), "keys")

    def codes_of(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            out = []
            for want, text, keys in zip(*(c.to_pylist() for c in b.columns)):
                node, codes = kmers(text)
                if node == want:
                    out.append((node, len(codes), keys, bit_signature(codes), codes.astype("<u8").tobytes()))
            kinds = (pa.int64(), pa.int64(), pa.list_(pa.int64()), pa.list_(pa.int64()), pa.binary())
            yield pa.RecordBatch.from_arrays([pa.array([r[i] for r in out], t) for i, t in enumerate(kinds)], ["node", "n", "keys", "bits", "codes"])

    found = source.join(wanted, source["doc_id"].eqNullSafe(wanted["id"]) & (source["h"] == wanted["hash"])).select("wanted", "text", "keys")
    codes = found.mapInArrow(codes_of, "node long, n long, keys array<long>, bits array<long>, codes binary")
    codes = cut(codes.groupBy("node").agg(*(F.first(c).alias(c) for c in ("n", "keys", "bits", "codes"))), "kmers")
    bits = [F.col("bits")[i].alias(f"b{i}") for i in range(BITS // 64)]
    brief = codes.select("node", "n", *bits)

    apart = " + ".join(f"bit_count(x.b{i} ^ y.b{i})" for i in range(BITS // 64))
    alike = F.expr(f"x.n >= {SIMILARITY} * y.n AND y.n >= {SIMILARITY} * x.n AND {apart} <= {MAY_DIFFER}")

    def verify(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            a, z, x, y = (c.to_pylist() for c in b.columns)
            good = [i for i in range(len(a)) if similarity(np.frombuffer(x[i], "<u8"), np.frombuffer(y[i], "<u8")) >= SIMILARITY]
            yield pa.RecordBatch.from_arrays([pa.array([v[i] for i in good], pa.int64()) for v in (a, z)], ["a", "b"])

    def similar(pairs: DataFrame) -> DataFrame:
        """The pairs (a, b, x) that are similar, x being the k-mers of a."""
        both = pairs.join(codes.select(F.col("node").alias("b"), F.col("codes").alias("y")), "b")
        return both.select("a", "b", "x", "y").mapInArrow(verify, "a long, b long").distinct()

    # about ``PART`` texts share a leader and a part, so neither is a hot key
    to_leader = members.where("node != leader").groupBy(F.col("leader").alias("a"), F.col("node").alias("b")).agg(F.max("texts").alias("texts"))
    to_leader = to_leader.select("a", F.pmod(F.xxhash64("b"), F.ceil(F.col("texts") / PART)).cast("int").alias("part"), "b")
    heads = to_leader.select("a", "part").distinct().join(codes.select(F.col("node").alias("a"), "n", "codes", *bits), "a").alias("x")
    first = to_leader.alias("p").join(brief.alias("y"), F.col("p.b") == F.col("y.node"))
    first = first.join(heads, (F.col("p.a") == F.col("x.a")) & (F.col("p.part") == F.col("x.part")) & alike)
    linked = cut(similar(first.select("p.a", "p.b", F.col("x.codes").alias("x"))), "links")
    component = connected_components(linked)
    placed = cut(members.join(component, "node", "left").select("key", "node", F.coalesce("component", "node").alias("component")), "placed")
    split = placed.groupBy("key").agg(F.min("component").alias("lo"), F.max("component").alias("hi"), F.count("*").alias("size")).where("lo < hi").select("key", "size")
    split = cut(split, "split")
    open_members = cut(placed.join(split, "key").join(brief, "node"), "open")
    release(placed, split, members)
    few = open_members.where(F.col("size") <= SMALL)
    x, y = few.alias("x"), few.alias("y")
    rest = x.join(y, (F.col("x.key") == F.col("y.key")) & F.expr("x.component < y.component") & alike)
    rest = rest.select(F.col("x.node").alias("a"), F.col("y.node").alias("b")).distinct()
    rest = similar(rest.join(codes.select(F.col("node").alias("a"), F.col("codes").alias("x")), "a"))

    # large buckets: every text goes to the meetings of its part with each part of the bucket
    many = open_members.where(F.col("size") > SMALL).select("key", "node", "component", F.ceil(F.col("size") / PART).cast("int").alias("parts"))
    many = many.withColumn("part", F.pmod(F.xxhash64("node"), F.col("parts")).cast("int"))
    many = many.withColumn("other", F.explode(F.sequence(F.lit(0), F.col("parts") - 1)))
    many = many.select("key", F.least("part", "other").alias("lo"), F.greatest("part", "other").alias("hi"), "part", "node", "component")
    met = many.join(codes.select("node", "keys", "bits", "codes"), "node").groupBy("key", "lo", "hi").applyInArrow(_meeting, "a long, b long")
    rest = cut(rest.unionByName(met), "links")
    release(open_members, codes)
    return rows.select("doc_id", "node"), linked, component, rest


def near_duplicates(docs: DataFrame) -> DataFrame:
    """doc_id, class_id, kept of every document."""
    rows, _, component, rest = _linked(docs)
    # the other links lie between components: only those that they join are looked at again
    for end in ("a", "b"):
        rest = rest.join(component.select(F.col("node").alias(end), "component"), end, "left").withColumn(end, F.coalesce("component", end)).drop("component")
    joined = connected_components(cut(rest, "edges")).select(F.col("node").alias("c"), F.col("component").alias("top"))
    nodes = rows.where("node is not null").groupBy("node").agg(F.min("doc_id").alias("least")).join(component, "node", "left")
    nodes = nodes.withColumn("c", F.coalesce("component", "node")).join(joined, "c", "left")
    nodes = cut(nodes.select("node", "least", F.coalesce("top", "component").alias("component")), "named")
    # written, so that the joins with these are ones whose hot components and texts can be split
    classes = cut(nodes.where("component is not null").groupBy("component").agg(F.min("least").alias("class_id")), "classes")
    named = cut(nodes.join(classes, "component", "left").select("node", F.when(F.col("component").isNull(), F.col("least")).otherwise(F.col("class_id")).alias("class_id")), "classes")
    release(nodes, classes)
    out = rows.join(named, "node", "left").select("doc_id", F.when(F.col("node").isNull(), F.col("doc_id")).otherwise(F.col("class_id")).alias("class_id"))
    return out.withColumn("kept", F.col("doc_id").eqNullSafe(F.col("class_id")))


def near_duplicate_stage(docs: DataFrame) -> DataFrame:
    """One document of each class, with all its columns."""
    ids = near_duplicates(docs).where("doc_id IS NOT NULL").groupBy(F.col("doc_id").alias("__gone")).agg(F.max("kept").alias("kept"))
    gone = cut(ids.where("NOT kept").select("__gone"), "dropped")
    return docs.join(gone, docs["doc_id"] == gone["__gone"], "left_anti")
