"""Exact substring deduplication with fixed-block anchors.

A repeated window of 35 words holds, in each document where it starts, one whole block of that
document's non-overlapping 18-word blocks (2 * 18 - 1 = 35).  So

1. all blocks are indexed by hash and every rolling 18-word window of every document probes
   them; a block that at least two windows match is an anchor;
2. each document marks where its rolling windows hit anchors and extends the hits: every
   35-word window that starts at most 17 words before a hit may be part of a repeat.  Their
   hashes are compared among all documents; the windows that agree with another one, joined
   where they overlap, are the maximal exact repeats, and their words go.

Documents are handled in chunks of neighbouring rows of their file, bounded by bytes: longer
texts share a chunk with fewer others, so that only a single text can be larger.  What is sent
for a chunk is, for each hash bucket, one sorted list of its distinct hashes (about 4 bytes each,
with a bit for "twice in this chunk" and one for "a block starts here"), so a passage that
thousands of documents share is one entry a chunk.  The number of buckets follows from the bytes
of all texts, so a bucket has a bounded size too, whatever repeats.

Windows are compared by 126 bits of two hashes that share nothing, made from separate hashes of
the words: with 1e12 windows the chance that any two unlike ones agree is about 1e-14.

Defined results
* words are the runs of anything but ASCII white space; null text has none
* a document under 35 words keeps all its words and makes none repeat
* a window that occurs twice in one document is a repeat; repeated rows repeat each other
* null and repeated ids: each row stands for itself, ids only label the result
* a very long text is one row of its own chunk, held whole by one task and never cut
* columns to keep may be called anything; a column named as a result comes with the row
* empty table: no rows
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
import xxhash
from pyspark.errors import AnalysisException
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from .common import cut, release, small_batches

WINDOW = 35
BLOCK = (WINDOW + 1) // 2
#: Bytes of text of one chunk, about, and the most rows that make one.
CHUNK_BYTES, CHUNK_ROWS = 2_000_000, 8192
#: Bytes of text for each hash bucket: about a million hashes.
BUCKET_BYTES = 6_000_000
#: Words of one chunk whose hashes a worker holds before it sends them.
SEND_AT = 2_000_000
#: Bits of a hash that are sent beside its bucket to find anchors, and of the first hash of a window.
ANCHOR_BITS, WINDOW_BITS = 34, 62

_BASE = 0x9E3779B97F4A7C15
_MASK = (1 << 64) - 1
_powers = np.ones(1, np.uint64), np.ones(1, np.uint64)


def _power_tables(n: int) -> tuple[np.ndarray, np.ndarray]:
    """Powers 0 to n of the base and of its inverse, modulo 2 ** 64."""
    global _powers
    if len(_powers[0]) <= n:
        n = max(n, 2 * len(_powers[0]), 4096)
        _powers = tuple(np.cumprod(np.concatenate([[np.uint64(1)], np.full(n, b, np.uint64)]), dtype=np.uint64) for b in (_BASE, pow(_BASE, -1, 1 << 64)))
    return _powers


def words_of(text: str | None) -> list[bytes]:
    return text.encode("utf-8", "surrogatepass").split() if text else []


def word_hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words))


def second_hashes(words: list[bytes]) -> np.ndarray:
    """Hashes of words that have nothing to do with ``word_hashes``."""
    return np.fromiter(map(xxhash.xxh3_64_intdigest, words), np.uint64, len(words))


def rolling(hashes: np.ndarray, width: int) -> np.ndarray:
    """A 64-bit hash of each run of ``width`` words, by its start."""
    n = len(hashes)
    if n < width:
        return np.empty(0, np.uint64)
    up, down = _power_tables(n)
    sums = np.zeros(n + 1, np.uint64)
    np.cumsum(hashes * up[:n], out=sums[1:])
    x = (sums[width:] - sums[:-width]) * down[: n - width + 1]
    x ^= x >> np.uint64(32)
    x *= np.uint64(0xD6E8FEB86659FD93)
    x ^= x >> np.uint64(32)
    return x


def _bucket(hashes: np.ndarray, buckets: int) -> np.ndarray:
    return (hashes >> np.uint64(40)) % np.uint64(buckets)


def anchor_keys(hashes: np.ndarray, buckets: int) -> np.ndarray:
    """What stands for the hash of a block: its bucket and its low bits."""
    return _bucket(hashes, buckets) << np.uint64(ANCHOR_BITS) | hashes & np.uint64((1 << ANCHOR_BITS) - 1)


def window_keys(words: list[bytes], at: np.ndarray) -> np.ndarray:
    """Two hashes of each window that starts ``at`` a word, as rows."""
    first = rolling(word_hashes(words), WINDOW)[at] & np.uint64((1 << WINDOW_BITS) - 1)
    return np.stack([first, rolling(second_hashes(words), WINDOW)[at]], axis=1)


def _by_bucket(bucket: np.ndarray) -> Iterator[tuple[int, int, int]]:
    """(bucket, from, to) of each run of a sorted array."""
    edges = np.flatnonzero(np.concatenate([[True], bucket[1:] != bucket[:-1], [True]])) if len(bucket) else np.zeros(1, int)
    for a, b in zip(edges[:-1].tolist(), edges[1:].tolist()):
        yield int(bucket[a]), a, b


def send_blocks(chunk: int, hashes: np.ndarray, is_block: np.ndarray, buckets: int) -> Iterator[tuple[int, int, bytes]]:
    """(bucket, chunk, list) for every bucket that has hashes of this chunk."""
    packed = np.sort(anchor_keys(hashes, buckets) << np.uint64(1) | is_block)
    is_block = packed & np.uint64(1)
    packed >>= np.uint64(1)
    starts = np.flatnonzero(np.concatenate([[True], packed[1:] != packed[:-1]]))
    twice = (np.diff(np.append(starts, len(packed))) > 1).astype(np.uint64)
    flags = twice << np.uint64(1) | np.maximum.reduceat(is_block, starts)
    packed = packed[starts]
    low = packed & np.uint64((1 << ANCHOR_BITS) - 1)
    for bucket, a, b in _by_bucket(packed >> np.uint64(ANCHOR_BITS)):
        steps = np.diff(low[a:b], prepend=np.uint64(0))
        if steps.max() < 1 << 30:
            data = b"4" + (steps << np.uint64(2) | flags[a:b]).astype("<u4").tobytes()
        else:
            data = b"8" + (low[a:b] << np.uint64(2) | flags[a:b]).astype("<u8").tobytes()
        yield bucket, chunk, data


def received_blocks(data: bytes) -> tuple[np.ndarray, np.ndarray]:
    """The hashes of a list and their flags: 1 a block starts here, 2 twice in its chunk."""
    x = np.frombuffer(data, f"<u{data[:1].decode()}", offset=1).astype(np.uint64)
    low = x >> np.uint64(2)
    return np.cumsum(low, dtype=np.uint64) if data[:1] == b"4" else low, x & np.uint64(3)


def distinct_windows(keys: np.ndarray, buckets: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """The distinct windows of a chunk in the order in which they are sent, their buckets, and which are there twice."""
    bucket = _bucket(keys[:, 0], buckets)
    order = np.lexsort((keys[:, 1], keys[:, 0], bucket))
    keys = keys[order]
    starts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)]))
    return keys[starts], bucket[order[starts]], np.diff(np.append(starts, len(keys))) > 1


def send_windows(keys: np.ndarray, buckets: int) -> Iterator[tuple[int, bytes]]:
    """(bucket, list) for every bucket that has windows of a chunk; the first hash carries whether it is there twice."""
    keys, bucket, twice = distinct_windows(keys, buckets)
    keys[:, 0] = keys[:, 0] << np.uint64(1) | twice
    for b, x, y in _by_bucket(bucket):
        yield b, keys[x:y].astype("<u8").tobytes()


def _batch(rows: list[tuple], schema: pa.Schema) -> pa.RecordBatch:
    return pa.RecordBatch.from_arrays([pa.array([r[i] for r in rows], f.type) for i, f in enumerate(schema)], schema=schema)


_LISTS = pa.schema([("bucket", pa.int64()), ("chunk", pa.int64()), ("data", pa.binary())])
_HOT = pa.schema([("chunk", pa.int64()), ("hot", pa.binary())])


def shared_blocks(lists: DataFrame) -> DataFrame:
    """(chunk, hot): of each chunk's keys those that match a block and occur at least twice."""

    def find(table: pa.Table) -> pa.Table:
        found = [received_blocks(x) for x in table.column("data").to_pylist()]
        low, flags = (np.concatenate([x[i] for x in found]) for i in (0, 1))
        of = np.repeat(np.arange(len(found)), [len(x[0]) for x in found])
        order = np.argsort(low, kind="stable")
        low, flags, of = low[order], flags[order], of[order]
        starts = np.flatnonzero(np.concatenate([[True], low[1:] != low[:-1]]))
        sizes = np.diff(np.append(starts, len(low)))
        any_flag = np.bitwise_or.reduceat(flags, starts)
        hot = np.repeat((any_flag & np.uint64(1) > 0) & ((sizes > 1) | (any_flag > np.uint64(1))), sizes)
        low, of = np.uint64(table.column("bucket")[0].as_py() << ANCHOR_BITS) | low[hot], of[hot]
        order = np.argsort(of, kind="stable")
        chunks = table.column("chunk").to_pylist()
        return pa.Table.from_batches([_batch([(chunks[i], low[order[a:b]].tobytes()) for i, a, b in _by_bucket(of[order])], _HOT)], _HOT)

    return lists.groupBy("bucket").applyInArrow(find, "chunk long, hot binary")


def shared_windows(lists: DataFrame) -> DataFrame:
    """(chunk, bucket, data): of each list a bit for every window, set if it occurs at least twice."""

    def find(table: pa.Table) -> pa.Table:
        found = [np.frombuffer(x, "<u8").reshape(-1, 2).astype(np.uint64) for x in table.column("data").to_pylist()]
        keys, ends = np.concatenate(found), np.cumsum(list(map(len, found)))
        twice = keys[:, 0] & np.uint64(1)
        keys[:, 0] >>= np.uint64(1)
        order = np.lexsort((keys[:, 1], keys[:, 0]))
        keys, twice = keys[order], twice[order]
        starts = np.flatnonzero(np.concatenate([[True], (keys[1:] != keys[:-1]).any(axis=1)]))
        sizes = np.diff(np.append(starts, len(keys)))
        hot = np.zeros(len(keys), bool)
        hot[order] = np.repeat((sizes > 1) | (np.maximum.reduceat(twice, starts) > 0), sizes)
        bits = [np.packbits(h).tobytes() for h in np.split(hot, ends[:-1])]
        return pa.table([table.column("chunk"), table.column("bucket"), pa.array(bits, pa.binary())], names=["chunk", "bucket", "data"])

    return lists.groupBy("bucket").applyInArrow(find, "chunk long, bucket long, data binary")


def _among(keys: np.ndarray, hot: np.ndarray) -> np.ndarray:
    if not len(hot):
        return np.zeros(len(keys), bool)
    return hot[np.minimum(np.searchsorted(hot, keys), len(hot) - 1)] == keys


def _windows_among(keys: np.ndarray, hot: np.ndarray) -> np.ndarray:
    """Which rows of ``keys`` are rows of ``hot``, which is sorted and has each once."""
    found = np.zeros(len(keys), bool)
    if not len(hot):
        return found
    at = np.searchsorted(hot[:, 0], keys[:, 0])
    while len(todo := np.flatnonzero(~found & (at < len(hot)))):
        same = hot[at[todo], 0] == keys[todo, 0]
        found[todo[same & (hot[at[todo], 1] == keys[todo, 1])]] = True
        at[todo] = np.where(same, at[todo] + 1, len(hot))
    return found


def in_chunks(docs: DataFrame, columns: list[str]) -> tuple[DataFrame, int]:
    """``columns`` of ``docs`` with __chunk and __row, its number in its file, the same at every reading of
    the same rows, and __kind, which grows with the text's length; and the bytes of all texts."""
    where = ["_metadata.file_path", "_metadata.row_index"]
    try:
        if "_metadata" in docs.columns:
            raise AnalysisException("_metadata is a column of the rows")
        docs.select(*where)
    except AnalysisException:
        docs = cut(docs.select(*columns), "documents")
    size = F.coalesce(F.octet_length("text"), F.lit(0))
    rows, total = docs.agg(F.count("*"), F.coalesce(F.sum(size), F.lit(0))).first()
    mean = max(1, total // max(1, rows))
    most = max(1, min(CHUNK_ROWS, CHUNK_BYTES // mean))
    # texts of up to 8 times the mean share chunks of ``most`` rows, those of up to 16 times of half as many, and so on
    kind = F.greatest(F.lit(0), F.floor(F.log2((size + 1) / float(mean))).cast("int") - 2)
    take = F.greatest(F.lit(1), F.floor(F.lit(most) / F.pow(F.lit(2.0), kind))).cast("long")
    chunk = F.xxhash64(F.col(where[0]), kind, F.floor(F.col(where[1]) / take))
    return docs.select(*columns, chunk.alias("__chunk"), F.col(where[1]).alias("__row"), kind.alias("__kind")), int(total)


def drop_repeats(docs: DataFrame, keep: list[str], with_text: bool = False) -> DataFrame:
    """``keep`` columns of ``docs``, n_words, n_removed, kept_sha256 and, if asked for, the text
    without its repeats (its kept words joined by one space, or the text itself if all are)."""
    small_batches(docs.sparkSession)
    # own names inside: a column to keep may be called anything
    inner = [f"__k{i}" for i in range(len(keep))]
    source, total = in_chunks(docs.select(*keep, "text") if "text" not in keep else docs, [*keep, "text"])
    buckets = 1 + total // BUCKET_BYTES
    source = source.select(F.col("__chunk").alias("chunk"), F.col("__row").alias("row"), F.col("__kind").alias("kind"), *(F.col(k).alias(n) for k, n in zip(keep, inner)), F.col("text").alias("__text"))
    kept_fields = [T.StructField(n, source.schema[n].dataType) for n in inner]

    def probe(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        open_chunks: dict[int, list] = {}  # of each kind: chunk, hashes, words

        def flush(chunk: int, held: list[np.ndarray], _: int) -> Iterator[pa.RecordBatch]:
            if held:
                hashes = np.concatenate(held)
                blocks = np.concatenate([(np.arange(len(h)) % BLOCK == 0).astype(np.uint64) for h in held])
                yield _batch(list(send_blocks(chunk, hashes, blocks, buckets)), _LISTS)

        for b in batches:
            for c, kind, text in zip(*(x.to_pylist() for x in b.columns)):
                state = open_chunks.setdefault(kind, [c, [], 0])
                if c != state[0] or state[2] > SEND_AT:
                    yield from flush(*state)
                    state[:] = [c, [], 0]
                words = words_of(text)
                if len(words) >= WINDOW:
                    state[1].append(rolling(word_hashes(words), BLOCK))
                    state[2] += len(words)
        for state in open_chunks.values():
            yield from flush(*state)

    lists = source.select("chunk", "kind", "__text").mapInArrow(probe, "bucket long, chunk long, data binary")
    anchors = cut(shared_blocks(lists), "anchors")  # what the lists took goes before texts are dealt out

    def mark(table: pa.Table, hot_table: pa.Table) -> pa.Table:
        """Where documents have hits (row, data) and lists of their windows (bucket, data)."""
        hot = np.unique(np.frombuffer(b"".join(hot_table.column("hot").to_pylist()), np.uint64))
        out, windows = [], []
        if len(hot):
            for row, text in zip(table.column("row").to_pylist(), table.column("__text").to_pylist()):
                words = words_of(text)
                if len(words) < WINDOW:
                    continue
                at = _among(anchor_keys(rolling(word_hashes(words), BLOCK), buckets), hot)
                if at.any():
                    hits = np.lib.stride_tricks.sliding_window_view(at, WINDOW - BLOCK + 1).any(axis=1)
                    out.append((row, None, np.packbits(hits).tobytes()))
                    windows.append(window_keys(words, np.flatnonzero(hits)))
        if windows:
            out += [(None, bucket, data) for bucket, data in send_windows(np.concatenate(windows), buckets)]
        chunk = table.column("chunk")[0] if table.num_rows else None
        return pa.table([pa.array([chunk.as_py()] * len(out) if out else [], pa.int64()), *(pa.array([r[i] for r in out], t) for i, t in enumerate((pa.int64(), pa.int64(), pa.binary())))], names=["chunk", "row", "bucket", "data"])

    texts = source.select("chunk", "row", "__text")
    marked = cut(texts.groupBy("chunk").cogroup(anchors.groupBy("chunk")).applyInArrow(mark, "chunk long, row long, bucket long, data binary"), "marked")
    release(anchors)
    # the windows go as soon as their answers are there: a bit for each
    answers = shared_windows(marked.where("bucket is not null").select("bucket", "chunk", "data"))
    answers = cut(marked.where("row is not null").unionByName(answers, allowMissingColumns=True), "answers")
    release(marked)

    result = [T.StructField("__n_words", T.LongType()), T.StructField("__n_removed", T.LongType()), T.StructField("__sha", T.StringType()), T.StructField("__shown", T.StringType())]
    final = T.StructType([*kept_fields, *result])

    def finish(table: pa.Table, told: pa.Table) -> pa.Table:
        row, bucket, data = (told.column(c).to_pylist() for c in ("row", "bucket", "data"))
        hits = {r: x for r, x in zip(row, data) if r is not None}
        at_of, keys_of = {}, {}
        texts = table.column("__text").to_pylist()
        for i, (r, text) in enumerate(zip(table.column("row").to_pylist(), texts)):
            if r in hits:
                words = words_of(text)
                at_of[i] = np.flatnonzero(np.unpackbits(np.frombuffer(hits[r], np.uint8), count=len(words) - WINDOW + 1))
                keys_of[i] = window_keys(words, at_of[i])
        hot = np.empty((0, 2), np.uint64)
        if keys_of:
            keys, of, _ = distinct_windows(np.concatenate(list(keys_of.values())), buckets)
            bits = dict(zip(bucket, data))
            again = [np.unpackbits(np.frombuffer(bits[b], np.uint8), count=y - x) > 0 for b, x, y in _by_bucket(of)]
            hot = keys[np.concatenate(again)]
            hot = hot[np.lexsort((hot[:, 1], hot[:, 0]))]
        values = []
        for i, text in enumerate(texts):
            kept = words = words_of(text)
            if i in at_of:
                at = at_of[i][_windows_among(keys_of[i], hot)]
                edge = np.zeros(len(words) + 1, np.int64)
                np.add.at(edge, at, 1)
                np.add.at(edge, at + WINDOW, -1)
                kept = [w for w, g in zip(words, (np.cumsum(edge[:-1]) > 0).tolist()) if not g]
            joined, removed = b" ".join(kept), len(words) - len(kept)
            shown = (joined.decode("utf-8", "surrogatepass") if removed else text) if with_text else None
            values.append((len(words), removed, hashlib.sha256(joined).hexdigest(), shown))
        types = pa.int64(), pa.int64(), pa.string(), pa.string()
        return pa.table([*(table.column(n) for n in inner), *(pa.array([v[i] for v in values], t) for i, t in enumerate(types))], names=[f.name for f in final.fields])

    done = source.drop("kind").groupBy("chunk").cogroup(answers.groupBy("chunk")).applyInArrow(finish, final)
    out = [F.col(n).alias(k) for k, n in zip(keep, inner)]
    if with_text:
        return done.select(*out, F.col("__shown").alias("text"))
    return done.select(*out, F.col("__n_words").alias("n_words"), F.col("__n_removed").alias("n_removed"), F.col("__sha").alias("kept_sha256"))


def substring_stage(docs: DataFrame) -> DataFrame:
    """All documents with their columns; text and n_chars without the repeats."""
    names = docs.columns
    out = drop_repeats(docs, [c for c in names if c != "text"], with_text=True)
    return out.select(*(F.length("text").cast("long").alias(c) if c == "n_chars" else c for c in names))
