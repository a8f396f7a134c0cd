"""Token ids in sorted-string-table shards.

A shard holds documents in ascending order of their key::

    block*     entries: varint shared, varint unshared, varint bytes of the value, key suffix,
               value; within a block a key leaves out what it shares with the one before it,
               and the first key of a block is whole
    index      for each block: varint length of its first key, that key, then 8-byte offset of the block,
               its length, ids before it in the shard, documents before it in the shard
    Bloom      bit array of the keys
    footer     offsets and lengths of index and Bloom filter, number of hashes, documents,
               ids, width of an id, magic

A value is the document's ids, end id included, as little-endian integers of the footer's width.
A lookup reads the footer, asks the Bloom filter, binary-searches the index and reads one block.

A task writes its range of ids as shards of about ``SHARD_BYTES``, so what a shard's writer and
reader hold (index, Bloom filter, one block) has a bound however many rows a range has.

Defined results
* null text: the end id alone; empty table: no shards, no rows
* null id: its own key, which sorts first; repeated ids: all kept, in order of their texts' hashes
* a very long text is one entry, whole, in a block of its own size
* columns beside doc_id and text are not looked at, whatever their names
"""

from __future__ import annotations

import bisect
import os
import struct
import zlib
from array import array
from collections.abc import Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
import xxhash
from pyarrow import fs as pafs
from pyspark import TaskContext
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from .common import cut, fresh_path, partitions, small_batches
from .tokens import END, encoder

BLOCK_BYTES = 64 * 1024
#: A shard ends with the first block beyond this.
SHARD_BYTES = 256 * 1024 * 1024
#: Rows that go back to Spark at once.
READ_ROWS = 10_000
BLOOM_BITS_PER_KEY = 10
BLOOM_HASHES = 7
FOOTER = struct.Struct("<QQQQQQQB7s")
INDEX = struct.Struct("<QQQQ")
MAGIC = b"LWSST01"


def key_of(doc_id: int | None) -> bytes:
    """Keys sort as the ids do, null first."""
    return b"\x00" if doc_id is None else b"\x01" + struct.pack(">Q", doc_id + (1 << 63))


def id_of(key: bytes) -> int | None:
    return None if key == b"\x00" else struct.unpack(">Q", key[1:])[0] - (1 << 63)


def _varint(n: int) -> bytes:
    out = bytearray()
    while n > 127:
        out.append(n & 127 | 128)
        n >>= 7
    out.append(n)
    return bytes(out)


def _read_varint(data: bytes, at: int) -> tuple[int, int]:
    n = shift = 0
    while True:
        b = data[at]
        at += 1
        n |= (b & 127) << shift
        if b < 128:
            return n, at
        shift += 7


def _bloom_bits(h: int, bits: int) -> list[int]:
    """Bits of a key's hash."""
    step = (h >> 32) | 1
    return [(h + i * step) % bits for i in range(BLOOM_HASHES)]


class ShardWriter:
    """Writes one shard to a binary stream; memory is one block, the index and the keys' hashes."""

    def __init__(self, out, width: int = 2):
        self.out, self.width = out, width
        self.at = self.docs = self.ids = 0
        self.block, self.last, self.index, self.hashes = bytearray(), b"", [], array("Q")
        self.begun: tuple[bytes, int, int] | None = None

    def add(self, key: bytes, ids: bytes) -> None:
        """ids: little-endian 32-bit."""
        values = np.frombuffer(ids, "<u4")
        value = values.astype("<u2").tobytes() if self.width == 2 else ids
        if self.begun is None:
            self.begun, self.last = (key, self.ids, self.docs), b""
        shared = len(os.path.commonprefix([self.last, key]))
        self.block += _varint(shared) + _varint(len(key) - shared) + _varint(len(value)) + key[shared:] + value
        self.last = key
        self.hashes.append(xxhash.xxh64_intdigest(key))
        self.docs += 1
        self.ids += len(values)
        if len(self.block) >= BLOCK_BYTES:
            self._end_block()

    def _end_block(self) -> None:
        if self.begun:
            key, ids, docs = self.begun
            self.index.append(_varint(len(key)) + key + INDEX.pack(self.at, len(self.block), ids, docs))
            self.out.write(bytes(self.block))
            self.at += len(self.block)
            self.block, self.begun = bytearray(), None

    def close(self) -> None:
        self._end_block()
        index = b"".join(self.index)
        bits = max(64, BLOOM_BITS_PER_KEY * len(self.hashes) + 7 & ~7)
        bloom = bytearray(bits // 8)
        for h in self.hashes:
            for b in _bloom_bits(h, bits):
                bloom[b >> 3] |= 1 << (b & 7)
        self.out.write(index)
        self.out.write(bytes(bloom))
        self.out.write(FOOTER.pack(self.at, len(index), self.at + len(index), len(bloom), BLOOM_HASHES, self.docs, self.ids, self.width, MAGIC))


def _entries(block: bytes) -> Iterator[tuple[bytes, bytes]]:
    at, key = 0, b""
    while at < len(block):
        shared, at = _read_varint(block, at)
        own, at = _read_varint(block, at)
        size, at = _read_varint(block, at)
        key = key[:shared] + block[at : at + own]
        at += own
        yield key, block[at : at + size]
        at += size


class Shard:
    """Reads one shard: by key, or from its first block to its last."""

    def __init__(self, source, size: int):
        self.source = source
        source.seek(size - FOOTER.size)
        index_at, index_n, bloom_at, bloom_n, self.hashes, self.docs, self.ids, self.width, magic = FOOTER.unpack(source.read(FOOTER.size))
        if magic != MAGIC:
            raise ValueError("not a shard")
        source.seek(index_at)
        data = source.read(index_n)
        source.seek(bloom_at)
        self.bloom = source.read(bloom_n)
        self.firsts: list[bytes] = []
        self.blocks: list[tuple[int, int, int, int]] = []
        at = 0
        while at < len(data):
            n, at = _read_varint(data, at)
            self.firsts.append(data[at : at + n])
            self.blocks.append(INDEX.unpack_from(data, at + n))
            at += n + INDEX.size

    def _ids(self, value: bytes) -> np.ndarray:
        return np.frombuffer(value, f"<u{self.width}").astype("<u4")

    def _block(self, i: int) -> bytes:
        offset, size, _, _ = self.blocks[i]
        self.source.seek(offset)
        return self.source.read(size)

    def scan(self) -> Iterator[tuple[bytes, int, np.ndarray]]:
        """Key, ids before the document in this shard, ids."""
        for i, (_, _, before, _) in enumerate(self.blocks):
            for key, value in _entries(self._block(i)):
                ids = self._ids(value)
                yield key, before, ids
                before += len(ids)

    def may_hold(self, key: bytes) -> bool:
        bits = 8 * len(self.bloom)
        return all(self.bloom[b >> 3] >> (b & 7) & 1 for b in _bloom_bits(xxhash.xxh64_intdigest(key), bits))

    def get(self, key: bytes) -> np.ndarray | None:
        """Ids of the first document with this key."""
        if not self.may_hold(key):
            return None
        i = max(0, bisect.bisect_left(self.firsts, key) - 1)
        while i < len(self.blocks) and self.firsts[i] <= key:
            for k, value in _entries(self._block(i)):
                if k == key:
                    return self._ids(value)
            i += 1
        return None


def open_shard(uri: str) -> Shard:
    store, path = pafs.FileSystem.from_uri(uri)
    return Shard(store.open_input_file(path), store.get_file_info(path).size)


def write_shards(docs: DataFrame, folder: str, tokenizer: str | None = None) -> DataFrame:
    """Write ``docs`` range by range; returns the manifest (part, shard, uri, docs, ids, first, last).

    A file carries its task attempt in its name and only the manifest of the attempt that Spark
    commits points at it, so a repeated task leaves at most a file that nobody reads.
    """
    spark = docs.sparkSession
    small_batches(spark)

    def write(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, writer, out, first, key, done = encoder(tokenizer), None, None, None, None, 0
        task = TaskContext.get()
        store, path = pafs.FileSystem.from_uri(folder)
        width = 2 if enc.tokenizer.get_vocab_size(with_added_tokens=True) <= 1 << 16 else 4

        def name() -> str:
            return f"shard-{task.partitionId():06d}-{done:06d}-{task.taskAttemptId()}.sst"

        def finished() -> pa.RecordBatch:
            writer.close()
            out.close()
            row = task.partitionId(), done, f"{folder}/{name()}", writer.docs, writer.ids, first, key
            return pa.RecordBatch.from_arrays([pa.array([v], pa.string() if isinstance(v, str) else pa.int64()) for v in row], ["part", "shard", "uri", "docs", "ids", "first", "last"])

        for b in batches:
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                if writer is not None and writer.at >= SHARD_BYTES:
                    yield finished()
                    writer, done = None, done + 1
                if writer is None:
                    store.create_dir(path, recursive=True)
                    out = store.open_output_stream(f"{path}/{name()}")
                    writer, first = ShardWriter(out, width), doc_id
                writer.add(key_of(doc_id), enc.encode(text) + END)
                key = doc_id
        if writer is not None:
            yield finished()

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
        .repartitionByRange(partitions(spark), "doc_id", "h").sortWithinPartitions("doc_id", "h")
    )
    return cut(ordered.select("doc_id", "text").mapInArrow(write, "part long, shard long, uri string, docs long, ids long, first long, last long"), "manifest")


def read_shards(spark: SparkSession, manifest: DataFrame) -> DataFrame:
    """doc_id, start, n_tokens, ids_crc32 of every document, from the files alone.

    The driver sees one manifest row for each file, of which there is one for each range and ``SHARD_BYTES``.
    """
    shards, before = [], 0
    for r in sorted(manifest.collect(), key=lambda r: (r.part, r.shard)):
        shards.append((r.uri, before))
        before += r.ids

    def read(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in b.column(0).to_pylist():
                uri, base = shards[i]
                rows = ((id_of(key), base + at, len(ids), zlib.crc32(ids.tobytes())) for key, at, ids in open_shard(uri).scan())
                while some := list(islice(rows, READ_ROWS)):
                    yield pa.RecordBatch.from_arrays([pa.array(x, pa.int64()) for x in zip(*some)], ["doc_id", "start", "n_tokens", "ids_crc32"])

    n = len(shards)
    return spark.range(0, n, 1, max(1, n)).mapInArrow(read, "doc_id long, start long, n_tokens long, ids_crc32 long")


def lookup(manifest: DataFrame, doc_id: int) -> np.ndarray | None:
    """Ids of one document by binary search: manifest range, Bloom filter, block index, block."""
    for r in manifest.where((F.col("first") <= doc_id) & (F.col("last") >= doc_id)).orderBy("part", "shard").collect():
        if (ids := open_shard(r.uri).get(key_of(doc_id))) is not None:
            return ids
    return None


def round_trip(docs: DataFrame, tokenizer: str | None = None) -> DataFrame:
    spark = docs.sparkSession
    return read_shards(spark, write_shards(docs, fresh_path(spark, "sst"), tokenizer))
