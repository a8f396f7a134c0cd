"""Best-fit packing of token sequences by exact-complement hashing.

Every document becomes its ids and an end id; only documents above the capacity are cut.  What
has to be packed is then no more than a histogram of at most ``capacity`` lengths, which is all
that reaches the driver.  The plan takes the longest length left and looks its gap up among the
single, pair and triple sums of the lengths still available; a pattern that fills the capacity
exactly is used as often as the counts allow, so each step uses up a length.  What finds no
exact partner is packed best-fit.  A plan has a few thousand slots however many documents there
are; pieces find their slot by their rank among the pieces of their length.

Defined results
* null or empty text: one piece that holds the end id alone
* empty table: no rows
* repeated rows: each is packed; equal rows are interchangeable
* null ids: rows like others; they are told apart by their pieces' lengths and digests only
* a very long text is cut into full pieces and a last one; every piece is placed by itself
* ties: of pieces of one length any may take a place, and of equally good places the first is taken
* columns beside doc_id and text are not looked at, whatever their names
"""

from __future__ import annotations

import zlib
from collections import Counter
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import cut, partitions, small_batches
from .tokens import END, encoder

CAPACITY = 4096


def token_pieces(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """doc_id, piece, start, length, ids_crc32 of every piece of every document."""

    def cut_up(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        enc, step = encoder(tokenizer), 4 * capacity
        for b in batches:
            at, rows = [], []
            for i, text in enumerate(b.column(1).to_pylist()):
                ids = enc.encode(text) + END
                for p, o in enumerate(range(0, len(ids), step)):
                    part = ids[o : o + step]
                    at.append(i)
                    rows.append((p, o // 4, len(part) // 4, zlib.crc32(part)))
            p, start, length, crc = np.array(rows, np.int64).reshape(-1, 4).T
            yield pa.RecordBatch.from_arrays([b.column(0).take(pa.array(at, pa.int64())), pa.array(p.astype(np.int32)), pa.array(start), pa.array(length), pa.array(crc)], ["doc_id", "piece", "start", "length", "ids_crc32"])

    kind = docs.schema["doc_id"].dataType.simpleString()
    return docs.select("doc_id", "text").mapInArrow(cut_up, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long")


class Complements:
    """Which lengths, pairs and triples of available lengths sum to a gap."""

    def __init__(self, counts: np.ndarray):
        self.counts = counts
        self.stale = True

    def _pair_sums(self) -> np.ndarray:
        if self.stale:
            there = (self.counts > 0).astype(np.float64)
            n = 1 << (2 * len(there) - 1).bit_length()
            self.sums = np.rint(np.fft.irfft(np.fft.rfft(there, n) ** 2, n)[: len(there)]) > 0
            self.stale = False
        return self.sums

    def pair(self, gap: int) -> list[int] | None:
        if gap < 2:
            return None
        left = self.counts[1 : gap // 2 + 1]
        right = self.counts[gap - 1 : (gap - 1) // 2 : -1][: len(left)]
        both = (left > 0) & (right > 0)
        if gap % 2 == 0:
            both[-1] = left[-1] > 1
        a = np.flatnonzero(both)
        return [gap - int(a[0]) - 1, int(a[0]) + 1] if len(a) else None

    def exact(self, gap: int) -> list[int] | None:
        if self.counts[gap] > 0:
            return [gap]
        if found := self.pair(gap):
            return found
        sums = self._pair_sums()
        first = np.flatnonzero((self.counts[1:gap] > 0) & sums[gap - 1 : 0 : -1]) + 1
        for a in first[::-1].tolist():
            self.counts[a] -= 1
            found = self.pair(gap - a)
            self.counts[a] += 1
            if found:
                return [a, *found]
        return None


def pack_plan(histogram: dict[int, int], capacity: int = CAPACITY) -> tuple[list[tuple[int, int, int, int]], int]:
    """Slots (length, first rank, first sequence, offset) and the number of sequences.

    Ranks from a slot's first up to the next slot's first rank of the same length go to
    consecutive sequences, each at the slot's offset.
    """
    counts = np.zeros(capacity + 1, np.int64)
    for length, n in histogram.items():
        counts[length] = n
    used, slots, sequences, index = np.zeros(capacity + 1, np.int64), [], 0, Complements(counts)

    def take(pattern: list[int]) -> None:
        nonlocal sequences
        times = min(counts[x] // k for x, k in Counter(pattern).items())
        offset = 0
        for x in pattern:
            slots.append((x, int(used[x]), sequences, offset))
            used[x] += times
            counts[x] -= times
            index.stale |= counts[x] == 0
            offset += x
        sequences += int(times)

    def without(pattern: list[int], sign: int) -> None:
        for x in pattern:
            counts[x] += sign

    for exact_only in (True, False):
        for longest in range(capacity, 0, -1):
            while counts[longest] > 0:
                pattern, gap = [longest], capacity - longest
                without(pattern, -1)
                while gap:
                    if found := index.exact(gap):
                        without(found, -1)
                        pattern += found
                        gap = 0
                    elif exact_only or not len(fits := np.flatnonzero(counts[1 : gap + 1])):
                        break
                    else:
                        best = int(fits[-1]) + 1
                        without([best], -1)
                        pattern.append(best)
                        gap -= best
                without(pattern, 1)
                if exact_only and gap:
                    break
                take(pattern)
    return slots, sequences


def pack(docs: DataFrame, capacity: int = CAPACITY, tokenizer: str | None = None) -> DataFrame:
    """The pieces of ``docs`` with sequence_id and offset."""
    spark = docs.sparkSession
    small_batches(spark)
    parts = partitions(spark)
    pieces = cut(token_pieces(docs, capacity, tokenizer), "pieces")
    histogram = {r.length: r.n for r in pieces.groupBy("length").agg(F.count("*").alias("n")).collect()}
    slots, _ = pack_plan(histogram, capacity)
    return cut(place(pieces, slots, parts), "packed")


def place(pieces: DataFrame, slots: list[tuple[int, int, int, int]], parts: int) -> DataFrame:
    """Give each piece the slot of its rank among the pieces of its length.

    One length may hold a third of all pieces: it is ranked in ``parts`` parts, and what comes
    before each part is added from their counts.
    """
    dealt = pieces.withColumn("part", F.pmod(F.xxhash64("doc_id", "piece", "ids_crc32"), F.lit(parts)).cast("int"))
    before = Window.partitionBy("length").orderBy("part").rowsBetween(Window.unboundedPreceding, -1)
    bases = (
        dealt.groupBy("length", "part").agg(F.count("*").alias("n"))
        .select("length", "part", F.coalesce(F.sum("n").over(before), F.lit(0)).alias("base"))
    )
    own = Window.partitionBy("length", "part").orderBy("doc_id", "piece", "start", "ids_crc32")
    ranked = dealt.withColumn("rank", F.row_number().over(own)).join(bases, ["length", "part"])
    slots = sorted(slots) or [(0, 0, 0, 0)]
    key = np.array([(x[0] << 44) + x[1] for x in slots], np.int64)
    first, sequence, offset = (np.array([x[i] for x in slots], np.int64) for i in (1, 2, 3))
    names = ["doc_id", "piece", "start", "length", "ids_crc32"]

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            length, rank = b.column(3).to_numpy(), b.column(5).to_numpy()
            at = np.searchsorted(key, (length << 44) + rank, side="right") - 1
            yield pa.RecordBatch.from_arrays([*b.columns[:5], pa.array(sequence[at] + rank - first[at]), pa.array(offset[at])], [*names, "sequence_id", "offset"])

    kind = pieces.schema["doc_id"].dataType.simpleString()
    placed = ranked.select(*names, (F.col("base") + F.col("rank") - 1).alias("rank"))
    return placed.mapInArrow(assign, f"doc_id {kind}, piece int, start long, length long, ids_crc32 long, sequence_id long, offset long")
