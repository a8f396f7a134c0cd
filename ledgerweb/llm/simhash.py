"""SimHash fingerprints of 128 bits and the search for all within a Hamming radius.

The terms of a text are its runs of five words (letters and digits, lower case), weighted by
how often they occur; in texts under 200 words the single words are terms too, which share a
weight that shrinks with the text's length.  Each term's hash votes with its weight on every
bit.  Fingerprints at
most ``RADIUS`` bits apart agree in one of ``RADIUS + 1`` blocks whole, so each table holds the
fingerprints with another block permuted to the front as its key, and a probe compares whole
fingerprints under an equal key; the first block in which two agree gives the pair.  Equal
fingerprints are one row of a table.

Every document is also compared with an edited self (its last quarter replaced by the start of
the next document by doc_id) and with that next document.  Documents are dealt by ranges of
doc_id and walked in order; where a range ends, its last document and the next range's first
are put aside and joined, which is two texts for each range.

Defined results
* null text counts as empty; a text without words has the fingerprint of zeros
* fewer than five words are one term
* equal ids: in the order of their texts' hashes; a null id sorts first
* one document alone is its own next document
* a vote that ties leaves its bit 0
* a very long text is fingerprinted whole, in one task
* columns beside doc_id and text are not looked at, whatever their names
* empty table: no rows
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark import TaskContext
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import cut, partitions, small_batches
from .minhash import K, _mix, folded_words
from .substring import rolling, word_hashes

BITS = 128
#: Near copies are texts that share 98 % of their terms, about 6 bits apart.
RADIUS = 7
#: Weight that all single words of a text share, and the length in words from which it is 0.
WORD_WEIGHT, FEW_WORDS = 8.0, 200
#: Every 20th id asks for the documents within the radius of its fingerprint.
ASK = 20

_OTHER = np.uint64(0xA0761D6478BD642F)


def _votes(codes: np.ndarray) -> np.ndarray:
    """For each bit the number of codes whose hash has it set."""
    hashes = np.stack([_mix(codes), _mix(codes ^ _OTHER)], axis=1).view(np.uint8)
    votes = np.zeros(BITS, np.int64)
    for a in range(0, len(codes), 4096):
        votes += np.unpackbits(hashes[a : a + 4096], axis=1).sum(axis=0, dtype=np.int32)
    return votes


def fingerprint(text: str | None) -> bytes:
    words = folded_words(text)
    if not words:
        return bytes(BITS // 8)
    hashes = word_hashes(words)
    runs = rolling(hashes, min(K, len(words)))
    votes, total = _votes(runs), float(len(runs))
    if (weight := WORD_WEIGHT * (1 - len(words) / FEW_WORDS)) > 0:
        votes, total = votes + _votes(hashes) * (weight / len(words)), total + weight
    return np.packbits(2 * votes > total).tobytes()


def likeness(a: bytes, b: bytes) -> float:
    return 1 - (int.from_bytes(a) ^ int.from_bytes(b)).bit_count() / BITS


def edited(text: str, following: str) -> str:
    cut_off = len(text) // 4
    return text[: len(text) - cut_off] + following[:cut_off]


_OUT = ["doc_id", "n_chars", "edited_sha256", "fingerprint", "edited_fingerprint", "near_edited", "near_next"]
_TYPES = [pa.int64(), pa.int64(), pa.string(), pa.string(), pa.string(), pa.float64(), pa.float64()]
_DDL = "doc_id long, n_chars long, edited_sha256 string, fingerprint string, edited_fingerprint string, near_edited double, near_next double"


def _row(doc_id: int | None, text: str, own: bytes, following: str, theirs: bytes) -> tuple:
    other = edited(text, following)
    changed = own if other == text else fingerprint(other)
    return doc_id, len(text), hashlib.sha256(other.encode("utf-8", "surrogatepass")).hexdigest(), own.hex(), changed.hex(), likeness(own, changed), likeness(own, theirs)


def _arrays(rows: list[tuple], types: list[pa.DataType]) -> list[pa.Array]:
    return [pa.array([r[i] for r in rows], t) for i, t in enumerate(types)]


def fingerprints(docs: DataFrame) -> DataFrame:
    """The fingerprints of all documents, of their edited selves, and how alike they are."""
    spark = docs.sparkSession
    small_batches(spark)
    types = [*_TYPES, pa.int32(), pa.int32(), pa.string()]
    names = [*_OUT, "kind", "part", "text"]

    def walk(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        """Rows of kind 0 are finished; 1 is a range's first document, 2 its last."""
        part, last = TaskContext.get().partitionId(), None
        for b in batches:
            rows = []
            for doc_id, text in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                text = text or ""
                own = fingerprint(text)
                if last is None:
                    rows.append((doc_id, *[None] * 6, 1, part, text))
                else:
                    rows.append((*_row(*last, text, own), 0, part, None))
                last = (doc_id, text, own)
            yield pa.RecordBatch.from_arrays(_arrays(rows, types), names)
        if last is not None:
            yield pa.RecordBatch.from_arrays(_arrays([(last[0], *[None] * 6, 2, part, last[1])], types), names)

    def finish(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            rows = [_row(i, t, fingerprint(t), n, fingerprint(n)) for i, t, n in zip(*(c.to_pylist() for c in b.columns))]
            yield pa.RecordBatch.from_arrays(_arrays(rows, _TYPES), _OUT)

    ordered = (
        docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", F.xxhash64("text").alias("h"))
        .repartitionByRange(partitions(spark), "doc_id", "h").sortWithinPartitions("doc_id", "h")
    )
    walked = cut(ordered.select("doc_id", "text").mapInArrow(walk, f"{_DDL}, kind int, part int, text string"), "walked")
    heads = walked.where("kind = 1").select(F.col("part").alias("next_part"), F.col("text").alias("next_text"))
    parts = sorted(r.next_part for r in heads.select("next_part").collect())  # one number for each range
    follow = spark.createDataFrame(list(zip(parts, parts[1:] + parts[:1])), "part int, next_part int")
    ends = walked.where("kind = 2").join(follow, "part").join(heads, "next_part").select("doc_id", "text", "next_text")
    return walked.where("kind = 0").select(*_OUT).unionByName(ends.mapInArrow(finish, _DDL))


def within_radius(asked: DataFrame, prints: DataFrame, radius: int = 3) -> DataFrame:
    """(asked, found): every distinct fingerprint of ``prints`` at most ``radius`` bits from one asked for.

    Both are tables of distinct hexadecimal ``fingerprint``.
    """
    if (BITS // 4) % (radius + 1):
        raise ValueError("radius + 1 blocks must divide a fingerprint's hexadecimal digits")
    width = BITS // 4 // (radius + 1)

    def tables(df: DataFrame, name: str) -> DataFrame:
        block = [F.struct(F.lit(i).alias("t"), F.substring("fingerprint", 1 + i * width, width).alias("key")) for i in range(radius + 1)]
        halves = [F.conv(F.substring("fingerprint", 1 + 16 * i, 16), 16, -10).cast("long").alias(f"{name}{i}") for i in range(BITS // 64)]
        return df.select(F.col("fingerprint").alias(name), *halves, F.explode(F.array(*block)).alias("b")).select(name, *(f"{name}{i}" for i in range(BITS // 64)), "b.t", "b.key")

    a, f = tables(asked, "asked"), tables(prints, "found").withColumnsRenamed({"t": "u", "key": "other"})
    apart = " + ".join(f"bit_count(asked{i} ^ found{i})" for i in range(BITS // 64))
    first = " ".join(f"WHEN substring(asked, {1 + i * width}, {width}) = substring(found, {1 + i * width}, {width}) THEN {i}" for i in range(radius + 1))
    pairs = a.join(f, (F.col("t") == F.col("u")) & (F.col("key") == F.col("other")) & F.expr(f"{apart} <= {radius}") & F.expr(f"t = CASE {first} END"))
    return pairs.select("asked", "found")


def document_fingerprints(docs: DataFrame) -> DataFrame:
    """The fingerprints, and near_docs: for every 20th id how many other documents lie within the radius."""
    prints = cut(fingerprints(docs), "fingerprints")
    groups = prints.groupBy("fingerprint").agg(F.count("*").alias("n"))
    asks = F.coalesce(F.col("doc_id") % ASK == 0, F.lit(False))
    asked = prints.where(asks).select("fingerprint").distinct()
    pairs = within_radius(asked, groups.select("fingerprint"), RADIUS)
    near = pairs.join(groups.withColumnRenamed("fingerprint", "found"), "found").groupBy("asked").agg((F.sum("n") - 1).alias("near_docs"))
    answered = prints.where(asks).join(near, F.col("fingerprint") == F.col("asked")).select(*_OUT, "near_docs")
    return prints.where(~asks).select(*_OUT, F.lit(None).cast("long").alias("near_docs")).unionByName(answered)
