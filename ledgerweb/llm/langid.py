"""Language identification by rank-order n-gram profiles.

A profile is the ranked list of the most frequent letter 1- to 3-grams of one language, counted
over all training documents.  A document gets such a list of its own and the language whose
profile has the smallest out-of-place distance to it: the sum over the document's n-grams of
the difference of the two ranks, or of the profile's length where the profile lacks the n-gram.

Defined results
* null text, or a text without any letter: ``und`` with score 0
* nothing to learn from (no row, or no labelled row): every document is ``und`` with score 0
* equal distances: the language that sorts first
* equal counts within a list: the n-gram with the smaller code comes first
* repeated rows are predicted each; columns with clashing names are not read
* a very long text is counted whole, in one task
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from .common import crc_of_id, small_batches

#: Length of a profile, and of a document's own list.
PROFILE_SIZE = 400
#: N-grams that a worker holds before it counts them and passes the counts on.
COUNT_AT = 6_000_000
#: Parts into which one language's counts are split for the first of two top-k rounds.
TOP_SPLIT = 32

_SPACE = 32
_lower = np.full(0x110000, -1, np.int32)
_lower[_SPACE] = _SPACE


def _fill(points: np.ndarray) -> None:
    for p in np.unique(points[_lower[points] < 0]).tolist():
        c = chr(p)
        _lower[p] = ord(c.lower()[0]) if c.isalpha() else _SPACE


def ngram_codes(text: str | None) -> np.ndarray:
    """Codes of all letter n-grams of length 1 to 3; words are padded with one space."""
    if not text:
        return np.empty(0, np.int64)
    points = np.frombuffer(text.encode("utf-32-le", "surrogatepass"), np.uint32)
    low = _lower[points]
    if low.min() < 0:
        _fill(points)
        low = _lower[points]
    a = np.empty(len(low) + 2, np.int64)
    a[0] = a[-1] = _SPACE
    a[1:-1] = low
    letter = a != _SPACE
    keep = letter.copy()
    keep[1:] |= letter[:-1]
    keep[0] = True
    a, letter = a[keep], letter[keep]
    if not letter.any():
        return np.empty(0, np.int64)
    two = a[:-1] | (a[1:] << 21)
    three = two[:-1] | (a[2:] << 42)
    return np.concatenate([a[letter], two, three[letter[1:-1]]])


def ranked(codes: np.ndarray, size: int) -> np.ndarray:
    """The ``size`` most frequent codes, most frequent first."""
    codes = np.sort(codes)
    starts = np.flatnonzero(np.concatenate([[True], codes[1:] != codes[:-1]]))
    counts = np.diff(np.append(starts, len(codes)))
    lack = counts.max() - counts
    lack = lack.astype(np.uint16) if lack.max() < 65536 else lack
    return codes[starts[np.argsort(lack, kind="stable")[:size]]]


def learn_profiles(docs: DataFrame, size: int = PROFILE_SIZE) -> dict[str, list[int]]:
    """Profiles of ``docs(text, lang)``; at most ``size`` codes for each language reach the driver."""

    def count(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            by_lang: dict[str, list[np.ndarray]] = {}
            held = 0
            for text, lang in zip(b.column(0).to_pylist(), b.column(1).to_pylist()):
                by_lang.setdefault(lang, []).append(ngram_codes(text))
                held += len(by_lang[lang][-1])
                if held > COUNT_AT:
                    yield from counted(by_lang)
                    by_lang, held = {}, 0
            yield from counted(by_lang)

    def counted(by_lang: dict[str, list[np.ndarray]]) -> Iterator[pa.RecordBatch]:
        for lang, codes in by_lang.items():
            c, n = np.unique(np.concatenate(codes), return_counts=True)
            yield pa.RecordBatch.from_arrays([pa.array([lang] * len(c), pa.string()), pa.array(c), pa.array(n.astype(np.int64))], ["lang", "code", "n"])

    counts = (
        docs.select("text", "lang").where("lang is not null and text is not null")
        .mapInArrow(count, "lang string, code long, n long")
        .groupBy("lang", "code").agg(F.sum("n").alias("n"))
    )
    order = [F.desc("n"), F.asc("code")]
    part = Window.partitionBy("lang", F.pmod(F.hash("code"), F.lit(TOP_SPLIT))).orderBy(*order)
    whole = Window.partitionBy("lang").orderBy(*order)
    top = counts.withColumn("r", F.row_number().over(part)).where(F.col("r") <= size)
    top = top.withColumn("r", F.row_number().over(whole)).where(F.col("r") <= size)
    profiles: dict[str, list[int]] = {}
    for row in sorted(top.select("lang", "r", "code").collect()):
        profiles.setdefault(row.lang, []).append(row.code)
    return profiles


class Distances:
    """Out-of-place distances of one text to all profiles."""

    def __init__(self, profiles: dict[str, list[int]], size: int = PROFILE_SIZE):
        self.size, self.langs = size, sorted(profiles)
        self.codes = np.unique(np.array([c for v in profiles.values() for c in v] or [0], np.int64))
        self.rank = np.full((len(self.langs), len(self.codes) + 1), size, np.int64)
        for i, lang in enumerate(self.langs):
            self.rank[i, np.searchsorted(self.codes, profiles[lang])] = np.arange(len(profiles[lang]))

    def predict(self, text: str | None) -> tuple[str, float]:
        codes = ngram_codes(text)
        if not len(codes) or not self.langs:
            return "und", 0.0
        top = ranked(codes, self.size)
        at = np.searchsorted(self.codes, top)
        at[(at == len(self.codes)) | (self.codes[np.minimum(at, len(self.codes) - 1)] != top)] = len(self.codes)
        theirs = self.rank[:, at]
        away = np.where(theirs == self.size, self.size, np.abs(theirs - np.arange(len(top)))).sum(axis=1)
        best = int(away.argmin())
        return self.langs[best], float(1 - away[best] / (self.size * len(top)))


def predict_languages(docs: DataFrame, profiles: dict[str, list[int]], keep: list[str], size: int = PROFILE_SIZE) -> DataFrame:
    """``keep`` columns of ``docs`` with ``lang_pred`` and ``score``; only ``text`` is looked at."""
    chosen = docs.select(*keep, F.col("text").alias("__text"))
    fields = [*docs.select(*keep).schema.fields]
    schema = ", ".join([*(f"`{f.name}` {f.dataType.simpleString()}" for f in fields), "lang_pred string", "score double"])

    def predict(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        model = Distances(profiles, size)
        for b in batches:
            found = [model.predict(t) for t in b.column(len(keep)).to_pylist()]
            yield pa.RecordBatch.from_arrays([*b.columns[: len(keep)], pa.array([x[0] for x in found], pa.string()), pa.array([x[1] for x in found], pa.float64())], [*keep, "lang_pred", "score"])

    return chosen.mapInArrow(predict, schema)


def language_id(docs: DataFrame, folds: int = 4, held_fold: int = 2) -> DataFrame:
    """Learn from all documents outside the held fold, predict every document."""
    held = (crc_of_id() % folds == held_fold).alias("held_out")
    small_batches(docs.sparkSession)
    profiles = learn_profiles(docs.where(~(crc_of_id() % folds == held_fold)))
    marked = docs.select("doc_id", "text", held)
    return predict_languages(marked, profiles, ["doc_id", "held_out"])


#: A text this far from every language (0: no n-gram shared with any) is no prose of theirs.
MIN_SCORE = 0.05


def language_stage(docs: DataFrame) -> DataFrame:
    """Documents whose language is known, with all their columns; the others go."""
    small_batches(docs.sparkSession)
    profiles = learn_profiles(docs.where(~(crc_of_id() % 4 == 2)))
    names = docs.columns
    own = [f"__k{i}" for i in range(len(names))]  # a column may be called as the results are
    found = predict_languages(docs.select("*", *(F.col(f"`{n}`").alias(o) for n, o in zip(names, own))), profiles, own)
    found = found.where((F.col("lang_pred") != "und") & (F.col("score") >= MIN_SCORE))
    return found.select(*(F.col(o).alias(n) for n, o in zip(names, own)))
