"""Quality scores from a sparse rule ensemble.

Statistics of every whole text are the only inputs.  Small boosted trees are grown on labelled
rows; each path from a root to a node is a rule, a conjunction of bounds on statistics.  Lasso
logistic regression keeps few of them, and those become one Spark column expression that scores
the table of statistics.

The model is fitted on the driver, on at most ``FIT_ROWS`` labelled rows, those whose ids hash
lowest; statistics and scores cover all documents.

Defined results
* null or empty text: all statistics 0, scored by the same rules
* no usable label: every score is 0.5; labels of one kind only: the smoothed share of them
* rows of one id are scored each and all teach, up to ``FIT_ROWS``; null ids and labels teach nothing
* equal values of a statistic are on the same side of a bound
* a very long text is one row whose statistics are taken at once
* columns beside doc_id and text are not looked at, whatever their names
* empty table: no rows
"""

from __future__ import annotations

from collections import Counter
from collections.abc import Iterator
from operator import eq

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import crc_of_id, cut, small_batches

FIT_ROWS = 20_000
TREES, DEPTH, BINS, LEAF_SHARE = 40, 3, 32, 0.005
SHRINK, LASSO, LASSO_STEPS = 0.3, 1e-3, 400

STATS = [
    "words", "upper", "symbols", "digits", "bangs", "bars", "wide", "stops", "distinct", "repeats",
    "commonest", "word_length", "line_copies", "line_words", "longest",
]
_UPPER = np.r_[65:91, 0x80:0x9F]  # A to Z, and the second bytes of the capitals from U+00C0 on
_SYMBOLS = np.frombuffer(b"#$%&*+/<=>@[\\]^_`{|}~!", np.uint8)


def text_stats(text: str | None) -> tuple[float, ...]:
    """The values of ``STATS``: shares of bytes, words or lines, and logarithms of counts."""
    if not text:
        return (0.0,) * len(STATS)
    raw = text.encode("utf-8", "surrogatepass")
    kinds = np.bincount(np.frombuffer(raw, np.uint8), minlength=256)
    size = len(raw)
    words = raw.split()
    n = max(1, len(words))
    counts = Counter(words)
    lines = [x for x in raw.split(b"\n") if x]
    lengths = list(map(len, words)) or [0]
    return (
        float(np.log1p(len(words))), float(kinds[_UPPER].sum() / size), float(kinds[_SYMBOLS].sum() / size), float(kinds[48:58].sum() / size),
        float(kinds[33] / size), float(kinds[124] / size), float(kinds[128:].sum() / size), float(kinds[46] / n), len(counts) / n,
        sum(map(eq, words, words[1:])) / n, max(counts.values(), default=0) / n, sum(lengths) / n,
        1 - len(set(lines)) / max(1, len(lines)), float(np.log1p(n / max(1, len(lines)))), float(np.log1p(max(lengths))),
    )


def stats_table(docs: DataFrame, keep: list[str]) -> DataFrame:
    """``keep`` columns and a column ``stat_<name>`` for each statistic."""
    small_batches(docs.sparkSession)
    n, names = len(keep), [f"stat_{s}" for s in STATS]

    def measure(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            x = np.array([text_stats(t) for t in b.column(n).to_pylist()], np.float64).reshape(-1, len(names))
            yield pa.RecordBatch.from_arrays([*b.columns[:n], *(pa.array(c) for c in x.T)], [*keep, *names])

    chosen = docs.select(*keep, F.col("text").alias("__text"))
    fields = [f"`{f.name}` {f.dataType.simpleString()}" for f in chosen.schema.fields[:n]]
    return chosen.mapInArrow(measure, ", ".join([*fields, *(f"{x} double" for x in names)]))


Rule = tuple[tuple[int, float, float], ...]  # (statistic, above, up to) for each bound statistic


def grow_rules(x: np.ndarray, y: np.ndarray) -> list[Rule]:
    """All paths of boosted trees on the statistics ``x`` and labels ``y``."""
    rng = np.random.default_rng(11)
    cuts = [np.unique(np.quantile(x[:, j], np.linspace(0, 1, BINS + 1)[1:-1])) for j in range(x.shape[1])]
    bins = np.stack([np.searchsorted(c, x[:, j], side="left") for j, c in enumerate(cuts)], axis=1)
    logit, rules = np.full(len(y), np.log((y.mean() + 1e-9) / (1 - y.mean() + 1e-9))), {}
    least = max(5, int(LEAF_SHARE * len(y)))

    def split(rows: np.ndarray, pull: np.ndarray) -> tuple[float, int, int]:
        best, total = (1e-9, -1, -1), pull[rows].sum()
        for j, c in enumerate(cuts):
            count = np.bincount(bins[rows, j], minlength=len(c) + 1).cumsum()[:-1]
            left = np.bincount(bins[rows, j], weights=pull[rows], minlength=len(c) + 1).cumsum()[:-1]
            ok = (count >= least) & (len(rows) - count >= least)
            if ok.any():
                gain = np.where(ok, left**2 / np.maximum(count, 1) + (total - left) ** 2 / np.maximum(len(rows) - count, 1) - total**2 / len(rows), 0)
                k = int(gain.argmax())
                best = max(best, (float(gain[k]), j, k))
        return best

    for _ in range(TREES):
        p = 1 / (1 + np.exp(-logit))
        pull = y - p
        stack = [(rng.permutation(len(y))[: max(1, len(y) // 2)], np.arange(len(y)), {}, 0)]
        while stack:
            grown, rows, bounds, depth = stack.pop()
            if bounds:
                rules[tuple(sorted((j, lo, hi) for j, (lo, hi) in bounds.items()))] = None
            gain, j, k = split(grown, pull) if depth < DEPTH and len(grown) >= 2 * least else (0, -1, -1)
            if j < 0:
                logit[rows] += SHRINK * pull[rows].sum() / ((p * (1 - p))[rows].sum() + 1)
                continue
            at = float(cuts[j][k])
            lo, hi = bounds.get(j, (-np.inf, np.inf))
            for side, new in ((True, (lo, at)), (False, (at, hi))):
                stack.append((grown[(bins[grown, j] <= k) == side], rows[(bins[rows, j] <= k) == side], bounds | {j: new}, depth + 1))
    return list(rules)


def fires(rule: Rule, x: np.ndarray) -> np.ndarray:
    return np.logical_and.reduce([(x[:, j] > lo) & (x[:, j] <= hi) for j, lo, hi in rule])


def lasso_logistic(z: np.ndarray, y: np.ndarray, lam: float = LASSO, steps: int = LASSO_STEPS) -> tuple[float, np.ndarray]:
    """Intercept and sparse weights by accelerated proximal gradient on scaled columns."""
    scale = np.maximum(z.std(axis=0), 1e-6)
    mean = z.mean(axis=0)
    s = ((z - mean) / scale).astype(np.float32)
    step = 4 * len(y) / max(np.linalg.eigvalsh(s.T @ s)[-1], len(y))
    w = look = np.zeros(s.shape[1])
    b = look_b = float(np.log((y.mean() + 1e-9) / (1 - y.mean() + 1e-9)))
    t = 1.0
    for _ in range(steps):
        off = 1 / (1 + np.exp(-(s @ look.astype(np.float32) + look_b))) - y
        new = look - step * (s.T @ off.astype(np.float32)) / len(y)
        new = np.sign(new) * np.maximum(np.abs(new) - step * lam, 0)
        new_b = look_b - step * off.mean()
        t2 = (1 + np.sqrt(1 + 4 * t * t)) / 2
        look, look_b = new + (t - 1) / t2 * (new - w), new_b + (t - 1) / t2 * (new_b - b)
        w, b, t = new, new_b, t2
    return float(b - (w / scale * mean).sum()), w / scale


def fit(x: np.ndarray, y: np.ndarray) -> tuple[float, list[tuple[float, Rule]]]:
    """Intercept and weighted rules."""
    if not len(y):
        return 0.0, []
    if y.min() == y.max():
        share = (y.sum() + 1) / (len(y) + 2)
        return float(np.log(share / (1 - share))), []
    rules = grow_rules(x, y)
    z = np.stack([fires(r, x) for r in rules], axis=1).astype(np.float32) if rules else np.zeros((len(y), 0), np.float32)
    if not rules:
        return float(np.log(y.mean() / (1 - y.mean()))), []
    b, w = lasso_logistic(z, y)
    return b, [(float(v), r) for v, r in zip(w, rules) if v]


def compiled(intercept: float, rules: list[tuple[float, Rule]]):
    """The ensemble as a column over the statistics' columns."""
    def bounds(rule: Rule) -> str:
        sides = [f"stat_{STATS[j]} {op} {v!r}D" for j, lo, hi in rule for op, v in ((">", lo), ("<=", hi)) if np.isfinite(v)]
        return " AND ".join(sides)

    terms = [f"CASE WHEN {bounds(r)} THEN {w!r}D ELSE 0D END" for w, r in rules]
    return F.expr(f"1D / (1D + exp(-({' + '.join([f'{intercept!r}D', *terms])})))")


def learn(stats: DataFrame, labels: DataFrame, folds: int | None = 3, held_fold: int = 1) -> tuple[float, list[tuple[float, Rule]]]:
    """Fit on the labelled rows of ``stats``; a fold can be held out."""
    known = labels.select("doc_id", F.col("quality").alias("label")).where("doc_id is not null and label is not null")
    if folds:
        known = known.where(crc_of_id() % folds != held_fold)
    sample = known.orderBy(F.xxhash64("doc_id"), "doc_id", "label").limit(FIT_ROWS)
    names = [f"stat_{s}" for s in STATS]
    rows = stats.join(sample, "doc_id").select("doc_id", "label", *names)
    rows = rows.orderBy(F.xxhash64("doc_id"), "doc_id", "label", *names).limit(FIT_ROWS).collect()  # ids can repeat
    table = np.array(sorted(tuple(r) for r in rows), np.float64).reshape(-1, 2 + len(names))
    return fit(table[:, 2:], (table[:, 1] > 0).astype(np.float64))


def quality_scores(docs: DataFrame, labels: DataFrame) -> DataFrame:
    """doc_id, held_out, score, predicted of every document."""
    stats = cut(stats_table(docs, ["doc_id"]), "stats")
    score = compiled(*learn(stats, labels))
    held = crc_of_id() % 3 == 1
    return stats.select("doc_id", held.alias("held_out"), score.alias("score")).withColumn("predicted", (F.col("score") >= 0.5).cast("int"))
