"""Mixing documents to target domain weights, by soft membership.

A table of labelled documents trains a small classifier: a Gaussian naive Bayes model over
statistics of whole texts, some of them counts of words that are telling for one domain.  Naive
Bayes is far too sure of itself, so its answer (the best domain and by how much it leads) only
picks one of a few cells, and a document's posterior over the domains is how the tokens of the
labelled documents of its cell are shared among them: where one toxic document in thirty carries
no telling word, documents without telling words are toxic with a posterior of that size.
Nonnegative rates r (expected copies) are then fitted so that the expected tokens of each domain
meet their targets:

    sum over documents of r * tokens * posterior  =  target weight * all tokens

by projected gradient descent on the squared residuals, weighted by the inverse of the second
moments of the posteriors, for which a step of 1 is safe.  A document's rate after any number
of steps depends only on its posterior and the steps' residuals, a few numbers each.  Tokens are
added up for equal posteriors first, so a step is one aggregate over a slim table.

Everything is DataFrame functions; the driver sees sums for each domain and cell and a bounded
lexicon.

Defined results
* tokens are runs of characters other than white space, not the ids that packing counts: those
  need a tokenizer, which no native function has
* telling words are whole runs of letters, counted as often as they occur
* null text counts as empty: no tokens, posterior from the same model; a very long text is one row
* no usable label: one domain, ``all``, whose posterior is 1
* targets for domains that no label has are left out and the others scaled up to 1
* targets that no rates meet: the rates whose shares are closest; ArithmeticError if the steps
  end before they have come close or to rest
* ties between domains go to the first by name
* rows of one id get the same number of copies; an empty table gives no rows
* columns beside doc_id and text are not looked at, whatever their names; the stage keeps them
"""

from __future__ import annotations

import math

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .common import cut

#: Shares of all tokens.
TARGETS = {"clean": 0.85, "junk": 0.10, "toxic": 0.05}
#: Labelled rows the classifier is fitted on at most, those whose ids hash lowest.
FIT_ROWS = 20_000
#: Telling words of a domain, and the share of its documents that have to hold one.
LEXICON, LEXICON_SHARE = 64, 0.01
#: Bounds of the best domain's lead, in logarithms, that part the cells of a domain.
LEADS = [2.0, 6.0, 15.0]
#: Weight of the domains' overall shares in a cell, in documents of mean length.
SMOOTH = 2.0
#: Gradient steps at most; residuals that count as met, as at rest, and as too far off.
STEPS, CLOSE, REST, FAR = 300, 1e-7, 1e-10, 1e-3
_FLOOR = 1e-4


def domains_of(labels: DataFrame) -> DataFrame:
    """(doc_id, domain) of a table of quality and toxicity labels."""
    domain = F.when(F.col("toxic") > 0, "toxic").when(F.col("quality") > 0, "clean").when(F.col("quality") <= 0, "junk")
    return labels.select("doc_id", domain.alias("domain"))


class DomainModel:
    """Domain posteriors as columns over ``text``."""

    def __init__(self, docs: DataFrame, labelled: DataFrame):
        known = labelled.where("doc_id is not null and domain is not null")
        # FIT_ROWS rows of two short columns: small enough to broadcast
        sample = F.broadcast(known.orderBy(F.xxhash64("doc_id"), "doc_id", "domain").limit(FIT_ROWS))
        texts = cut(docs.select("doc_id", F.coalesce("text", F.lit("")).alias("text")).join(sample, "doc_id"), "labelled")
        counts = {r.domain: r.n for r in texts.groupBy("domain").agg(F.count("*").alias("n")).collect()}
        self.domains = sorted(counts)
        self.words = self._lexicons(texts, counts) if len(counts) > 1 else {}
        self.names = [n for n, _ in self._features()]
        self.stats: dict[str, tuple[float, list[float], list[float]]] = {}
        if len(counts) > 1:
            measured = self._taken_apart(texts, "__").select("domain", *(c.alias(n) for n, c in self._features()))
            each = [f(n).alias(f"{k}_{n}") for n in self.names for k, f in (("m", F.avg), ("v", F.var_pop))]
            for r in measured.groupBy("domain").agg(*each).collect():
                self.stats[r.domain] = (counts[r.domain] / sum(counts.values()), [r[f"m_{n}"] for n in self.names], [max(_FLOOR, r[f"v_{n}"]) for n in self.names])
            self.cells = self._calibrated(texts)

    def _calibrated(self, texts: DataFrame) -> list[list[float]]:
        """Of each cell the domains' shares of its labelled tokens."""
        seen = self._in_cells(texts, "__tokens", "__").groupBy("__cell", "domain").agg(F.sum("__tokens").alias("n"), F.count("*").alias("docs")).collect()
        total, docs = max(1, sum(r.n for r in seen)), max(1, sum(r.docs for r in seen))
        overall = [sum(r.n for r in seen if r.domain == d) / total for d in self.domains]
        out = []
        for cell in range(len(self.domains) * (len(LEADS) + 1)):
            own = {r.domain: r.n for r in seen if r["__cell"] == cell}
            if own and sum(own.values()):
                weight = SMOOTH * total / docs
                out.append([(own.get(d, 0) + weight * o) / (sum(own.values()) + weight) for d, o in zip(self.domains, overall)])
            else:  # no labelled document: half its best domain, half the overall shares
                best = cell // (len(LEADS) + 1)
                out.append([((i == best) + o) / (1 + sum(overall)) for i, o in enumerate(overall)])
        return out

    @staticmethod
    def _lexicons(texts: DataFrame, counts: dict[str, int]) -> dict[str, list[str]]:
        word = texts.select("domain", F.explode(F.array_distinct(DomainModel._letters())).alias("word")).where("word != ''")
        table = word.groupBy("word").agg(*(F.count(F.when(F.col("domain") == d, 1)).alias(f"n{i}") for i, d in enumerate(counts)))
        table = cut(table.where(" OR ".join(f"n{i} >= {max(2, LEXICON_SHARE * n)}" for i, n in enumerate(counts.values()))), "words")
        out = {}
        for i, (d, n) in enumerate(counts.items()):
            rest = " + ".join(f"n{j}" for j in range(len(counts)) if j != i)
            others = sum(counts.values()) - n
            tells = table.where(f"n{i} >= {max(2, LEXICON_SHARE * n)}").withColumn("ratio", F.expr(f"(n{i} / {n}D) / (({rest} + 1) / {others + 1}D)")).where("ratio > 2")
            if found := [r.word for r in tells.orderBy(F.desc("ratio"), F.desc(f"n{i}"), "word").limit(LEXICON).select("word").collect()]:
                out[d] = sorted(found)
        return out

    @staticmethod
    def _words() -> Column:
        """Runs of characters other than white space, as they are written."""
        return F.array_remove(F.split(F.coalesce(F.col("text"), F.lit("")), r"\s+"), "")

    @staticmethod
    def _letters() -> Column:
        """Lower-case runs of letters, and an empty one where the text begins or ends with something else."""
        return F.split(F.lower(F.coalesce(F.col("text"), F.lit(""))), r"[^\p{L}]+")

    def _taken_apart(self, docs: DataFrame, prefix: str) -> DataFrame:
        """``docs`` with its words and those of any lexicon, each as often as it occurs: taken once for all features."""
        telling = sorted({w for lexicon in self.words.values() for w in lexicon})
        hits = F.filter(self._letters(), lambda w: w.isin(telling)) if telling else F.array().cast("array<string>")
        return docs.select("*", self._words().alias(f"{prefix}words"), hits.alias(f"{prefix}hits"))

    def _features(self, prefix: str = "__") -> list[tuple[str, Column]]:
        text, words, hits = F.coalesce(F.col("text"), F.lit("")), F.col(f"{prefix}words"), F.col(f"{prefix}hits")
        size = F.greatest(F.length(text), F.lit(1))
        out = [
            ("upper", F.regexp_count(text, F.lit(r"\p{Lu}")) / size),
            ("symbols", F.regexp_count(text, F.lit(r"[#$%&*+/<=>@^_|~!\[\]{}]")) / size),
            ("distinct", F.when(F.size(words) > 0, F.size(F.array_distinct(words)) / F.size(words)).otherwise(1.0)),
        ]
        for i, (_, lexicon) in enumerate(sorted(self.words.items())):
            out.append((f"lexicon{i}", F.log1p(self._among(hits, lexicon).cast("double"))))
        return out

    @staticmethod
    def _among(words: Column, lexicon: list[str]) -> Column:
        return F.size(F.filter(words, lambda w: w.isin(lexicon)))

    def _in_cells(self, docs: DataFrame, tokens: str, prefix: str) -> DataFrame:
        """``docs`` with its number of words and the cell of each row, ``{prefix}cell``."""
        own = [f"{prefix}f{i}" for i in range(len(self.names))]
        features = [c.alias(n) for n, (_, c) in zip(own, self._features(prefix))]
        out = self._taken_apart(docs, prefix).select(*(F.col(f"`{c}`") for c in docs.columns), F.size(f"{prefix}words").cast("long").alias(tokens), *features)
        logs = []
        for d in self.domains:
            prior, mean, var = self.stats[d]
            terms = [f"{math.log(prior) - 0.5 * sum(map(math.log, var))!r}D", *(f"-pow({n} - {m!r}D, 2) / {2 * v!r}D" for n, m, v in zip(own, mean, var))]
            logs.append(" + ".join(f"({t})" for t in terms))
        out = out.select(*(F.col(f"`{c}`") for c in out.columns if c not in own), F.expr(f"array({', '.join(logs)})").alias(f"{prefix}logs"))
        best = F.array_position(f"{prefix}logs", F.array_max(f"{prefix}logs")).cast("int") - 1
        ranked = F.sort_array(f"{prefix}logs", asc=False)
        lead = sum(((ranked[0] - ranked[1] > x).cast("int") for x in LEADS), F.lit(0))
        return out.select(*(F.col(f"`{c}`") for c in out.columns if c != f"{prefix}logs"), (best * (len(LEADS) + 1) + lead).alias(f"{prefix}cell"))

    def with_posteriors(self, docs: DataFrame, tokens: str, prefix: str) -> DataFrame:
        """``docs`` with its number of words and a column for each domain, in order of ``domains``."""
        if not self.stats:
            out = self._taken_apart(docs, prefix).select(*(F.col(f"`{c}`") for c in docs.columns), F.size(f"{prefix}words").cast("long").alias(tokens))
            return out.withColumn(f"{prefix}p0", F.lit(1.0))
        out = self._in_cells(docs, tokens, prefix)
        shares = [F.element_at(F.array(*(F.lit(c[i]) for c in self.cells)), F.col(f"{prefix}cell") + 1).alias(f"{prefix}p{i}") for i in range(len(self.domains))]
        return out.select(*(F.col(f"`{c}`") for c in out.columns if c != f"{prefix}cell"), *shares)


def rate_after(steps: list[list[float]], posterior: list[str], before: str = "1D") -> Column:
    """The rate of a document, from ``before``, after gradient steps."""
    if not steps:
        return F.expr(before)
    history = ", ".join(f"array({', '.join(f'{float(g)!r}D' for g in s)})" for s in steps)
    along = " + ".join(f"g[{i}] * {p}" for i, p in enumerate(posterior))
    return F.expr(f"aggregate(array({history}), {before}, (r, g) -> greatest(0D, r - ({along})))")


def fit_rates(table: DataFrame, tokens: str, posterior: list[str], shares: list[float]) -> list[list[float]]:
    """The steps whose rates meet ``shares`` of all tokens for the columns ``posterior``."""
    k = range(len(posterior))
    table = cut(table.groupBy(*posterior).agg(F.sum(tokens).alias(tokens)), "memberships")
    moments = table.agg(F.sum(tokens).alias("n"), *(F.sum(F.expr(f"{tokens} * {posterior[i]} * {posterior[j]}")).alias(f"h{i}_{j}") for i in k for j in k)).first()
    total = float(moments.n or 0)
    if not total:
        return []
    inverse = np.linalg.pinv(np.array([[moments[f"h{i}_{j}"] / total for j in k] for i in k]), rcond=1e-9, hermitian=True)
    steps: list[list[float]] = []
    rated, since, last = table.withColumn("__r", F.lit(1.0)), 0, None
    for _ in range(STEPS):
        now = rated.select(tokens, *posterior, rate_after(steps[since:], posterior, "__r").alias("__r"))
        sums = now.agg(*(F.sum(F.expr(f"{tokens} * __r * {p}")).alias(f"t{i}") for i, p in enumerate(posterior))).first()
        off = np.array([sums[i] / total - shares[i] for i in k])
        if np.abs(off).max() < CLOSE or last is not None and np.abs(off - last).max() < REST:
            return steps
        if len(steps) - since >= 10:  # no expression grows with the number of steps
            rated, since = cut(now, "rates"), len(steps)
        steps.append((inverse @ off).tolist())
        last = off
    if np.abs(last).max() > FAR:
        raise ArithmeticError(f"after {STEPS} steps the shares are still off by up to {np.abs(last).max():.4f}")
    return steps


def _shares(domains: list[str], targets: dict[str, float]) -> list[float]:
    if not domains:
        return [1.0]
    wanted = [max(0.0, targets.get(d, 0.0)) for d in domains]
    return [w / sum(wanted) for w in wanted] if sum(wanted) > 0 else [1 / len(domains)] * len(domains)


def copies_of(rate: str, doc_id: str = "doc_id") -> Column:
    """A whole number of copies whose mean is the rate: rounded up or down by the id's hash."""
    return F.floor(F.col(rate) + F.pmod(F.xxhash64(F.col(doc_id)), F.lit(1 << 20)) / float(1 << 20)).cast("long")


def mix(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] = TARGETS) -> DataFrame:
    """doc_id, n_tokens, a posterior ``p_<domain>`` for each domain, rate, copies."""
    rows = docs.select("doc_id", "text")
    model = DomainModel(rows, labelled)
    posterior = [f"__p{i}" for i in range(max(1, len(model.domains)))]
    table = cut(model.with_posteriors(rows, "n_tokens", "__").drop("text"), "posteriors")
    steps = fit_rates(table, "n_tokens", posterior, _shares(model.domains, targets))
    names = model.domains or ["all"]
    out = table.select("doc_id", "n_tokens", *(F.col(p).alias(f"p_{n}") for p, n in zip(posterior, names)), rate_after(steps, posterior).alias("rate"))
    return out.withColumn("copies", copies_of("rate"))


def mixing_stage(docs: DataFrame, labelled: DataFrame, targets: dict[str, float] = TARGETS) -> DataFrame:
    """Every document as many times as its rate says, with all its columns."""
    names = docs.columns
    model = DomainModel(docs, labelled)
    posterior = [f"__p{i}" for i in range(max(1, len(model.domains)))]
    # written whole: whoever filters by the rate later would otherwise take each text apart again
    full = cut(model.with_posteriors(docs, "__tokens", "__"), "posteriors")
    steps = fit_rates(full.select("__tokens", *posterior), "__tokens", posterior, _shares(model.domains, targets))
    rated = full.select(*(F.col(f"`{c}`") for c in names), rate_after(steps, posterior).alias("__rate")).withColumn("__copies", copies_of("__rate"))
    return rated.where("__copies > 0").select(*(F.col(f"`{c}`") for c in names), F.explode(F.sequence(F.lit(1), F.col("__copies").cast("int"))).alias("__copy")).select(*(F.col(f"`{c}`") for c in names))
