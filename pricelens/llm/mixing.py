"""Mixing to target weights with soft membership, in DataFrame and SQL functions only.

A naive Bayes classifier over hashed words, fitted on labelled rows, gives every document a posterior
over domains.  Nonnegative document rates are fitted by projected-gradient least squares, so that the
expected tokens of each domain, ``sum(rate * tokens * posterior)``, come as near to the targets as they
can.  A step moves every rate against the gradient of the squared misses and sets negative ones to 0.
Measured per token, a document's gradient is its posterior times one number a domain, so rates are never
stored: a document replays the steps from its posterior alone.  Each step is one aggregation over a
narrow table, and only domain sums reach the driver.
"""

from __future__ import annotations

import json
from dataclasses import dataclass, replace

import numpy as np
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from pricelens.llm.scratch import written

WORD_BUCKETS = 4096
MAX_LABELLED = 20_000
MAX_DOMAINS = 64         # of more, the rarest among the labels are one domain, named REST
REST = "(rest)"
#: A text weighs as much evidence as this many words at most: words of one text depend on each other, and
#: if each counted in full, long texts would have posteriors of 0 and 1 whatever the doubt.
EVIDENCE = 50
SMOOTHING = 0.5
PASSES, TOLERANCE = 40, 1e-4
RANK = 1e-9              # moments below this share of the largest count as none
GAIN = 1e-5              # a step must bring the squared misses this share nearer
EXACT_SHARES, GRADIENT_SHARES = (1.0, 0.5, 0.25, 1 / 16, 1 / 64), (1.0, 8.0, 64.0, 512.0, 4096.0)


def words_of(text: Column) -> Column:
    """Non-empty words of a text; null has none."""
    return F.filter(F.split(F.lower(F.coalesce(text, F.lit(""))), r"\s+"), lambda w: w != "")


def _constant(values) -> Column:
    """A numeric array (or array of arrays) as one folded literal."""
    kind = "array<array<double>>" if np.ndim(values) == 2 else "array<double>"
    return F.from_json(F.lit(json.dumps(np.asarray(values).tolist())), kind)


def _dot(a: Column, b: Column) -> Column:
    return F.aggregate(F.zip_with(a, b, lambda x, y: x * y), F.lit(0.0), lambda s, x: s + x)


@dataclass
class DomainClassifier:
    """Log prior of each domain and log likelihood of each word bucket in it."""

    domains: list[str]
    prior: np.ndarray
    likelihood: np.ndarray        # domains x WORD_BUCKETS

    def posterior(self, words: Column) -> Column:
        """Array of the domains' probabilities for a word array."""
        buckets = F.transform(words, lambda w: F.pmod(F.xxhash64(w), F.lit(WORD_BUCKETS)).cast("int"))
        shared = F.least(F.lit(1.0), F.lit(float(EVIDENCE)) / F.greatest(F.size(words), F.lit(1)))

        def looked_up(b: Column, row: np.ndarray) -> Column:
            table = _constant(row)
            return F.aggregate(b, F.lit(0.0), lambda s, k: s + F.get(table, k))

        def logits(b: Column) -> list[Column]:
            return [F.lit(float(p)) + shared * looked_up(b, row)
                    for p, row in zip(self.prior, self.likelihood, strict=True)]

        # one value bound twice by transform over a one-element array: computed once
        scores = F.transform(F.array(buckets), lambda b: F.array(*logits(b)))[0]
        weights = F.transform(F.array(scores), lambda s: F.transform(s, lambda x: F.exp(x - F.array_max(s))))[0]
        return F.transform(F.array(weights), lambda w: F.transform(
            w, lambda x: x / F.aggregate(w, F.lit(0.0), lambda t, y: t + y)))[0]


def fit_classifier(docs: DataFrame, labelled: DataFrame, max_rows: int = MAX_LABELLED) -> DomainClassifier:
    """Fit on at most ``max_rows`` labelled documents, spread by a hash of the id.

    ``labelled`` has ``doc_id, domain``; a document labelled twice counts for its smallest domain, and
    null ids or domains are left out.  Without any label there is one domain, named ''.
    """
    picked = (labelled.filter("doc_id is not null and domain is not null").groupBy("doc_id")
              .agg(F.min(F.col("domain").cast("string")).alias("__domain"))
              .orderBy(F.crc32(F.concat(F.lit("mix"), F.col("doc_id").cast("string"))), "doc_id").limit(max_rows))
    texts = docs.select("doc_id", "text").join(F.broadcast(picked), "doc_id").select(
        "__domain", words_of(F.col("text")).alias("words"))
    share = texts.groupBy("__domain").count().collect()                          # at most one row a labelled document
    if len(share) > MAX_DOMAINS:                                                   # the rarest are one domain
        kept = {r["__domain"] for r in sorted(share, key=lambda r: (-r["count"], r["__domain"]))[:MAX_DOMAINS - 1]}
        texts = texts.withColumn("__domain", F.when(F.col("__domain").isin(sorted(kept)), F.col("__domain")).otherwise(F.lit(REST)))
        share = texts.groupBy("__domain").count().collect()
    domains = sorted(r["__domain"] for r in share)
    if not domains:
        return DomainClassifier([""], np.zeros(1), np.zeros((1, WORD_BUCKETS)))
    at = {d: i for i, d in enumerate(domains)}
    prior = np.zeros(len(domains))
    for r in share:
        prior[at[r["__domain"]]] = r["count"]
    counts = np.zeros((len(domains), WORD_BUCKETS))
    bucket = F.pmod(F.xxhash64("w"), F.lit(WORD_BUCKETS)).alias("bucket")
    for r in texts.select("__domain", F.explode("words").alias("w")).groupBy("__domain", bucket).count().collect():
        counts[at[r["__domain"]], r["bucket"]] = r["count"]
    counts += SMOOTHING
    return DomainClassifier(domains, np.log(prior / prior.sum()),
                            np.log(counts / counts.sum(axis=1, keepdims=True)).round(6))


@dataclass
class Rates:
    """The steps of the fit, one number a domain each; enough to compute any document's rate."""

    domains: list[str]
    steps: list[np.ndarray]
    totals: np.ndarray            # tokens of each domain as they are
    targets: np.ndarray
    reached: np.ndarray

    def rate(self, posterior: Column) -> Column:
        """A document's nonnegative rate from its posterior: all steps from rate 1, each cut off at 0."""
        if not self.steps:
            return F.lit(1.0)
        return F.aggregate(_constant(np.array(self.steps)), F.lit(1.0), lambda r, g: F.greatest(F.lit(0.0), r - _dot(posterior, g)))

    @property
    def misses(self) -> np.ndarray:
        """Each domain's miss as a share of its target (or of a millionth of all tokens)."""
        scale = np.maximum(self.targets, 1e-6 * self.totals.sum())
        return (self.reached - self.targets) / np.maximum(scale, 1e-300)

    @property
    def miss(self) -> float:
        """The largest miss; 0 if all targets are met."""
        return float(np.max(np.abs(self.misses), initial=0.0))


def tempered_weights(totals: np.ndarray, power: float) -> np.ndarray:
    """Target weights proportional to a power of the domains' tokens."""
    w = np.where(totals > 0, np.maximum(totals, 1e-12) ** power, 0.0)
    return w / w.sum() if w.sum() else np.full(len(totals), 1 / max(len(totals), 1))


def fit_rates(members: DataFrame, domains: list[str], weights: dict[str, float] | None = None, power: float = 0.5,
              keep_all: bool = False, passes: int = PASSES, tolerance: float = TOLERANCE) -> Rates:
    """Nonnegative rates whose domain tokens are nearest to the targets, over ``members`` (``n_tokens, posterior``).

    Targets are ``weights`` (by domain; default: tokens to the power ``power``) of the present total, or,
    with ``keep_all``, of the least total at which no domain is thinned.  The squares of the misses are
    weighted so that domains of any size count alike.  One aggregation tries steps of several lengths along
    the gradient, and along the gradient scaled by the live documents' second moments, which is exact where
    it meets no bound; the best one is taken.  The fit ends when the largest miss is below
    ``tolerance`` of its target or no step helps: targets out of reach give the nearest rates, and
    ``Rates.misses`` says by how much they miss.
    """
    d = len(domains)
    p = [F.col("posterior")[i] for i in range(d)]
    pairs = [(i, j) for i in range(d) for j in range(i, d)]
    rates = Rates(domains, [], np.zeros(d), np.zeros(d), np.zeros(d))

    def rated(steps: list[np.ndarray]) -> DataFrame:
        return members.select("n_tokens", "posterior", replace(rates, steps=steps).rate(F.col("posterior")).alias("r"))

    def sums(steps: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
        """Domain tokens after these steps, and the second moments of the documents whose rate is not 0."""
        live = F.when(F.col("r") > 0, F.col("n_tokens")).otherwise(0)
        row = rated(steps).agg(*(F.sum(F.col("r") * F.col("n_tokens") * x) for x in p),
                               *(F.sum(live * p[i] * p[j]) for i, j in pairs)).first()
        got = np.array([x or 0.0 for x in row], float)
        moments = np.zeros((d, d))
        for (i, j), x in zip(pairs, got[d:], strict=True):
            moments[i, j] = moments[j, i] = x
        return got[:d], moments

    def tried(steps: list[np.ndarray], next_steps: list[np.ndarray]) -> np.ndarray:
        """Domain tokens after one more step, for each of several."""
        names = [f"r{k}" for k in range(len(next_steps))]
        more = [F.greatest(F.lit(0.0), F.col("r") - _dot(F.col("posterior"), _constant(g))).alias(x)
                for g, x in zip(next_steps, names, strict=True)]
        row = rated(steps).select("n_tokens", "posterior", *more).agg(
            *(F.sum(F.col(x) * F.col("n_tokens") * q) for x in names for q in p)).first()
        return np.array([x or 0.0 for x in row], float).reshape(-1, d)

    rates.totals, moments = sums([])
    rates.reached = totals = rates.totals
    w = tempered_weights(totals, power) if weights is None else np.array([max(weights.get(x, 0.0), 0.0) for x in domains])
    w = w / w.sum() if w.sum() else np.full(d, 1 / d)
    total = max([t / x for t, x in zip(totals, w, strict=True) if x > 0], default=0.0) if keep_all else totals.sum()
    rates.targets = targets = w * total
    if totals.sum() <= 0:
        return rates
    unit = 1 / np.sqrt(np.maximum(np.diag(moments), 1e-12 * totals.sum()))     # domains of any size weigh alike
    largest = float(np.linalg.eigvalsh(moments * np.outer(unit, unit))[-1])
    for _ in range(passes):
        if rates.miss < tolerance:
            break
        error = unit * (rates.reached - targets)
        exact = np.linalg.lstsq(moments * np.outer(unit, unit), error, rcond=RANK)[0]
        tries = [unit * exact * x for x in EXACT_SHARES] + [unit * error / largest * x for x in GRADIENT_SHARES]
        misses = np.sum((unit * (tried(rates.steps, tries) - targets)) ** 2, axis=1)
        best = int(np.argmin(misses))
        if not misses[best] < float(error @ error) * (1 - GAIN):
            break
        rates.steps = [*rates.steps, tries[best]]
        rates.reached, moments = sums(rates.steps)
    return rates


def copies(rate: Column, id_col: Column, least: int = 0) -> Column:
    """Whole copies that a rate stands for: its floor, and one more with the probability of the rest, by hash."""
    draw = F.pmod(F.xxhash64(F.coalesce(id_col.cast("string"), F.lit("")), F.lit("copies")), F.lit(1 << 30)) / F.lit(float(1 << 30))
    return F.greatest(F.lit(least), F.floor(rate + draw).cast("int"))


def mixed(docs: DataFrame, labelled: DataFrame, weights: dict[str, float] | None = None, power: float = 0.5,
          keep_all: bool = False) -> tuple[DomainClassifier, Rates, DataFrame]:
    """Classifier, fitted rates, and the members table ``doc_id, n_tokens, posterior`` (written)."""
    classifier = fit_classifier(docs, labelled)
    words = docs.select("doc_id", words_of(F.col("text")).alias("words"))
    members = written(words.select("doc_id", F.size("words").cast("long").alias("n_tokens"),
                                   classifier.posterior(F.col("words")).alias("posterior")), "members")
    return classifier, fit_rates(members, classifier.domains, weights, power, keep_all), members


def mixing_rates(docs: DataFrame, labelled: DataFrame, weights: dict[str, float] | None = None, power: float = 0.5
                 ) -> DataFrame:
    """``doc_id, domain, n_tokens, posterior, rate, copies, domain_miss`` of every row.

    ``domain`` is the likeliest one, ``domain_miss`` by what share of its target that domain's tokens are
    off (0 up to the tolerance where the targets can be met).  Null and empty texts have no tokens and the prior as posterior;
    repeated rows and null ids are rated each; an empty table gives no rows.  Other columns are not read.
    """
    classifier, rates, members = mixed(docs, labelled, weights, power)
    best = F.array_position("posterior", F.array_max("posterior")).cast("int")
    names = F.array(*map(F.lit, classifier.domains))
    return members.select("doc_id", F.element_at(names, best).alias("domain"), "n_tokens", "posterior",
                          rates.rate(F.col("posterior")).alias("rate"),
                          F.element_at(_constant(rates.misses), best).alias("domain_miss")).withColumn(
        "copies", copies(F.col("rate"), F.col("doc_id")))


def mixed_documents(docs: DataFrame, labelled: DataFrame, weights: dict[str, float] | None = None, power: float = 0.5
                    ) -> DataFrame:
    """``docs`` with each row repeated by its rate; the total is the least at which every row stays."""
    classifier, rates, _ = mixed(docs, labelled, weights, power, keep_all=True)
    rate = rates.rate(classifier.posterior(words_of(F.col("text"))))
    times = F.transform(F.sequence(F.lit(1), copies(rate, F.col("doc_id"), 1)), lambda k: k)
    return docs.withColumn("__copy", F.explode(times)).select(*(F.col(f"`{c}`") for c in docs.columns))
