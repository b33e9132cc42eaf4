"""Mixing documents to target domain weights with soft memberships.

1. A naive-Bayes classifier is fitted on a bounded sample of the labelled documents: per domain the
   documents that hold a feature (a word, or a bin of a shape measure: capitals, symbols,
   repetition, length) are counted, and the features whose share differs significantly between
   the domains are kept (at most MAX_FEATURES).
2. Every document gets the posterior of each domain from the features it holds, and its tokens
   (words).
3. Nonnegative rates are fitted so that the expected domain token totals
   ``S_k = sum_d rate_d * tokens_d * p_dk`` match the targets ``T_k``: projected gradient steps of
   the least squares with the projection taken after the summed moves,
   ``rate_d = max(0, 1 - sum_k p_dk * l_k)``, ``l <- l + a (M + e M0)^-1 (S - T - e M0 l)``,
   ``M_kl = sum_d tokens_d p_dk p_dl`` over the documents whose rate isn't zero, M0 the same over all.
   These are the rates that minimise the misfit ``(S - T) M0^-1 (S - T)`` plus e = NEARNESS times the
   squared distance from one, which picks among rates that meet the targets equally well.  A
   step is one aggregate of a few sums and is halved until the objective falls; a rate needs only
   the K-vector l, so no rate is ever collected, joined or shuffled.  The steps end when the
   targets are met to TOLERANCE or, where no rates meet them, when the projected gradient
   vanishes to TOLERANCE: the least squares, with a warning that names the gap left.  Steps
   that do neither in MAX_SUMS aggregates are an error.
4. A document is taken floor(rate) times, and once more with the fraction's probability, decided
   by a hash of its id.

All columns are built from DataFrame functions.  Defined results: NULL text has no words (its
posterior rests on its shape bins, its tokens are 0); labels without a known document, NULL labels
and unknown domains are ignored, of several labels for an id the first domain in order counts;
without labels the posteriors are uniform; repeated rows each get the same rate; an empty table
gives an empty result; extra columns are ignored (``rates``) or carried (``mix``).
"""

from __future__ import annotations

import math
import warnings
from functools import reduce
from operator import add

import numpy as np
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F

from tallyspark.llm.text import as_they_are, columns_free_of, let, words
from tallyspark.operators.materialize import materialize

MAX_LABELLED = 10_000        # labelled documents the classifier is fitted on (smallest id hashes)
MAX_FEATURES = 400
# A feature counts when so many documents hold it, its share in a domain is off by so many standard
# deviations, and by so large a factor (natural logarithm): common words that hang on the length
# or the language of a text, and on each other, are left out.
MIN_DOCS, MIN_SCORE, MIN_EFFECT = 10, 4.0, 1.0
SMOOTHING = 0.5
OTHER_THAN_MARKS = r"[^#*$%&|<>!{}=\\]+"      # fixed value: runs of anything but junk marks
MAX_SUMS = 300               # safety bound: more aggregates than that are an error
NEARNESS = 1e-9              # weight of the squared distance of the rates from one
LEAST_SLOPE = 1e-4           # share of the foreseen fall that a step has to bring
TOLERANCE = 1e-6             # largest gap between a domain total and its target, by the budget

# The domains of the labels table and the weights wanted (production parameters).
TARGETS = {"high": 0.90, "low": 0.07, "toxic": 0.03}


def label_domain(labels: DataFrame) -> DataFrame:
    """(id, domain) of the labels table: toxic, else low or high quality."""
    domain = (F.when(F.col("toxic") == 1, "toxic").when(F.col("quality") == 0, "low")
              .when(F.col("quality") == 1, "high"))
    return labels.select(F.col("doc_id").alias("id"), domain.alias("domain"))


def shape_bins(text: Column, word_array: Column) -> Column:
    """One feature for each shape measure: tenths of a share, or the binary length."""
    n = F.greatest(F.char_length(text), F.lit(1))
    marks = F.char_length(F.regexp_replace(text, OTHER_THAN_MARKS, ""))
    capitals = F.char_length(F.regexp_replace(text, "[^A-Z]+", ""))
    distinct = F.size(F.array_distinct(word_array)) / F.greatest(F.size(word_array), F.lit(1))

    def tenths(share: Column) -> Column:
        return F.floor(10 * share).cast("int").cast("string")
    return F.array(
        F.concat(F.lit("\n capitals "), tenths(capitals / n)),
        F.concat(F.lit("\n marks "), F.floor(40 * marks / n).cast("int").cast("string")),
        F.concat(F.lit("\n distinct "), tenths(distinct)),
        F.concat(F.lit("\n length "), F.floor(F.log2(F.size(word_array) + 1)).cast("int").cast("string")))


def observed(text: Column) -> Column:
    """Struct of the number of words and the features (words and shape bins) of a text.  A shape
    bin begins with a line break and a blank, which no word holds."""
    t = F.coalesce(text, F.lit(""))
    return let(words(t), lambda w: F.struct(F.size(w).cast("long").alias("tokens"),
                                            F.concat(w, shape_bins(t, w)).alias("features")))


class Classifier:
    """Log priors and, for each kept feature, one log ratio per domain (a few hundred KB)."""

    def __init__(self, domains: list[str], priors: list[float], features: list[str],
                 ratios: list[list[float]]):
        self.domains, self.priors = domains, priors
        self.features, self.ratios = features, ratios
        # the features of a domain, and what their absence says for each domain
        self.own = [[f for f, r in zip(features, ratios) if r[j] >= MIN_EFFECT] for j in range(len(domains))]
        self.without = [[0.0] * len(domains) for _ in domains]

    def holds(self, features: Column, j: int) -> Column:
        """Is a feature of domain j among these?"""
        own = F.split(F.lit("\t".join(self.own[j])), "\t")
        return F.arrays_overlap(features, own) if self.own[j] else F.lit(False)

    def posteriors(self, features: Column) -> Column:
        """Array of the posterior of each domain, in the order of ``domains``."""
        k = len(self.domains)
        if not self.features:
            return F.array(*(F.lit(math.exp(p)) for p in self.priors))
        # literals: folded to constants by the optimizer, so that a task holds them once
        known = F.split(F.lit("\t".join(self.features)), "\t")
        tables = [F.split(F.lit("\t".join(repr(r[j]) for r in self.ratios)), "\t").cast("array<double>")
                  for j in range(k)]
        places = F.transform(F.array_intersect(features, known),
                             lambda f: F.array_position(known, f).cast("int"))

        flags = [F.split(F.lit("\t".join(str(f in set(own)) for f in self.features)), "\t").cast("array<boolean>")
                 for own in self.own]

        def log(at: Column, j: int) -> Column:
            out = F.aggregate(at, F.lit(float(self.priors[j])),
                              lambda acc, i: acc + F.element_at(tables[j], i))
            for g in range(k):
                some = F.exists(at, lambda i: F.element_at(flags[g], i))
                out = out + F.when(some, 0.0).otherwise(float(self.without[g][j]))
            return out

        def shares(logs: Column) -> Column:
            top = F.array_max(logs)
            scaled = F.transform(logs, lambda x: F.exp(x - top))
            return let(scaled, lambda e: F.transform(
                e, lambda x: x / F.aggregate(e, F.lit(0.0), lambda a, b: a + b)))
        return let(places, lambda at: let(F.array(*(log(at, j) for j in range(k))), shares))


def fit_classifier(docs: DataFrame, labels: DataFrame, domains: list[str],
                   id_col: str = "doc_id", text_col: str = "text") -> Classifier:
    """``labels`` has (id, domain).  Reads the whole documents; only features of the sample's
    documents are counted."""
    k = len(domains)
    order = F.array_position(F.array(*map(F.lit, domains)), F.col("domain"))
    sample = (labels.filter(F.col("domain").isin(domains)).filter("id IS NOT NULL")
              .groupBy("id").agg(F.min(order).cast("int").alias("k"))
              .orderBy(F.xxhash64("id"), "id").limit(MAX_LABELLED))
    rows = (docs.select(F.col(id_col).alias("id"), F.col(text_col).alias("text"))
            .join(F.broadcast(sample), "id")                      # at most MAX_LABELLED rows
            .select("k", F.array_distinct(observed(F.col("text"))["features"]).alias("features")))
    rows = materialize(rows)
    per_domain = {r["k"]: r["count"] for r in rows.groupBy("k").count().collect()}
    n_k = [per_domain.get(j + 1, 0) for j in range(k)]
    n = sum(n_k)
    priors = [math.log((c + 1) / (n + k)) for c in n_k]
    if not n:
        return Classifier(domains, priors, [], [])
    counts = (rows.select("k", F.explode("features").alias("f")).groupBy("f")
              .agg(*(F.sum((F.col("k") == j + 1).cast("long")).alias(f"n{j}") for j in range(k)),
                   F.count(F.lit(1)).alias("n")).filter(F.col("n") >= MIN_DOCS))
    share = F.col("n") / n
    z = F.greatest(F.lit(0.0), *(F.abs(F.col(f"n{j}") / max(c, 1) - share)
                                 / F.sqrt(F.greatest(share * (1 - share), F.lit(1e-9)) / max(c, 1))
                                 for j, c in enumerate(n_k)))
    usual = F.log((F.col("n") + SMOOTHING) / (n + 2 * SMOOTHING))
    effect = F.greatest(F.lit(0.0), *(F.abs(F.log((F.col(f"n{j}") + SMOOTHING) / (c + 2 * SMOOTHING)) - usual)
                                      for j, c in enumerate(n_k)))
    kept = (counts.withColumns({"z": z, "effect": effect})
            .filter((F.col("z") >= MIN_SCORE) & (F.col("effect") >= MIN_EFFECT) & ~F.col("f").contains("\t"))
            .orderBy(F.desc("z"), "f").limit(MAX_FEATURES).collect())
    ratios = [[math.log((r[f"n{j}"] + SMOOTHING) / (c + 2 * SMOOTHING))
               - math.log((r["n"] + SMOOTHING) / (n + 2 * SMOOTHING)) for j, c in enumerate(n_k)]
              for r in kept]
    model = Classifier(domains, priors, [r["f"] for r in kept], ratios)
    # that a text holds none of the features of a domain speaks too: once a domain, since the
    # features hang on each other
    none = rows.groupBy("k").agg(*(F.sum((~model.holds(F.col("features"), g)).cast("long")).alias(f"g{g}")
                                   for g in range(k))).collect()
    for g in range(k):
        missing = {r["k"] - 1: r[f"g{g}"] for r in none}
        usual_missing = (sum(missing.values()) + SMOOTHING) / (n + 2 * SMOOTHING)
        model.without[g] = [math.log((missing.get(j, 0) + SMOOTHING) / (c + 2 * SMOOTHING) / usual_missing)
                            for j, c in enumerate(n_k)]
    return model


def rate_column(p: Column, steps: list[list[float]]) -> Column:
    """The rate after the steps: their sum moves it from one, projected once."""
    if not steps:
        return F.lit(1.0)
    along = (F.get(p, j) * float(l) for j, l in enumerate(np.sum(steps, axis=0)))
    return F.greatest(F.lit(0.0), F.lit(1.0) - reduce(add, along))


def fit_rates(members: DataFrame, targets: list[float]) -> list[list[float]]:
    """The steps that bring the domain totals of ``members`` (tokens, p) to the target shares of
    all tokens."""
    k = len(targets)
    t = F.col("tokens").cast("double")
    upper = [(i, j) for i in range(k) for j in range(i, k)]

    def sums(steps: list[list[float]]) -> tuple[np.ndarray, np.ndarray, float, float]:
        """Domain totals, M of the moving documents, half the squared rates, all tokens."""
        rows = members.select(t.alias("t"), "p", rate_column(F.col("p"), steps).alias("rate"))
        p = [F.get("p", j) for j in range(k)]
        moving = F.when(F.col("rate") > 0, F.col("t"))
        r = rows.agg(F.sum("t").alias("all"), F.sum(F.col("t") * F.col("rate") * F.col("rate") / 2).alias("v"),
                     *(F.sum(F.col("t") * F.col("rate") * p[j]).alias(f"s{j}") for j in range(k)),
                     *(F.sum(moving * p[i] * p[j]).alias(f"m{i}_{j}") for i, j in upper)).first()
        m = np.array([[r[f"m{min(i, j)}_{max(i, j)}"] or 0.0 for j in range(k)] for i in range(k)])
        return np.array([r[f"s{j}"] or 0.0 for j in range(k)]), m, r["v"] or 0.0, r["all"] or 0.0

    totals, m, value, budget = sums([])
    if not budget:
        return []
    every = m                            # no rate is zero yet
    asked = np.array(targets) * budget
    # what no rates can bring (no token has such memberships) is left out of the steps
    wanted = every @ np.linalg.pinv(every, 1e-12, hermitian=True) @ asked
    steps: list[list[float]] = []
    moved, taken = np.zeros(k), 1
    while True:
        slope = totals - wanted - NEARNESS * every @ moved
        if np.abs(totals - asked).max() <= TOLERANCE * budget:
            return steps
        if np.abs(slope).max() <= TOLERANCE * budget:
            break                        # the least squares: no rates meet the targets
        step = np.linalg.pinv(m + NEARNESS * every, 1e-15, hermitian=True) @ slope
        share = 1.0
        while True:
            if taken >= MAX_SUMS:
                raise RuntimeError(f"rates not settled after {taken} sums: gap {(totals - asked) / budget}")
            trial = [*steps, (share * step).tolist()]
            new = moved + share * step
            totals_new, m_new, half, _ = sums(trial)
            taken += 1
            value_new = half + new @ wanted + NEARNESS / 2 * new @ every @ new
            if value_new <= value - LEAST_SLOPE * share * (slope @ step):
                break
            share /= 2                   # a step too far is taken again by half
        steps, moved, totals, m, value = trial, new, totals_new, m_new, value_new
    warnings.warn(f"no rates meet the targets {targets}: domain totals are off by "
                  f"{((totals - asked) / budget).tolist()} of all tokens", stacklevel=2)
    return steps


def copies_of(rate: Column, id_col: Column) -> Column:
    """How often a document is taken: the whole part, and the fraction by a hash of the id."""
    draw = F.pmod(F.xxhash64(F.lit("mix"), id_col), F.lit(1 << 24)) / float(1 << 24)
    return F.floor(rate + draw).cast("int")


def rates(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None,
          id_col: str = "doc_id", text_col: str = "text") -> tuple[DataFrame, list[list[float]], Classifier]:
    """(members, steps, classifier); members: one row per document with id, tokens, p, rate, copies."""
    targets = targets or TARGETS
    total = sum(targets.values())
    classifier = fit_classifier(docs, labels, list(targets), id_col, text_col)
    seen = docs.select(F.col(id_col).alias("id"), observed(F.col(text_col)).alias("seen"))
    members = materialize(seen.select(
        "id", F.col("seen.tokens").alias("tokens"), classifier.posteriors(F.col("seen.features")).alias("p")))
    steps = fit_rates(members, [w / total for w in targets.values()])
    rate = rate_column(F.col("p"), steps)
    members = members.withColumn("rate", rate).withColumn("copies", copies_of(F.col("rate"), F.col("id")))
    return members, steps, classifier


def mix(docs: DataFrame, labels: DataFrame, targets: dict[str, float] | None = None,
        id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """The documents, each as often as its rate says, with their columns."""
    _, steps, classifier = rates(docs, labels, targets, id_col, text_col)
    n = columns_free_of(docs.columns, "seen", "copies", "copy_no")
    rows = docs.withColumn(n["seen"], observed(F.col(text_col)))
    p = classifier.posteriors(F.col(n["seen"])["features"])
    rate = let(p, lambda q: rate_column(q, steps))
    rows = rows.withColumn(n["copies"], copies_of(rate, F.col(id_col))).filter(F.col(n["copies"]) > 0)
    return rows.withColumn(n["copy_no"], F.explode(F.sequence(F.lit(1), F.col(n["copies"])))
                           ).select(*as_they_are(docs.columns))


def op1_source_mixing(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = spark.read.parquet(f"{sf_dir}/documents.parquet").select("doc_id", "text")
    labels = label_domain(spark.read.parquet(f"{sf_dir}/labels.parquet"))
    members, _, classifier = rates(docs, labels)
    return members.select(F.col("id").alias("doc_id"), "tokens",
                          *(F.get("p", j).alias(f"p_{d}") for j, d in enumerate(classifier.domains)),
                          "rate", "copies")
