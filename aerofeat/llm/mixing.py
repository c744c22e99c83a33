"""Soft-membership mixing: how often to take each document so that the
expected tokens of every domain meet target weights.

1. A classifier learnt from a labelled table gives each document posteriors
   p over the domains (a soft membership, since labels cover few documents):
   naive Bayes over those hashed words whose share differs most significantly
   between the domains. Their log-ratios are summed over a text and divided by
   the root of its number of words, so that long texts do not saturate.
2. A document of t tokens taken at rate r adds r * t * p to the domains'
   expected tokens. Projected-gradient least squares fits rates in
   [0, ``most``] whose sums meet target * total. With c_d the share of domain
   d at rate 1, it minimises sum_d (sum_i r_i t_i p_id / T - target_d)^2 / c_d
   from r_i = 1. The gradient for a document is sum_d p_id miss_d / c_d, so the
   sum of all steps so far is one number for each domain, u_d, and the
   projection of that sum onto the box is r_i = clip(1 - sum_d p_id u_d, 0,
   most): a lazy projection. In this metric the curvature is at most 1, so the
   step is 1; the steps are accelerated by momentum, which starts anew
   whenever the objective rises.

Every pass over documents is a DataFrame aggregate; the driver sees one number
for each domain and pass. The classifier is a table of ``WORDS`` rows at most.
"""

from __future__ import annotations

import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keys import stage

BUCKETS = 1 << 16       # hashed words that are counted
WORDS = 4096            # of them in the classifier, at most
SIGNIFICANT = 4.0       # standard deviations from the expected count that put a word there
SMOOTH = 500.0          # words of the overall distribution added to each domain's counts
TRAIN_DOCS = 20_000     # labelled documents the classifier is fitted on, about and at most
SHARPNESS = 3.0         # weight of a text's summed log-ratios over the root of its words
MOST = 8.0              # largest rate
ROUNDS = 60
TOLERANCE = 1e-4        # largest miss of a target share at which the fit ends
DOMAINS = ("good", "poor", "toxic")
TARGET = {"good": 0.9, "poor": 0.05, "toxic": 0.05}


def domain(quality: Column, toxic: Column) -> Column:
    """The domain a labelled document belongs to; null where no label says."""
    return F.when(toxic == 1, "toxic").when(quality == 1, "good").when(quality == 0, "poor")


def words(text: Column) -> Column:
    return F.split(F.lower(F.coalesce(text, F.lit(""))), "[ \t\n\x0b\f\r]+")


def _buckets(docs: DataFrame, keep: list[str], buckets: int) -> DataFrame:
    """One row per word: ``keep`` and the word's bucket. A text without words
    leaves one row without a bucket."""
    word = docs.select(*keep, F.explode(words(F.col("text"))).alias("w"))
    return word.select(*keep, F.when(F.col("w") != "", F.pmod(F.xxhash64("w"), F.lit(buckets)).cast("int")).alias("b"))


def train(documents: DataFrame, labels: DataFrame, buckets: int = BUCKETS,
          train_docs: int = TRAIN_DOCS) -> tuple[DataFrame, dict[str, float]]:
    """The classifier: (b, w_<domain>...), the log-ratio of a word's share in
    the domain to its share in all; and the domains' shares of labelled words
    (only domains that have some). Labelled ids are thinned by a hash to
    ``train_docs`` documents in expectation; labels that contradict each other
    for one id are settled as toxic first, then poor. Documents sharing an id
    share its label."""
    known = labels.select("doc_id", domain(F.col("quality"), F.col("toxic")).alias("d")) \
        .filter("d is not null and doc_id is not null").groupBy("doc_id").agg(F.max("d").alias("d"))
    known = stage(known, "labelled")
    share = min(1.0, train_docs / max(1, known.count()))
    chosen = stage(known.filter(F.abs(F.xxhash64("doc_id", F.lit(11))) <= F.lit(share * float(1 << 63))), "labelled")
    texts = documents.select("doc_id", "text").join(chosen, "doc_id")
    counts = _buckets(texts, ["d"], buckets).filter("b is not null").groupBy("b").agg(
        *[F.count(F.when(F.col("d") == d, 1)).alias(d) for d in DOMAINS])
    counts = stage(counts.withColumn("n", sum((F.col(d) for d in DOMAINS), F.lit(0))), "counts")
    sums = counts.agg(*[F.sum(d).alias(d) for d in DOMAINS], F.sum("n").alias("n")).first()
    total = float(sums["n"] or 0)
    shares = {d: sums[d] / total for d in DOMAINS if total and sums[d]}
    far = [F.abs(F.col(d) - F.col("n") * s) / F.sqrt(F.col("n") * s + 1) for d, s in shares.items()] or [F.lit(0.0)]
    ratio = [F.log((F.col(d) + SMOOTH * F.col("n") / total) / (F.col("n") / total) / F.lit(total * s + SMOOTH)).alias(f"w_{d}")
             for d, s in shares.items()]
    far = F.greatest(*far) if len(far) > 1 else far[0]
    words = counts.withColumn("far", far).filter(F.col("far") >= SIGNIFICANT).orderBy(F.desc("far"), "b").limit(WORDS)
    return stage(words.select("b", *ratio), "words"), shares


def posteriors(documents: DataFrame, key: str, model: tuple[DataFrame, dict[str, float]], buckets: int = BUCKETS,
               sharpness: float = SHARPNESS) -> DataFrame:
    """(key, tokens, p_<domain>...): softmax of log share + sharpness x summed
    log-ratios / root of the number of words. A text without words gets the
    shares; without a classifier every domain is as likely. Words are summed
    inside the task that reads them, before any shuffle."""
    ratios, shares = model
    rows = _buckets(documents.select(key, "text"), [key], buckets)
    if not shares:
        return rows.groupBy(key).agg(F.count("b").alias("tokens")).select(
            key, "tokens", *[F.lit(1.0 / len(DOMAINS)).alias(f"p_{d}") for d in DOMAINS])
    sums = rows.join(F.broadcast(ratios), "b", "left").groupBy(key).agg(       # WORDS rows at most
        F.count("b").alias("tokens"), *[F.coalesce(F.sum(f"w_{d}"), F.lit(0.0)).alias(f"l_{d}") for d in shares])
    size = F.sqrt(F.greatest(F.col("tokens"), F.lit(1)))
    logit = {d: math.log(s) + sharpness * F.col(f"l_{d}") / size for d, s in shares.items()}
    top = F.greatest(*logit.values()) if len(logit) > 1 else next(iter(logit.values()))
    e = {d: F.exp(x - top) for d, x in logit.items()}
    total = sum(e.values(), F.lit(0.0))
    return sums.select(key, "tokens", *[(e[d] / total if d in shares else F.lit(0.0)).alias(f"p_{d}") for d in DOMAINS])


def fit_rates(members: DataFrame, target: dict[str, float], most: float = MOST, rounds: int = ROUNDS,
              tolerance: float = TOLERANCE) -> tuple[Column, list[list[float]]]:
    """The rate of each row of ``members`` (tokens, p_<domain>...) as one
    expression, and the expected shares after each round. A round is one
    aggregate over ``members``, of one expression with a literal for each
    domain; the best round's is returned."""
    p = [F.col(f"p_{d}") for d in target]
    weigh = sum(target.values())
    goal = [w / weigh for w in target.values()]

    def rate(u: list[float]) -> Column:
        move = sum((x * F.lit(v) for x, v in zip(p, u)), F.lit(0.0))
        return F.least(F.greatest(F.lit(1.0) - move, F.lit(0.0)), F.lit(float(most)))

    first = members.agg(F.sum("tokens"), *[F.sum(F.col("tokens") * x) for x in p]).first()
    total = float(first[0] or 0)
    if not total:
        return F.lit(1.0), []
    scale = [total / x if x else 0.0 for x in first[1:]]
    u = before = [0.0] * len(p)          # where the gradient is taken; the last step's end
    best, best_u, last, age, shares = math.inf, u, math.inf, 0, []
    for _ in range(rounds):
        got = members.agg(*[F.sum(rate(u) * F.col("tokens") * x) for x in p]).first()
        shares.append([float(x) / total for x in got])
        miss = [x - g for x, g in zip(shares[-1], goal)]
        far = sum(c * m * m for c, m in zip(scale, miss))
        if far < best:
            best, best_u = far, u
        if max(map(abs, miss)) <= tolerance:
            break
        age = age + 1 if far <= last else 1
        last = far
        after = [x + c * m for x, c, m in zip(u, scale, miss)]
        push = (age - 1) / (age + 2)
        u, before = [x + push * (x - y) for x, y in zip(after, before)], after
    return rate(best_u), shares


def mix(documents: DataFrame, labels: DataFrame, key: str = "doc_id", target: dict[str, float] | None = None,
        most: float = MOST, rounds: int = ROUNDS, tolerance: float = TOLERANCE, buckets: int = BUCKETS,
        train_docs: int = TRAIN_DOCS, sharpness: float = SHARPNESS) -> DataFrame:
    """(key, tokens, p_good, p_poor, p_toxic, rate) for each distinct key.

    Rows that share a key are mixed as one document of all their words; rows
    with a null key are one document too. A null text has no tokens, even
    posteriors and the rate they imply. Targets that cannot be met within
    [0, ``most``] are approached in the least-squares sense. Without labels
    the posteriors are even. Other columns are ignored."""
    goal = {d: float((target or TARGET).get(d, 0.0)) for d in DOMAINS}
    if min(goal.values()) < 0 or sum(goal.values()) <= 0:
        raise ValueError("target weights must not be negative, and not all zero")
    model = train(documents, labels, buckets, train_docs)
    members = stage(posteriors(documents, key, model, buckets, sharpness), "members")
    rate, _ = fit_rates(members, goal, most, rounds, tolerance)
    return members.withColumn("rate", rate)
