"""Quality rules: base statistics of a text, and a learned decision list.

Everything is DataFrame expressions. Statistics are computed inside each row
(no row is exploded or shuffled): the 8-word windows of a text are hashed by
doubling (pairs of words, pairs of pairs, ...), and only texts in which a window
stands twice have their windows sorted.

The list is learnt by sequential covering on the labelled texts that pass the
base rules: grow a conjunction of threshold conditions by information gain on
two thirds of the labels, prune its last conditions on the other third, keep
it while it is precise there, take away what it covers, and go on. A step is
one aggregate over (feature, bin, label); the rules come out as one ordered CASE
expression.
"""

from __future__ import annotations

import functools
import math

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from .keys import stage

SPACE = " \t\n\x0b\f\r"
SYMBOLS = "#*$%&|<>"
RUN = 8                  # words of a window (a power of two)
MIN_WORDS = 20
REPEAT_SHARE = 30        # percent of words in repeated windows that is too many
CUTS = 24                # thresholds tried for a feature
MOST_RULES = 8
MOST_CONDITIONS = 3
PRECISION = 0.9          # of a rule on the pruning set
LEAST_COVER = 10         # bad texts a rule must cover there

FEATURES = {
    "n_words": "n_words",
    "chars_per_word": "word_chars / n_words",
    "symbols_per_word": "n_symbols / n_words",
    "dup_line_share": "n_dup_lines / n_lines",
    "repeat_share": "n_repeat_words / n_words",
    "distinct_share": "n_distinct / n_words",
    "upper_share": "n_upper / word_chars",
    "punctuation_per_word": "n_punctuation / n_words",
    "digit_share": "n_digits / word_chars",
}


def _without(text: Column, chars: str) -> Column:
    return F.length(text) - F.length(F.translate(text, chars, ""))


def _pairs(a: Column, n: Column, step: int) -> Column:
    """Hashes of each element with the one ``step`` later; ``n`` of them."""
    n = F.greatest(n, F.lit(0))
    return F.zip_with(F.slice(a, F.lit(1), n), F.slice(a, F.lit(1 + step), n), lambda x, y: F.xxhash64(x, y))


def base_statistics(documents: DataFrame, keep: list[str]) -> DataFrame:
    """``keep``, then n_words, word_chars, n_symbols, n_dup_lines,
    n_repeat_words, and the other counts that FEATURES use. A null text counts
    as empty."""
    text = F.coalesce("text", F.lit(""))
    trimmed = F.btrim(text, F.lit(SPACE))
    d = documents.select(
        *keep, text.alias("t"),
        F.when(trimmed != "", F.split(trimmed, f"[{SPACE}]+")).otherwise(F.array().cast("array<string>")).alias("w"),
        F.filter(F.split(text, "\n", -1), lambda x: F.btrim(x, F.lit(SPACE)) != "").alias("lines"))
    d = d.select(
        *keep, F.size("w").alias("n"),
        F.transform("w", lambda x: F.xxhash64(x)).alias("h"),
        F.size(F.array_distinct("w")).alias("n_distinct"),
        F.size("lines").alias("n_lines"), (F.size("lines") - F.size(F.array_distinct("lines"))).alias("n_dup_lines"),
        (F.length("t") - _without(F.col("t"), SPACE)).alias("word_chars"),
        _without(F.col("t"), SYMBOLS).alias("n_symbols"),
        _without(F.col("t"), "ABCDEFGHIJKLMNOPQRSTUVWXYZ").alias("n_upper"),
        _without(F.col("t"), ".,;:!?").alias("n_punctuation"), _without(F.col("t"), "0123456789").alias("n_digits"))
    counts = ["n_distinct", "n_lines", "n_dup_lines", "word_chars", "n_symbols", "n_upper", "n_punctuation", "n_digits"]
    step = 1
    while step < RUN:
        d = d.select(*keep, *counts, "n", _pairs(F.col("h"), F.col("n") - (2 * step - 1), step).alias("h"))
        step *= 2
    # only where a window stands twice: windows sorted by hash, with their places
    twice = F.size(F.array_distinct("h")) < F.size("h")
    d = d.select(*keep, *counts, "n", F.when(twice, F.sort_array(F.transform(
        "h", lambda x, i: F.struct(x.alias("h"), i.alias("p"))))).alias("s"))
    m = F.size("s") - 1
    # neighbours with one hash: both their places
    d = d.select(*keep, *counts, "n", F.when(F.col("s").isNotNull(), F.zip_with(
        F.slice("s", F.lit(1), m), F.slice("s", F.lit(2), m),
        lambda a, b: F.when(a["h"] == b["h"], F.array(a["p"], b["p"])))).alias("s"))
    d = d.select(*keep, *counts, "n", F.sort_array(F.array_distinct(F.flatten(F.array_compact("s")))).alias("p"))
    k = F.size("p") - 1
    covered = F.aggregate(F.zip_with(F.slice("p", F.lit(1), k), F.slice("p", F.lit(2), k), lambda a, b: F.least(b - a, F.lit(RUN))),
                          F.lit(RUN), lambda acc, x: acc + x)
    d = d.withColumn("r", F.when(F.col("p").isNotNull(), covered).otherwise(0))
    return d.select(*keep, *[F.col(a).cast("long").alias(b) for a, b in (
        ("n", "n_words"), ("word_chars", "word_chars"), ("n_symbols", "n_symbols"), ("n_dup_lines", "n_dup_lines"),
        ("r", "n_repeat_words"), ("n_distinct", "n_distinct"), ("n_lines", "n_lines"), ("n_upper", "n_upper"),
        ("n_punctuation", "n_punctuation"), ("n_digits", "n_digits"))])


def base_failed() -> Column:
    return (F.col("n_words") < MIN_WORDS) | (100 * F.col("n_repeat_words") > REPEAT_SHARE * F.col("n_words"))


Condition = tuple[str, str, float]      # feature, "<=" or ">", threshold


def _value(feature: str) -> Column:
    top, _, bottom = FEATURES[feature].partition(" / ")
    return F.col(top) / F.nullif(F.col(bottom), F.lit(0)) if bottom else F.col(top).cast("double")


def _holds(c: Condition) -> Column:
    v = _value(c[0])
    return F.coalesce(v <= c[2] if c[1] == "<=" else v > c[2], F.lit(False))


def _all(rule: list[Condition]) -> Column:
    return functools.reduce(Column.__and__, map(_holds, rule), F.lit(True))


def decision_list(rules: list[list[Condition]]) -> Column:
    """The first rule that covers a row, as a string; null where none does."""
    out = None
    for rule in rules:
        name = F.lit(" and ".join(f"{f} {op} {x:.6g}" for f, op, x in rule))
        out = F.when(_all(rule), name) if out is None else out.when(_all(rule), name)
    return F.lit(None).cast("string") if out is None else out


def _grow(rows: DataFrame, cuts: dict[str, list[float]], rule: list[Condition]) -> Condition | None:
    """The condition with the largest FOIL gain among rows the rule covers."""
    names = [f for f in cuts if cuts[f]]
    if not names:
        return None
    bins = [F.struct(F.lit(i).alias("f"), sum(((_value(f) > c).cast("int") for c in cuts[f]), F.lit(0)).alias("b"))
            for i, f in enumerate(names)]
    counts = rows.filter(_all(rule)).select("bad", F.explode(F.array(*bins)).alias("x")).filter("x.b is not null") \
        .groupBy("x.f", "x.b").agg(F.sum("bad").alias("bad"), F.count(F.lit(1)).alias("n")).collect()
    best, gain = None, 0.0
    for i, f in enumerate(names):
        hist = {r["b"]: (r["bad"], r["n"]) for r in counts if r["f"] == i}
        bad, n = (sum(x[j] for x in hist.values()) for j in (0, 1))
        if not bad or bad == n:
            continue
        below = [0, 0]
        for b, cut in enumerate(cuts[f]):
            below = [x + y for x, y in zip(below, hist.get(b, (0, 0)))]
            for op, (p, t) in (("<=", below), (">", (bad - below[0], n - below[1]))):
                if p:
                    got = p * (math.log2(p / t) - math.log2(bad / n))
                    if got > gain + 1e-9:
                        best, gain = (f, op, cut), got
    return best


def learn_rules(labelled: DataFrame, precision: float = PRECISION, least_cover: int = LEAST_COVER,
                most_rules: int = MOST_RULES, most_conditions: int = MOST_CONDITIONS,
                cuts: int = CUTS) -> list[list[Condition]]:
    """Rules for bad texts from rows of statistics with ``doc_id`` and ``bad``
    (0 or 1). Thresholds are quantiles of the labelled rows; every labelled
    row counts."""
    rows = labelled.withColumn("prune", F.pmod(F.xxhash64("doc_id", F.lit(5)), F.lit(3)) == 0)
    shares = [(i + 0.5) / cuts for i in range(cuts)]
    got = rows.agg(*[F.percentile_approx(_value(f), shares, 10_000).alias(f) for f in FEATURES]).first()
    limits = {f: sorted(set(got[f] or [])) for f in FEATURES}
    rules: list[list[Condition]] = []
    for _ in range(most_rules):
        left = rows.filter(decision_list(rules).isNull())
        rule: list[Condition] = []
        while len(rule) < most_conditions:
            c = _grow(left.filter("not prune"), limits, rule)
            if c is None:
                break
            rule.append(c)
        if not rule:
            break
        prefixes = [rule[:i + 1] for i in range(len(rule))]
        seen = left.filter("prune").agg(*[x for i, p in enumerate(prefixes) for x in (
            F.sum(F.when(_all(p), F.col("bad"))).alias(f"bad{i}"), F.count(F.when(_all(p), 1)).alias(f"n{i}"))]).first()
        worth = [((seen[f"bad{i}"] or 0) / seen[f"n{i}"] if seen[f"n{i}"] else 0.0, seen[f"bad{i}"] or 0)
                 for i in range(len(prefixes))]
        fit = [i for i, (share, bad) in enumerate(worth) if share >= precision and bad >= least_cover]
        if not fit:
            break
        rules.append(prefixes[max(fit, key=lambda i: (2 * worth[i][0] - 1) * worth[i][1])])
    return rules


def judge(documents: DataFrame, labels: DataFrame, **params) -> DataFrame:
    """Per row: doc_id, the base statistics, base_failed, rule (the list's
    first that covers it) and kept (not base_failed and no rule).

    ``labels``: doc_id, quality (0 bad, 1 good); ids labelled both ways count
    as bad, rows without id or quality as unlabelled. Without labels no rule is
    learnt. Documents sharing an id are judged one by one; other columns are
    ignored."""
    stats = stage(base_statistics(documents, ["doc_id"]), "statistics")
    known = labels.filter("doc_id is not null and quality is not null").groupBy("doc_id") \
        .agg((1 - F.min("quality")).cast("long").alias("bad"))
    labelled = stage(stats.filter(~base_failed()).join(known, "doc_id"), "labelled")
    rules = learn_rules(labelled, **params)
    out = stats.withColumn("base_failed", base_failed()).withColumn("rule", decision_list(rules))
    return out.withColumn("kept", ~F.col("base_failed") & F.col("rule").isNull())
