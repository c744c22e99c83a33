"""Model evaluation: ROC points and the 2×2 confusion matrix.

ROC follows the classic definition (as in common Python toolkits of the
reference's era): one point per distinct score, taken in descending score
order, with cumulative true / false positives; interior points that lie on a
straight line with both neighbours are dropped; a first point (0, 0) with
threshold ``max score + 1`` is prepended; rates are divided by the totals.

Distributed prefix sums: a running sum ordered by score over the whole data
would put every distinct score into one task. Instead the distinct (group, score)
rows are dealt into ranges of (group, score), balanced by Spark's sampling, each range of
a group is summed (one row per group and range), the offsets are a running sum
over a group's few ranges, and the running sum inside is a window
partitioned by (group, range). How many ranges there are follows from the counted rows;
a large group spans many, many small groups share one. Neighbours across a range
boundary come from the table of ranges, so the collinearity test needs
no extra shuffle, and Spark chooses how to join that table by its size.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

# --- fixed values -----------------------------------------------------------
ROWS_PER_RANGE = 500_000    # distinct scores (or points) that one task sorts
# ---------------------------------------------------------------------------


def _dealt(rows: DataFrame, by: list[str], name: str, n_ranges: int | None) -> DataFrame:
    """The rows with their range ``_r`` in the order of ``by``, written. The
    number of ranges follows from the rows, which are written and counted first."""
    rows = stage(rows, name)
    n = n_ranges or -(-rows.count() // ROWS_PER_RANGE)
    if n <= 1:
        # zero, but a column to the planner, so that joins and windows stay keyed
        return rows.withColumn("_r", F.spark_partition_id() * F.lit(0))
    return stage(rows.repartitionByRange(n, *by).withColumn("_r", F.spark_partition_id()), name)


def roc_curve(scored: DataFrame, label: str = "target", score: str = "score",
              drop_intermediate: bool = True, n_ranges: int | None = None,
              by: list[str] | None = None) -> DataFrame:
    """ROC points ``(by..., threshold, fpr, tpr)`` of ``score`` against boolean
    ``label``, one curve for the table or for each value of ``by`` (a month, a day)
    in one plan. A null or NaN score, or a null label, fails the job: a curve
    over the other rows alone would look complete. Callers that mean to leave
    such rows out filter them first.

    ``n_ranges`` sets how many score ranges the prefix sum is split into, instead of one for each
    ``ROWS_PER_RANGE`` distinct scores; the points are the same for any. The distinct scores
    are written to the shared folder, so that all passes see the same ranges.
    """
    by = list(by or [])
    s = F.col(score).cast("double")
    gap = s.isNull() | F.isnan(s) | F.col(label).isNull()
    s = F.when(gap, F.raise_error(F.lit(f"row without {score} or {label}")).cast("double")).otherwise(s)
    pos = F.when(F.col(label), 1).otherwise(0).cast("long")
    per = scored.groupBy(*by, s.alias(score)).agg(F.sum(pos).alias("_p"), F.sum(1 - pos).alias("_n"))
    per = _dealt(per, [*by, score], "roc_scores", n_ranges)

    # one row per group and range: totals, first (highest-score) row's counts
    rng = per.groupBy(*by, "_r").agg(
        F.sum("_p").alias("_rp"), F.sum("_n").alias("_rn"), F.count(F.lit(1)).alias("_rc"),
        F.max_by(F.struct("_p", "_n"), score).alias("_first"),
        F.max(score).alias("_rmax"))
    group = by or [F.lit(0)]
    wd = Window.partitionBy(*group).orderBy(F.desc("_r"))
    before = wd.rowsBetween(Window.unboundedPreceding, -1)
    whole = wd.rowsBetween(Window.unboundedPreceding, Window.unboundedFollowing)
    rng = rng.select(
        *by, "_r", "_rc", "_rmax",
        F.coalesce(F.sum("_rp").over(before), F.lit(0)).alias("_bp"),
        F.coalesce(F.sum("_rn").over(before), F.lit(0)).alias("_bn"),
        F.lag("_r").over(wd).isNotNull().alias("_has_prev"),
        F.lead("_first").over(wd).alias("_next_first"),
        (F.col("_rp")).alias("_rp"), (F.col("_rn")).alias("_rn"),
        F.sum("_rp").over(whole).alias("_tot_p"), F.sum("_rn").over(whole).alias("_tot_n"),
        F.max("_rmax").over(whole).alias("_max"))

    w = Window.partitionBy(*by, "_r").orderBy(F.desc(score))
    run = w.rowsBetween(Window.unboundedPreceding, 0)
    left, right = per.alias("s"), rng.alias("t")
    same = F.col("s._r") == F.col("t._r")
    for c in by:
        same = same & F.col(f"s.{c}").eqNullSafe(F.col(f"t.{c}"))
    pts = left.join(right, same).select(
        *[F.col(f"s.{c}").alias(c) for c in by], score, F.col("s._r").alias("_r"), "_p", "_n",
        "_rc", "_bp", "_bn", "_rp", "_rn", "_has_prev", "_next_first", "_tot_p", "_tot_n")
    pts = pts.select(
        "*", (F.col("_bp") + F.sum("_p").over(run)).alias("tps"),
        (F.col("_bn") + F.sum("_n").over(run)).alias("fps"), F.row_number().over(w).alias("_i"))
    if drop_intermediate:
        # same partitioning and order as above: no extra shuffle
        pts = pts.select("*", F.lag("tps").over(w).alias("_lt"), F.lag("fps").over(w).alias("_lf"),
                         F.lead("tps").over(w).alias("_nt"), F.lead("fps").over(w).alias("_nf"))
        first, last = F.col("_i") == 1, F.col("_i") == F.col("_rc")
        # neighbours across a range edge: end of the previous range, or the
        # first row of the next one (both from the table of ranges)
        prev_t = F.when(~first, F.col("_lt")).when(F.col("_has_prev"), F.col("_bp"))
        prev_f = F.when(~first, F.col("_lf")).when(F.col("_has_prev"), F.col("_bn"))
        next_t = F.when(~last, F.col("_nt")).when(
            F.col("_next_first").isNotNull(), F.col("_bp") + F.col("_rp") + F.col("_next_first._p"))
        next_f = F.when(~last, F.col("_nf")).when(
            F.col("_next_first").isNotNull(), F.col("_bn") + F.col("_rn") + F.col("_next_first._n"))
        keep = (prev_t.isNull() | next_t.isNull()
                | ((next_t - 2 * F.col("tps") + prev_t) != 0)
                | ((next_f - 2 * F.col("fps") + prev_f) != 0))
        pts = pts.filter(keep)
    rates = pts.select(
        *by, F.col(score).alias("threshold"),
        # a class that never occurs gives NaN-free nulls instead of 0/0
        F.try_divide(F.col("fps").cast("double"), F.col("_tot_n")).alias("fpr"),
        F.try_divide(F.col("tps").cast("double"), F.col("_tot_p")).alias("tpr"))
    origin = rng.groupBy(*by).agg((F.max("_max") + 1).alias("threshold")) \
        .filter(F.col("threshold").isNotNull()) \
        .select(*by, "threshold", F.lit(0.0).alias("fpr"), F.lit(0.0).alias("tpr"))
    return origin.unionByName(rates)


def roc_area(points: DataFrame, n_ranges: int | None = None) -> DataFrame:
    """One row (fpr_end, tpr_end, area): the largest rates of ROC ``points``
    and the trapezoids between neighbours in the order of (fpr, tpr). Points are
    dealt into ranges and written; steps inside a range use
    ``lag``, and those between ranges one row for each range. Steps with a null
    rate are left out; null where no step is left."""
    dealt = _dealt(points.select("fpr", "tpr"), ["fpr", "tpr"], "roc", n_ranges)
    p = F.struct("fpr", "tpr")
    wide = lambda a, b: (b["fpr"] - a["fpr"]) * (a["tpr"] + b["tpr"]) / 2
    w = Window.partitionBy("_r").orderBy("fpr", "tpr")
    rng = dealt.select("_r", p.alias("p"), F.lag(p).over(w).alias("before")) \
        .groupBy("_r").agg(F.sum(wide(F.col("before"), F.col("p"))).alias("inside"),
                           F.min("p").alias("first"), F.max("p").alias("last"))
    # one row per range
    edge = rng.select("inside", "last", wide(F.lag("last").over(Window.orderBy("_r")), F.col("first")).alias("edge"))
    zero = F.lit(0.0)
    step = F.when(F.coalesce("inside", "edge").isNotNull(), F.coalesce("inside", zero) + F.coalesce("edge", zero))
    return edge.agg(F.max("last.fpr").alias("fpr_end"), F.max("last.tpr").alias("tpr_end"), F.sum(step).alias("area"))


def confusion_matrix(df: DataFrame, actual: str = "target", predicted: str = "prediction",
                     by: list[str] | None = None) -> DataFrame:
    """Four rows ``(by..., actual, predicted, n)`` of the 2×2 grid, zero counts
    included, for the whole table or each value of ``by`` (a day, a month). One
    partial aggregate (four counters) then a ``stack``: no join."""
    a, p = F.col(actual), F.col(predicted)
    cells = [(False, False), (False, True), (True, False), (True, True)]
    counts = df.groupBy(*(by or [])).agg(*[
        F.count(F.when((a == F.lit(x)) & (p == F.lit(y)), 1)).alias(f"c{i}")
        for i, (x, y) in enumerate(cells)])
    stack = "stack(4, " + ", ".join(
        f"{str(x).lower()}, {str(y).lower()}, c{i}" for i, (x, y) in enumerate(cells)) \
        + ") as (actual, predicted, n)"
    return counts.selectExpr(*(by or []), stack)
