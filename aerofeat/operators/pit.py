"""Feature-table operators: upsert of a new load, latest value per entity, and
the point-in-time (as-of) lookup of features for a list of keys.

Feature tables are keyed by (entity id, feature time). A feature row is the
entity id, the feature time and any number of value columns.
"""

from __future__ import annotations

from typing import NamedTuple

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..session import stage

# --- fixed values -----------------------------------------------------------
LOAD_ID = "load_id"
# ---------------------------------------------------------------------------


def upsert(rows: DataFrame, entity_id: str, feature_time: str, features: list[str],
           load_id: str = LOAD_ID) -> DataFrame:
    """Keep one row per (entity id, feature time): the one of the highest
    load; equal loads are decided by the feature values (nulls lowest), so the
    result never depends on task order.

    (Entity, time) keys are nearly unique, so combining before the shuffle
    would sort every row and reduce nothing: one shuffle and one sort by key,
    then the first row of each key. A key that repeats over many loads is
    thinned inside each task first (Spark's group limit for a row number of 1).
    """
    order = [F.col(load_id).desc_nulls_last(), *[F.col(c).desc_nulls_last() for c in features]]
    first = F.row_number().over(Window.partitionBy(entity_id, feature_time).orderBy(*order))
    return rows.select(entity_id, feature_time, load_id, *features).withColumn("_n", first) \
        .filter("_n = 1").select(entity_id, feature_time, *features)


def latest_values(table: DataFrame, entity_id: str, feature_time: str,
                  features: list[str]) -> DataFrame:
    """Latest feature row per entity (the online view). ``max(struct(time,
    values…))`` per entity, combined map-side: no group is ever collected."""
    best = F.max(F.struct(F.col(feature_time).alias("_t"),
                          *[F.col(c).alias(c) for c in features])).alias("_best")
    g = table.groupBy(entity_id).agg(best)
    return g.select(entity_id, F.col("_best._t").alias(feature_time),
                    *[F.col(f"_best.{c}").alias(c) for c in features])


class FeatureView(NamedTuple):
    """A feature table as a lookup sees it: ``rows`` keyed by ``key`` and
    ``time``, matched with the columns ``on`` of the instances; ``values`` maps
    its columns to the output's. A value older than ``max_age`` (an interval such
    as ``2 hours``) is stale: null, not replaced by an older one still."""
    rows: DataFrame
    on: list[str]
    key: list[str]
    time: str
    values: dict[str, str]
    out_time: str | None = None
    max_age: str | None = None


def _found(lookups: DataFrame, time: str, on: list[str], views: list[FeatureView], n: int) -> DataFrame:
    """(``_row``, ``_m0``, ``_m1``, ...): for each lookup the latest row of each
    view, as struct (``_ft``, values), for views that share the key ``on``."""
    lk = [f"_k{i}" for i in range(len(on))]
    present = " and ".join(f"{c} is not null" for c in [*lk, "_t"])
    types = [lookups.schema[c].dataType for c in [*on, time]]

    def keyed(df, columns, *more):
        named = [F.col(c).cast(t).alias(k) for c, k, t in zip(columns, [*lk, "_t"], types)]
        return df.select(*named, *more).filter(present)

    found = [f"_m{i}" for i in range(len(views))]
    both = keyed(lookups, [*on, time], F.lit(1).alias("_kind"), F.col("_row"), F.col("_row").alias("_salt"))
    for v, m in zip(views, found):
        pay = F.struct(F.col(v.time).cast(types[-1]).alias("_ft"), *[F.col(c).alias(name) for c, name in v.values.items()])
        rows = keyed(v.rows, [*v.key, v.time], F.lit(0).alias("_kind"), pay.alias(m))
        both = both.unionByName(rows.withColumn("_salt", F.xxhash64(m)), allowMissingColumns=True)
    # the salt spreads equal keys and times over ranges
    dealt = stage(both.repartitionByRange(n, *lk, "_t", "_kind", "_salt").drop("_salt")
                  .withColumn("_range", F.spark_partition_id()), "asof_ranges")
    earlier = Window.partitionBy(*lk).orderBy("_range").rowsBetween(Window.unboundedPreceding, -1)
    carry = dealt.groupBy(*lk, "_range").agg(*[F.max(m).alias(m) for m in found]) \
        .select(*lk, "_range", *[F.max(m).over(earlier).alias(f"{m}c") for m in found])
    so_far = Window.partitionBy(*lk, "_range").orderBy("_t", "_kind").rowsBetween(Window.unboundedPreceding, 0)
    # time is the first field: the largest struct is the latest row, ties by value
    return dealt.select(*lk, "_range", "_kind", "_row", *[F.max(m).over(so_far).alias(m) for m in found]) \
        .filter("_kind = 1").join(carry, [*lk, "_range"]) \
        .select("_row", *[F.greatest(m, f"{m}c").alias(m) for m in found])


def retrieve(instances: DataFrame, time: str, views: list[FeatureView], n_ranges: int | None = None) -> DataFrame:
    """Point-in-time lookup of several feature tables: each row of
    ``instances`` with, for every view, the values of its latest row of the same
    key and a time not after the instance's (nulls when there is none). A row
    whose values are null is still the latest; equal times are decided by
    the values (max). A null key or time matches nothing; instances that repeat
    stay repeated.

    The instances are written once under a row number; only (key, time, row
    number) is dealt and sorted, and the other columns are joined to what was
    found. All views of one instance key go through one deal: their rows and the
    lookups are put into ``n_ranges`` ranges of (key, time, row) balanced by
    Spark's sampling, so a hot key, or very many rows of one key and time,
    spans several ranges. Inside a (range, key) a running maximum over (time, values) gives
    the latest row of every view at once; what came in the key's earlier ranges
    is a running maximum over one row per (key, range). No sort spans more than
    a range and no pairs are formed. ``n_ranges`` (``spark.sql.shuffle.partitions``
    by default) changes the balance only."""
    spark = instances.sparkSession
    n = n_ranges or int(spark.conf.get("spark.sql.shuffle.partitions"))
    rows = stage(instances.withColumn("_row", F.monotonically_increasing_id()), "instances")
    kinds: dict[tuple[str, ...], list[FeatureView]] = {}
    for v in views:
        kinds.setdefault(tuple(v.on), []).append(v)
    out, columns = rows, [F.col(c) for c in instances.columns]
    for k, (on, group) in enumerate(kinds.items()):
        lookups = rows.select("_row", *dict.fromkeys([time, *on]))
        found = _found(lookups, time, list(on), group, n)
        out = out.join(found.withColumnsRenamed({f"_m{i}": f"_{k}m{i}" for i in range(len(group))}), "_row", "left")
        for i, v in enumerate(group):
            m = f"_{k}m{i}"
            fresh = F.lit(True) if v.max_age is None else \
                F.col(f"{m}._ft") + F.expr(f"INTERVAL {v.max_age}") >= F.col(time)
            named = [("_ft", v.out_time)] if v.out_time else []
            columns += [F.when(fresh, F.col(f"{m}.{c}")).alias(name)
                        for c, name in [*named, *((name, name) for name in v.values.values())]]
    return out.select(*columns)


def asof_join(left: DataFrame, right: DataFrame, left_on: list[str], right_on: list[str],
              left_time: str, right_time: str, values: list[str],
              out_time: str | None = "feature_time", n_ranges: int | None = None) -> DataFrame:
    """Left as-of join with one table: ``retrieve`` with a single view."""
    view = FeatureView(right, left_on, right_on, right_time, {v: v for v in values}, out_time)
    return retrieve(left, left_time, [view], n_ranges)
