"""Write a k-times copy of the driver's ``events`` table into a scratch folder
(for scale-up runs of bench.py; never into the repository).

Each copy shifts ``event_id`` by k·10^6, ``ts`` by k·31 days and ``user_id``
by 7·k, so keys and times do not collide. Nothing is sampled or dropped.

    python tools/make_scaleup.py /root/testdata/sf0.1 20 "$(mktemp -d /tmp/run-XXXXXX)"
    BENCH_SF_DIR=<that folder> python bench.py
"""

from __future__ import annotations

import os
import sys

sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))


def main():
    src, k, out = sys.argv[1], int(sys.argv[2]), sys.argv[3]
    from pyspark.sql import functions as F
    from aerofeat.session import local_session
    spark = local_session(8)
    ev = spark.read.parquet(f"{src}/events.parquet")
    copy = F.explode(F.sequence(F.lit(0), F.lit(k - 1))).alias("k")
    big = ev.select("*", copy).select(
        (F.col("event_id") + F.col("k") * 1_000_000).alias("event_id"),
        (F.col("ts") + F.make_dt_interval(days=F.col("k") * 31)).alias("ts"),
        (F.col("user_id") + F.col("k") * 7).alias("user_id"), "event_type", "value", "props")
    big.repartition(16).write.parquet(f"{out}/events.parquet")
    print(spark.read.parquet(f"{out}/events.parquet").count())


if __name__ == "__main__":
    main()
