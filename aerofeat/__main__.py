"""Command line: ``python -m aerofeat <command> …`` (runs on the session of a
``spark-submit`` or a local one).

    batch    --input GLOB --output-airports P --output-flights P
             --output-read-instances P [--output-rejects P] [--format parquet] [--strict]
    train    --data GLOB --split-date 2020-05-20 [--model P] [--metrics P]
             [--datasets P] [--eval-rows N]
    monthly  --zips GLOB --out P [--sample P] [--sample-rows 5000]
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from .session import clean_scratch


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="aerofeat")
    sub = p.add_subparsers(dest="command", required=True)
    b = sub.add_parser("batch", help="flight features, airport features, read instances")
    b.add_argument("--input", required=True)
    b.add_argument("--output-airports", required=True)
    b.add_argument("--output-flights", required=True)
    b.add_argument("--output-read-instances", required=True)
    b.add_argument("--output-rejects")
    b.add_argument("--format", default="parquet")
    b.add_argument("--strict", action="store_true")
    b.add_argument("--read-instance-files", type=int)
    t = sub.add_parser("train", help="split, fit, evaluate")
    t.add_argument("--data", required=True)
    t.add_argument("--split-date", default="2020-05-20")
    t.add_argument("--model")
    t.add_argument("--metrics")
    t.add_argument("--datasets")
    t.add_argument("--eval-rows", type=int, help="only the first so many test rows (all by default)")
    m = sub.add_parser("monthly", help="zip archives → monthly raw table (+ sample)")
    m.add_argument("--zips", required=True)
    m.add_argument("--out", required=True)
    m.add_argument("--sample")
    m.add_argument("--sample-rows", type=int, default=5000)
    return p


def main(argv=None, spark: SparkSession | None = None) -> None:
    args = _parser().parse_args(argv)
    spark = spark or SparkSession.builder.appName("aerofeat").getOrCreate()
    try:
        _run(spark, args)
    finally:
        clean_scratch(spark)      # the outputs are written; nothing reads the staged tables any more


def _run(spark: SparkSession, args) -> None:
    from .plans import jobs
    if args.command == "batch":
        jobs.run_batch_features(spark, args.input, args.output_airports, args.output_flights,
                                args.output_read_instances, fmt=args.format, strict=args.strict,
                                output_rejects=args.output_rejects,
                                read_instance_files=args.read_instance_files)
    elif args.command == "train":
        jobs.run_training(spark, args.data, args.split_date, model_path=args.model,
                          eval_rows=args.eval_rows, metrics_path=args.metrics,
                          datasets_path=args.datasets)
    elif args.command == "monthly":
        jobs.ingest_monthly(spark, args.zips, args.out, sample_dir=args.sample,
                            sample_rows=args.sample_rows)


if __name__ == "__main__":
    main()
