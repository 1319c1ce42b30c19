"""Command line: run the whole job on JSON-lines reviews.

    python -m revspark [INPUT] [OUTPUT] [--variant votes|ratio] [--on-missing raise|empty]

Defaults follow the reference's entry point: ``data/reviews.json`` and ``output/``. The session
comes from ``spark-submit`` (or a local one when run directly).
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from revspark.plans.job import run_job


def main(argv: list[str] | None = None) -> int:
    parser = argparse.ArgumentParser(prog="revspark")
    parser.add_argument("input", nargs="?", default="data/reviews.json")
    parser.add_argument("output", nargs="?", default="output/")
    parser.add_argument("--variant", choices=("votes", "ratio"), default="votes")
    parser.add_argument("--on-missing", choices=("raise", "empty"), default="raise")
    parser.add_argument("--partition-ranked-by-year", action="store_true")
    parser.add_argument("--cache", choices=("persist", "checkpoint"), default="checkpoint",
                        help="how the processed reviews and stats are kept for the outputs")
    parser.add_argument("--size-shuffle", action="store_true",
                        help="set shuffle partitions and split size from the input's size")
    args = parser.parse_args(argv)

    spark = SparkSession.getActiveSession()
    owned = spark is None
    if owned:
        from revspark.session import get_spark

        spark = get_spark(master=None, app_name="revspark-job")
    try:
        count = run_job(spark, args.input, args.output, args.variant, on_missing=args.on_missing,
                        cache=args.cache, partition_ranked_by_year=args.partition_ranked_by_year,
                        size_shuffle=args.size_shuffle)
        print(f"Total high-quality reviews: {count}")
    finally:
        if owned:
            spark.stop()
    return 0


if __name__ == "__main__":
    raise SystemExit(main())
