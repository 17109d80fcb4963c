"""Run the whole batch: python -m riskspark SOURCE_DIR OUT_DIR [--format parquet]"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from riskspark.plans import pipeline


def main(argv: list[str] | None = None) -> None:
    parser = argparse.ArgumentParser(prog="riskspark", description=pipeline.__doc__)
    parser.add_argument("source_dir", help="folder with the four source tables")
    parser.add_argument("out_dir", help="folder for marts and exports, shared by all executors")
    parser.add_argument("--format", default="csv", choices=["csv", "parquet"])
    parser.add_argument("--no-export", action="store_true", help="write the marts only")
    parser.add_argument("--compression", choices=["gzip"], help="compress exports and views")
    args = parser.parse_args(argv)
    packed = {"compression": args.compression} if args.compression else {}
    spark = SparkSession.builder.appName("riskspark").getOrCreate()
    marts = pipeline.run(
        spark, args.source_dir, args.out_dir, fmt=args.format, export=not args.no_export, **packed
    )
    marts["kpi_summary"].show(vertical=True, truncate=False)
    marts["alerts"].show(truncate=False)


if __name__ == "__main__":
    main()
