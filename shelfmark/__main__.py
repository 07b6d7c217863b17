"""``python -m shelfmark RAW_DIR LAKE_ROOT [--as-of DATE]``: one full refresh."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from shelfmark.clock import RunClock
from shelfmark.plans import warehouse
from shelfmark.schemas import GOLD
from shelfmark.sources.lake import Lake


def main() -> int:
    args = argparse.ArgumentParser(prog="shelfmark")
    args.add_argument("raw_dir")
    args.add_argument("lake_root")
    args.add_argument("--as-of", help="date of the run, today by default")
    args.add_argument("--append", action="store_true", help="keep earlier raw rows")
    args.add_argument("--mask-secret-file", help="mask contacts by digests keyed by this file's text")
    options = args.parse_args()
    clock = RunClock.on(options.as_of) if options.as_of else RunClock.now()
    secret = None
    if options.mask_secret_file:
        with open(options.mask_secret_file, encoding="utf-8") as file:
            secret = file.read().strip()
    spark = SparkSession.builder.appName("shelfmark").getOrCreate()
    lake = Lake(spark, options.lake_root)
    try:
        warehouse.run(lake, options.raw_dir, clock, not options.append, secret)
    except warehouse.LoadFailed as failure:
        print(failure)
        return 1
    name = lake.name(GOLD, "quality_report")
    failed = lake.read(GOLD, "quality_report").filter("Failures > 0").count()
    print(f"{failed} checks failed; all results are in {name}")
    return 1 if failed else 0


if __name__ == "__main__":
    raise SystemExit(main())
