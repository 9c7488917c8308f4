"""Command line of the jobs.

    zip -r tidemark.zip tidemark
    spark-submit --py-files tidemark.zip tidemark/jobs.py ingest-raw --landing /lake/orders ...
"""

from __future__ import annotations

import argparse
import logging
import sys
from collections.abc import Sequence

from pyspark.sql import SparkSession

from tidemark.plans.initial_load import initial_load
from tidemark.schema import LANDING
from tidemark.session import build_session
from tidemark.sources import CurrentTable, infer_landing
from tidemark.streaming import ensure_raw, incremental_upsert, ingest_raw


def parser() -> argparse.ArgumentParser:
    top = argparse.ArgumentParser(prog="tidemark.jobs")
    jobs = top.add_subparsers(dest="job", required=True)

    def job(name: str, help_text: str, *options: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name, help=help_text)
        for option in options:
            sub.add_argument(f"--{option}", required=True)
        return sub

    def streaming(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--checkpoint", required=True)
        when = sub.add_mutually_exclusive_group()
        when.add_argument("--available-now", action="store_true", help="stop at the end of the present input")
        when.add_argument("--interval", help="time between micro-batches, such as '60 seconds'")
        sub.add_argument(
            "--option",
            action="append",
            default=[],
            metavar="NAME=VALUE",
            help="option of the file source, such as maxFilesPerTrigger=1000; may be repeated",
        )

    def raw(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--raw-table", default="raw.orders")
        sub.add_argument("--raw-location", required=True)

    def current(sub: argparse.ArgumentParser) -> None:
        sub.add_argument("--processed-table", default="processed.orders", help="name of the current-state table")
        sub.add_argument("--processed-location", required=True, help="folder of its files")

    ingest = job("ingest-raw", "landing files to the raw table", "landing")
    raw(ingest)
    streaming(ingest)
    ingest.add_argument("--infer-schema", action="store_true", help="read all landing files for it first")
    ingest.add_argument("--rebalance", action="store_true", help="merge small output files")
    ingest.add_argument("--errors", help="folder for malformed lines, outside the landing folder")

    load = job("initial-load", "raw table to an empty current-state table")
    raw(load)
    current(load)

    upserts = job("incremental-upsert", "raw table to the current-state table")
    raw(upserts)
    current(upserts)
    streaming(upserts)

    merge = job("merge", "make a new base of the changes so far")
    current(merge)
    return top


def run(spark: SparkSession, arguments: Sequence[str]) -> None:
    args = parser().parse_args(arguments)
    if "raw_table" in args:
        ensure_raw(spark, args.raw_table, args.raw_location)
    if "processed_table" in args:
        target = CurrentTable(spark, args.processed_table, args.processed_location)
    trigger = None
    if getattr(args, "available_now", False):
        trigger = {"availableNow": True}
    elif getattr(args, "interval", None):
        trigger = {"processingTime": args.interval}

    options = dict(option.split("=", 1) for option in getattr(args, "option", []))

    if args.job == "ingest-raw":
        ingest_raw(
            spark,
            args.landing,
            args.raw_table,
            args.raw_location,
            args.checkpoint,
            schema=infer_landing(spark, args.landing) if args.infer_schema else LANDING,
            trigger=trigger,
            options=options,
            rebalance=args.rebalance,
            errors=args.errors,
        ).awaitTermination()
    elif args.job == "initial-load":
        initial_load(spark, args.raw_table, target)
    elif args.job == "incremental-upsert":
        incremental_upsert(
            spark,
            args.raw_table,
            target,
            args.checkpoint,
            trigger=trigger,
            options=options,
        ).awaitTermination()
    elif args.job == "merge":
        target.merge()


def main() -> None:
    logging.basicConfig(level=logging.INFO)
    parser().parse_args()  # complain before a session starts
    run(build_session(), sys.argv[1:])


if __name__ == "__main__":
    main()
