"""Command line: python -m shelfmark harvest NAME --cs FOLDER, or python -m shelfmark compare --cs FOLDER."""

from __future__ import annotations

import argparse
import logging
import sys

from shelfmark.functions.score import EDIT_BORDER, OVERLAP_BORDER
from shelfmark.plans.compare import CompareOptions, compare_store
from shelfmark.plans.harvest import SOURCES, Harvest, HarvestOptions
from shelfmark.sources.store import BookStore


def parser() -> argparse.ArgumentParser:
    store = argparse.ArgumentParser(add_help=False)
    store.add_argument("--th", type=int, default=1, help="requests or comparisons at a time")
    store.add_argument("--cs", required=True, help="folder of the store, as file:///books or hdfs:///books")
    store.add_argument("--db", default="ELS", help="folder of the collections in it")
    store.add_argument("--cn", default="Books", help="name of the collection")
    out = argparse.ArgumentParser(prog="shelfmark")
    actions = out.add_subparsers(dest="action", required=True)
    harvest = actions.add_parser("harvest", parents=[store], help="collect one catalogue")
    harvest.add_argument("name", choices=sorted(SOURCES))
    harvest.add_argument("--proxy", default="", help="host:port")
    harvest.add_argument("--bs", type=int, default=100, help="books of a batch")
    harvest.add_argument("--si", type=int, default=1, help="first id, where ids are scanned")
    harvest.add_argument("--ei", type=int, default=1_000_000, help="id to end before")
    harvest.add_argument("--sp", type=int, default=1, help="first page, where pages are numbered")
    compare = actions.add_parser("compare", parents=[store], help="link similar books")
    compare.add_argument("--lb", type=float, default=EDIT_BORDER, help="border of the edit distance")
    compare.add_argument("--ib", type=float, default=OVERLAP_BORDER, help="border of the overlap of names")
    return out


def main(arguments: list[str] | None = None, spark=None, get=None) -> int:
    """Runs one action; spark and get (see Harvest) may be given by a caller."""
    options = parser().parse_args(arguments)
    logging.basicConfig(level=logging.INFO)
    if spark is None:
        from pyspark.sql import SparkSession

        spark = SparkSession.builder.appName("shelfmark").getOrCreate()
    if options.th > 1 and options.action == "compare":
        spark.conf.set("spark.sql.shuffle.partitions", str(max(options.th, int(spark.conf.get("spark.sql.shuffle.partitions")))))
    store = BookStore(spark, f"{options.cs.rstrip('/')}/{options.db}/{options.cn}")
    if options.action == "compare":
        return 0 if compare_store(store, CompareOptions(options.lb, options.ib)) else 1
    Harvest(options.name, store, HarvestOptions(options.th, options.proxy, options.bs, options.si, options.ei, options.sp), get).run()
    return 0


if __name__ == "__main__":
    sys.exit(main())
