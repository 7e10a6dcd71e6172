"""Command line for scheduled runs (``spark-submit -m tidemark ...`` or
``python -m tidemark ...``). A scheduler calls one command per run day.

    daily-report       all report tables for --as-of, written under --out
    backfill           the same for every day in [--start, --end)
    append-rollups     add the rollups of [--start, --end) to a rollup store
    experiment-report  the experiment readout for --start .. --end
"""

from __future__ import annotations

import argparse
import sys

from pyspark.sql import SparkSession

from .plans import report
from .plans.experiment_report import experiment_report
from .plans.publish import publish_report
from .session import apply_cluster_conf
from .sources import read_feed_actions, read_message_actions


def _parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(prog="tidemark")
    sub = p.add_subparsers(dest="cmd", required=True)
    d = sub.add_parser("daily-report")
    d.add_argument("--feed", required=True)
    d.add_argument("--messages", required=True)
    d.add_argument("--as-of", required=True)
    d.add_argument("--out", required=True)
    d.add_argument("--store", help="rollup store written by append-rollups")
    d.add_argument("--format", default="parquet")
    d.add_argument("--publish", action="store_true", help="all tables become visible together")
    bf = sub.add_parser("backfill")
    bf.add_argument("--feed", required=True)
    bf.add_argument("--messages", required=True)
    bf.add_argument("--start", required=True)
    bf.add_argument("--end", required=True)
    bf.add_argument("--out", required=True)
    bf.add_argument("--store")
    bf.add_argument("--format", default="parquet")
    bf.add_argument("--publish", action="store_true")
    a = sub.add_parser("append-rollups")
    a.add_argument("--feed", required=True)
    a.add_argument("--messages", required=True)
    a.add_argument("--start", required=True)
    a.add_argument("--end", required=True)
    a.add_argument("--store", required=True)
    a.add_argument("--format", default="parquet")
    e = sub.add_parser("experiment-report")
    e.add_argument("--feed", required=True)
    e.add_argument("--start", required=True)
    e.add_argument("--end", required=True)
    e.add_argument("--control", type=int, default=1)
    e.add_argument("--treatment", type=int, default=2)
    e.add_argument("--replicates", type=int, default=5000)
    e.add_argument("--out", required=True)
    e.add_argument("--format", default="parquet")
    return p


def main(argv=None) -> int:
    args = _parser().parse_args(argv)
    spark = SparkSession.builder.appName(f"tidemark {args.cmd}").getOrCreate()
    if not spark.sparkContext.master.startswith("local"):
        apply_cluster_conf(spark)
    feed = read_feed_actions(spark, args.feed, args.format)
    if args.cmd == "daily-report":
        msgs = read_message_actions(spark, args.messages, args.format)
        rollups = report.read_rollups(spark, args.store) if args.store else {}
        tables = report.daily_report(feed, msgs, args.as_of, **rollups)
        (publish_report if args.publish else report.write_report)(tables, args.out, args.as_of)
    elif args.cmd == "backfill":
        msgs = read_message_actions(spark, args.messages, args.format)
        report.backfill(feed, msgs, args.start, args.end, args.out, args.store, args.publish)
    elif args.cmd == "append-rollups":
        msgs = read_message_actions(spark, args.messages, args.format)
        report.append_rollups(feed, msgs, args.start, args.end, args.store)
    else:
        out = experiment_report(feed, args.start, args.end, args.control, args.treatment,
                                b=args.replicates)
        out.coalesce(1).write.mode("overwrite").parquet(args.out)
    return 0


if __name__ == "__main__":
    sys.exit(main())
