"""The jobs for ``spark-submit``: land, train, tag and publish.

    spark-submit tagloom/jobs.py --root <lake> ingest-posts --source <folder> --load 2023_10_22
"""

from __future__ import annotations

import argparse
import sys
from pathlib import Path

if __name__ == "__main__":
    sys.path.insert(0, str(Path(__file__).resolve().parent.parent))

from pyspark.sql import DataFrame, SparkSession

from tagloom.config import TrainingSettings, Zones
from tagloom.plans import ingest_dimension, ingest_posts, publish_users, report, summarize_load, summary_report, tag_load, train
from tagloom.plans.ingest import MOST_LOST
from tagloom.schemas import POST_TYPES, USERS
from tagloom.session import SETTINGS
from tagloom.sources import JdbcTable, read_table

DIMENSIONS = {"users": USERS, "post_types": POST_TYPES}


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tagloom", description=__doc__.splitlines()[0])
    parser.add_argument("--root", required=True, help="folder of the lake")
    parser.add_argument("--database", default="topics")
    parser.add_argument("--table-format", default="parquet")
    jobs = parser.add_subparsers(dest="job", required=True)

    posts = jobs.add_parser("ingest-posts", help="copy a source folder into one load")
    posts.add_argument("--source", required=True)
    posts.add_argument("--load", required=True)
    posts.add_argument("--most-lost", type=float, default=MOST_LOST, help="share of a column's values that may not convert")
    posts.add_argument("--one-schema", action="store_true", help="all files have the columns of the first")

    dimension = jobs.add_parser("ingest-dimension", help="replace a landed dimension")
    dimension.add_argument("--name", choices=sorted(DIMENSIONS), required=True)
    dimension.add_argument("--parquet", help="read a Parquet folder instead of a database")
    dimension.add_argument("--url")
    dimension.add_argument("--table")
    dimension.add_argument("--key", help="integer column to split the read by")
    dimension.add_argument("--option", action="append", default=[], metavar="NAME=VALUE", help="such as user or driver")

    training = jobs.add_parser("train", help="fit, store and evaluate the model")
    training.add_argument("--max-iterations", type=int, default=TrainingSettings.max_iterations)
    training.add_argument("--vectorizer", choices=("count", "hashing"), default=TrainingSettings.vectorizer)
    training.add_argument("--vocabulary", type=int, default=TrainingSettings.vocabulary)
    training.add_argument("--train-share", type=int, default=TrainingSettings.train_share, help="percent of the questions")
    training.add_argument("--coefficient-limit", type=int, help="refuse a model of more bytes")
    training.add_argument("--partitions", type=int, help="of the training rows")

    tagging = jobs.add_parser("tag", help="tag a load and publish it as a batch")
    tagging.add_argument("--load", required=True)
    tagging.add_argument("--batch", help="stamp as yyyy_MM_dd_HH; the running hour if left out")

    users = jobs.add_parser("publish-users", help="replace the users table")
    users.add_argument("--batch")

    summary = jobs.add_parser("summarize", help="count a published load for the reports")
    summary.add_argument("--batch", required=True, help="stamp as yyyy_MM_dd_HH")
    summary.add_argument("--load", default="all")

    reports = jobs.add_parser("report", help="show a report over the published table")
    reports.add_argument("--name", choices=("top", "trend", "totals", "engagement", "drilldown", "distinct"), default="top")
    reports.add_argument("--summaries", action="store_true", help="from the counts of the loads instead of their rows")
    reports.add_argument("--as-of", help="the table as it was at a time")
    reports.add_argument("--top", type=int, default=10)
    return parser


def _dimension(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.parquet:
        return spark.read.parquet(args.parquet)
    options = dict(option.split("=", 1) for option in args.option)
    return read_table(spark, JdbcTable(args.url, args.table, key=args.key, login=options))


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    builder = SparkSession.builder.appName(f"tagloom {args.job}")
    for key, value in SETTINGS.items():
        builder = builder.config(key, value)
    spark = builder.getOrCreate()
    zones = Zones.under(args.root, database=args.database, table_format=args.table_format)
    if args.job == "ingest-posts":
        landed = ingest_posts(spark, zones, args.source, args.load, not args.one_schema, most_lost=args.most_lost)
        print(f"{landed.files} files, {landed.lost} values lost")
    elif args.job == "ingest-dimension":
        target = {"users": zones.users, "post_types": zones.post_types}[args.name]
        ingest_dimension(_dimension(spark, args), DIMENSIONS[args.name], target)
    elif args.job == "train":
        settings = TrainingSettings(
            vocabulary=args.vocabulary,
            max_iterations=args.max_iterations,
            train_share=args.train_share,
            vectorizer=args.vectorizer,
            coefficient_limit_bytes=args.coefficient_limit,
            partitions=args.partitions,
        )
        train(spark, zones, settings).show(truncate=False)
    elif args.job == "tag":
        print(f"batch {tag_load(spark, zones, args.load, args.batch)}")
    elif args.job == "report":
        made = summary_report(spark, zones, args.name, args.top) if args.summaries else report(spark, zones, args.name, args.as_of, args.top)
        made.show(100, truncate=False)
    elif args.job == "summarize":
        summarize_load(spark, zones, args.batch, args.load)
    else:
        publish_users(spark, zones, args.batch)


if __name__ == "__main__":
    main()
