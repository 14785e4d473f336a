"""``python -m bourseloom <job>``: the jobs from a shell or ``spark-submit``."""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession

from bourseloom.plans import pipeline
from bourseloom.schemas import TOPICS
from bourseloom.session import CLUSTER_CONF, use_utc
from bourseloom.sources import files, tables, topics
from bourseloom.streaming import ingest

POSITION = ["timestamp", "partition", "offset"]


def _publish(spark: SparkSession, args: argparse.Namespace) -> None:
    read = files.read_headlines_csv if args.feed == "headlines" else files.read_prices_csv
    rows = read(spark, args.csv)
    if args.dry_run:
        print(tables.write_json(rows, args.dry_run))
    else:
        topics.write_topic(rows, args.servers, TOPICS[args.feed], key="symbol")


def _ingest(spark: SparkSession, args: argparse.Namespace) -> None:
    headlines = args.feed == "headlines"
    if args.dry_run:
        accept = ingest.accepted_headlines if headlines else ingest.accepted_prices
        messages = topics.topic_table(spark, args.servers, TOPICS[args.feed])
        print(tables.write_json(accept(messages), args.dry_run))
        return
    stream = topics.topic_stream(spark, args.servers, TOPICS[args.feed], args.max_per_trigger)
    start = ingest.start_headlines if headlines else ingest.start_prices
    start(stream, args.log, args.checkpoint, POSITION, every=args.every).awaitTermination()


def _parser() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="bourseloom")
    jobs = parser.add_subparsers(dest="job", required=True)

    def job(name: str, *paths: str) -> argparse.ArgumentParser:
        sub = jobs.add_parser(name)
        for path in paths:
            sub.add_argument(f"--{path}", required=True)
        return sub

    job("clean-headlines", "raw", "out")
    job("clean-prices", "raw", "out")
    job("join", "prices", "headlines", "out")
    job("daily", "raw-headlines", "raw-prices", "out")
    job("merge-bars", "folder", "out").add_argument("--interval", choices=["daily", "15min"],
                                                    default="daily")
    job("preopen", "documents", "out")
    for name, needed in (("publish", ["csv"]), ("ingest", [])):
        sub = job(name, *needed)
        sub.add_argument("feed", choices=["headlines", "prices"])
        sub.add_argument("--servers", default="localhost:9092")
        sub.add_argument("--dry-run", metavar="FOLDER", help="write all records there as JSON, send none")
        if name == "ingest":
            sub.add_argument("--log")
            sub.add_argument("--checkpoint")
            sub.add_argument("--max-per-trigger", type=int, help="offsets per micro-batch; none is left out")
            sub.add_argument("--every", help="trigger interval; without it take what is there")
    return parser


def main(argv: list[str] | None = None) -> None:
    args = _parser().parse_args(argv)
    builder = SparkSession.builder.appName(f"bourseloom-{args.job}").config(map=CLUSTER_CONF)
    spark = use_utc(builder.getOrCreate())
    if args.job == "clean-headlines":
        print(pipeline.run_clean_headlines(spark, args.raw, args.out))
    elif args.job == "clean-prices":
        print(pipeline.run_clean_prices(spark, args.raw, args.out))
    elif args.job == "join":
        print(pipeline.run_feature_vectors(spark, args.prices, args.headlines, args.out))
    elif args.job == "daily":
        print(pipeline.run_daily(spark, args.raw_headlines, args.raw_prices, args.out))
    elif args.job == "merge-bars":
        print(pipeline.run_merge_bars(spark, args.folder, args.interval, args.out))
    elif args.job == "preopen":
        print(pipeline.run_preopen(spark, args.documents, args.out))
    elif args.job == "publish":
        _publish(spark, args)
    else:
        _ingest(spark, args)


if __name__ == "__main__":
    main()
