"""The streaming jobs as a program.

    spark-submit --py-files tickbars.zip -m tickbars.main bars \\
        --source kafka --servers broker:9092 --from kafka_raw_data \\
        --sink kafka --to kafka_per_sec_data --checkpoint hdfs:///jobs/bars

or, installed, ``python -m tickbars.main ...``. ``tickbars.zip`` holds this package
(``zip -r tickbars.zip tickbars``). A job runs until it is stopped, or with
``--once`` until its source has no more rows.
"""

from __future__ import annotations

import argparse

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tickbars.schemas import DURATIONS
from tickbars.session import build_session
from tickbars.sinks import Sink, console, kafka_sink, message_files, row_files
from tickbars.sinks.tables import Newest
from tickbars.sources import files, kafka
from tickbars.streaming.follow import DAY
from tickbars.streaming.jobs import (
    WATERMARK,
    start_averages,
    start_bars,
    start_carried,
    start_chained,
    start_each,
    start_filled,
    start_latest,
    start_lines,
    start_rejected,
)

JOBS = (
    "bars", "averages", "averages-each", "chained", "lines", "filled", "carried", "latest", "rejected",
)


def parser() -> argparse.ArgumentParser:
    args = argparse.ArgumentParser(prog="tickbars", description="Bars and moving averages of a stream of ticks.")
    args.add_argument("job", choices=JOBS)
    args.add_argument("--source", choices=("kafka", "parquet", "orc", "json", "text"), default="kafka")
    args.add_argument("--from", dest="origin", required=True, help="topic or folder to read")
    args.add_argument("--sink", choices=("kafka", "parquet", "json", "console"), default="kafka")
    args.add_argument("--to", help="topic or folder to write")
    args.add_argument("--servers", help="bootstrap servers of Kafka")
    args.add_argument("--checkpoint", required=True, help="folder of this job alone that outlives it")
    args.add_argument("--zone", default="UTC")
    args.add_argument("--watermark", default=WATERMARK)
    args.add_argument("--ahead", help="refuse ticks further ahead of their message's time, as in '1 hour'")
    args.add_argument("--durations", type=int, nargs="+", default=list(DURATIONS))
    args.add_argument("--each-bar-once", action="store_true", help="drop bars that a topic delivers again")
    args.add_argument("--quiet", type=int, default=DAY, help="seconds of silence until a symbol is forgotten")
    args.add_argument("--until", type=int, help="the second since 1970 behind which no silence is filled")
    args.add_argument("--max-per-trigger", type=int, help="messages (Kafka) or files of a micro-batch")
    args.add_argument("--every", help="processing time between micro-batches, as in '15 seconds'")
    args.add_argument("--output-mode", choices=("append", "update"), default="append")
    args.add_argument("--once", action="store_true", help="stop when the source has no more rows")
    return args


def _messages(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    if args.source == "kafka":
        return kafka.stream_messages(
            spark, servers=args.servers, topic=args.origin, max_per_trigger=args.max_per_trigger
        )
    return files.stream_messages(spark, args.origin, args.source, args.max_per_trigger)


def _sink(args: argparse.Namespace, part: str = "") -> Sink:
    if args.sink == "console":
        return console()
    if args.sink == "kafka":
        return kafka_sink(args.servers, args.to)
    return message_files(f"{args.to}{part}", args.sink)


def _one(messages: DataFrame, args: argparse.Namespace, run: dict[str, object]) -> StreamingQuery:
    """Start the job of ``args`` if it is one query."""
    if args.job == "latest":
        run.pop("output_mode")
        return start_latest(messages, [Newest(args.to)], **run)
    if args.job == "rejected":
        rows = _sink(args) if args.sink == "kafka" else row_files(args.to, args.sink) if args.to else console()
        return start_rejected(messages, rows, ahead=args.ahead, **run)
    run["watermark"] = args.watermark
    averages = {"durations": args.durations, "each_bar_once": args.each_bar_once}
    if args.job == "bars":
        return start_bars(messages, _sink(args), ahead=args.ahead, **run)
    if args.job == "averages":
        return start_averages(messages, _sink(args), **averages, **run)
    if args.job == "lines":
        return start_lines(messages, _sink(args), **averages, **run)
    if args.job == "filled":
        return start_filled(messages, _sink(args), quiet=args.quiet, until=args.until, **run)
    if args.job == "carried":
        return start_carried(messages, _sink(args), quiet=args.quiet, **run)
    return start_chained(messages, _sink(args), durations=args.durations, ahead=args.ahead, **run)


def main(argv: list[str] | None = None, spark: SparkSession | None = None) -> None:
    args = parser().parse_args(argv)
    if (args.sink != "console" or args.job == "latest") and not args.to:
        parser().error("--to is needed")
    if "kafka" in (args.source, args.sink) and not args.servers:
        parser().error("--servers is needed")
    spark = spark or build_session(f"tickbars-{args.job}", zone=args.zone)
    run: dict[str, object] = {"output_mode": args.output_mode}
    if args.once:
        run["trigger"] = {"availableNow": True}
    elif args.every:
        run["trigger"] = {"processingTime": args.every}
    if args.job == "averages-each":
        queries = start_each(
            lambda: _messages(spark, args), lambda d: _sink(args, f"/{d}" if args.sink != "kafka" else ""),
            args.checkpoint, args.durations, watermark=args.watermark, each_bar_once=args.each_bar_once, **run,
        )
    else:
        queries = [_one(_messages(spark, args), args, run | {"checkpoint": args.checkpoint})]
    if args.once:
        for query in queries:
            query.awaitTermination()
    else:  # until one of them fails or all are stopped
        spark.streams.awaitAnyTermination()


if __name__ == "__main__":
    main()
