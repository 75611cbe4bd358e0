"""Follow an ad log: click counts per user and place, and the blacklist that feeds back.

    spark-submit --packages org.apache.spark:spark-sql-kafka-0-10_2.13:4.1.2 \\
        --py-files footfall.zip footfall/streaming/ad_job.py \\
        --brokers host1:9092,host2:9092 --topics ad-log --root /warehouse/ads

With ``--folder`` instead of brokers the lines come from text files that appear there.
"""

from __future__ import annotations

import argparse

from pyspark.sql import SparkSession
from pyspark.sql.streaming import StreamingQuery

from footfall.session import build_session
from footfall.sources.streams import file_lines, kafka_lines
from footfall.streaming.ad_clicks import (
    DEFAULT_THRESHOLD, AdTables, parse_ad_log, start_ad_stream, start_running_counts, stream_id,
)


def arguments(given: list[str] | None = None) -> argparse.Namespace:
    parser = argparse.ArgumentParser(description=__doc__.splitlines()[0])
    source = parser.add_mutually_exclusive_group(required=True)
    source.add_argument("--brokers")
    source.add_argument("--folder")
    parser.add_argument("--topics")
    parser.add_argument("--root", required=True, help="shared folder of the tables and checkpoint")
    parser.add_argument("--threshold", type=int, default=DEFAULT_THRESHOLD)
    parser.add_argument("--interval", default="5 seconds")
    parser.add_argument("--once", action="store_true", help="take what is there, then stop")
    parser.add_argument("--option", action="append", default=[], metavar="NAME=VALUE",
                        help="a source option, such as maxOffsetsPerTrigger=100000 or maxFilesPerTrigger=50")
    parser.add_argument("--rejects", help="shared folder for lines that cannot be read")
    parser.add_argument("--running", action="store_true",
                        help="keep running totals per place instead of counts and blacklist")
    parser.add_argument("--watermark", help="with --running: how late a click may be, such as '2 days'")
    parser.add_argument("--show", action="store_true", help="print each batch's place counts")
    return parser.parse_args(given)


def start(spark: SparkSession, args: argparse.Namespace) -> StreamingQuery:
    options = dict(option.split("=", 1) for option in args.option)
    lines = (file_lines(spark, args.folder, **options) if args.folder
             else kafka_lines(spark, args.brokers, args.topics, **options))
    trigger = {"availableNow": True} if args.once else {"processingTime": args.interval}
    if args.running:
        return start_running_counts(parse_ad_log(lines), f"{args.root}/running",
                                    f"{args.root}/running-checkpoint", args.watermark, **trigger)
    tables = AdTables(f"{args.root}/tables")

    def show(session: SparkSession, batch_id: int) -> None:
        stream = stream_id(session, f"{args.root}/checkpoint")
        tables.place_clicks.of_batch(session, stream, batch_id).show(truncate=False)

    return start_ad_stream(lines, tables, f"{args.root}/checkpoint", args.threshold,
                           show if args.show else None, args.rejects, **trigger)


if __name__ == "__main__":
    start(build_session("ad-clicks"), arguments()).awaitTermination()
