"""The jobs from the command line, for ``spark-submit`` and schedulers.

    python -m tillroll publish --feeds hdfs:///shop/feeds --kafka broker:9092 --checkpoints ...
    python -m tillroll land --kafka broker:9092 --tables hdfs:///shop/landed --checkpoints ...
    python -m tillroll snapshot --tables hdfs:///shop/landed --snapshots ... 2020-01-01 10
    python -m tillroll curate --tables hdfs:///shop/landed --curated ... 2020-01-01 10
    python -m tillroll recurate --tables hdfs:///shop/landed --curated ...
    python -m tillroll erase --tables hdfs:///shop/landed --curated ... --index ...
    python -m tillroll expire --snapshots ... --curated ...
    python -m tillroll compact --tables hdfs:///shop/landed --compacted ... 2020-01-01 10
    python -m tillroll peek --kafka broker:9092
"""

from __future__ import annotations

import argparse
from collections.abc import Sequence

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql.streaming import StreamingQuery

from tillroll.plans.curate import curate_slice
from tillroll.plans.erasure import erase_stored
from tillroll.plans.lineage import recurate_late
from tillroll.plans.snapshot import VERSIONS, expire_snapshots, write_snapshot
from tillroll.schemas import FEEDS, TOPIC, Feed
from tillroll.session import use_rocksdb_state
from tillroll.sinks.curated import vacuum_curated
from tillroll.sinks.landed import compact_slice
from tillroll.sinks.log import stream_to_kafka
from tillroll.sources.log import peek, read_kafka
from tillroll.streaming.feeds import Landing, start_landing, start_publishing, wait
from tillroll.streaming.metrics import BatchLog


class KafkaLog:
    """The log the jobs publish to and read from; tests hand in one of files instead."""

    def __init__(self, spark: SparkSession, args: argparse.Namespace):
        self.spark, self.args = spark, args

    def open(self, feed: Feed) -> DataFrame:
        return read_kafka(
            self.spark,
            self.args.kafka,
            [feed.partition],
            topic=self.args.topic,
            starting_offsets=self.args.start,
            max_offsets_per_trigger=self.args.per_trigger,
        )

    def look(self, feed: Feed, first: int, n: int) -> DataFrame:
        return read_kafka(
            self.spark,
            self.args.kafka,
            [feed.partition],
            streaming=False,
            topic=self.args.topic,
            offsets=(first, first + n),
        )

    def publish(self, records: DataFrame, checkpoint: str) -> StreamingQuery:
        return stream_to_kafka(records, self.args.kafka, checkpoint, once=self.args.once)


def _arguments() -> argparse.ArgumentParser:
    parser = argparse.ArgumentParser(prog="tillroll")
    jobs = parser.add_subparsers(dest="job", required=True)
    publish = jobs.add_parser("publish", help="send arriving feed files to the log")
    land = jobs.add_parser("land", help="land all four feeds from the log")
    snapshot = jobs.add_parser("snapshot", help="store the newest products and customers")
    curate = jobs.add_parser("curate", help="curate one closed slice")
    recurate = jobs.add_parser("recurate", help="curate slices again for which more has landed")
    erase = jobs.add_parser("erase", help="mask customers of new requests in what is stored")
    expire = jobs.add_parser("expire", help="remove old snapshots and replaced curated slices")
    compact = jobs.add_parser("compact", help="copy one closed landed slice into few files")
    look = jobs.add_parser("peek", help="print records of the log")
    for job in (publish, land, look):
        job.add_argument("--kafka", metavar="SERVERS", required=True)
        job.add_argument("--topic", default=TOPIC)
    for job in (publish, land):
        job.add_argument("--checkpoints", required=True)
        job.add_argument("--once", action="store_true", help="work off what is there and stop")
    publish.add_argument("--feeds", required=True)
    publish.add_argument("--dates", help="pattern of dates to look at, such as '2020-01-*'")
    publish.add_argument("--files-per-trigger", type=int)
    publish.add_argument("--archive", help="folder that published files move to")
    publish.add_argument("--partitions", type=int, help="spread the lines of large files")
    for job in (land, curate, recurate, erase, snapshot, compact):
        job.add_argument("--tables", required=True)
        job.add_argument("--format", default="parquet")
    for job in (curate, recurate, erase, expire):
        job.add_argument("--curated", required=True)
    land.add_argument("--start", default="earliest", help="offsets to start from")
    land.add_argument("--per-trigger", type=int, help="offsets per micro-batch at most")
    land.add_argument("--every", help="time between micro-batches, such as '1 minute'")
    land.add_argument("--envelope", default="json", choices=["json", "regex"])
    land.add_argument("--dedup", default="forever", choices=["forever", "within_watermark", "changes"])
    land.add_argument("--watermark", default="10 minutes")
    land.add_argument("--snapshots", help="read erasure requests from the last snapshot there on")
    land.add_argument("--keep-unknown", action="store_true", help="keep undeclared fields")
    land.add_argument("--files", type=int, help="files per micro-batch and table")
    for job in (land, curate, recurate, erase):
        job.add_argument("--mask", default="sha2", choices=["sha2", "murmur3", "null"])
        job.add_argument("--mask-columns", type=_words, default=["email", "phone_number"])
        job.add_argument("--mask-salt", metavar="FILE", help="file that holds the salt")
    for job in (curate, recurate):
        job.add_argument("--mode", default="running", choices=["running", "per_transaction"])
        job.add_argument("--products", default="latest", choices=["slice", "latest"])
        job.add_argument("--customers", default="slice", choices=["slice", "latest"])
        job.add_argument("--snapshots")
    curate.add_argument("--allow-empty", action="store_true")
    recurate.add_argument("--since", help="first day of landing to look at")
    erase.add_argument("--index", required=True, help="folder of this job's own")
    expire.add_argument("--snapshots", required=True)
    expire.add_argument("--keep", type=int, default=24, help="snapshots of each table to keep")
    expire.add_argument("--hours", type=float, default=24, help="least age of what is removed")
    snapshot.add_argument("--snapshots", required=True)
    compact.add_argument("--compacted", required=True)
    for job in (curate, snapshot, compact):
        job.add_argument("date")
        job.add_argument("hour")
    look.add_argument("--rows", type=int, default=20)
    look.add_argument("--offset", type=int, default=0, help="where to start in each partition")
    return parser


def _words(text: str) -> list[str]:
    return text.split(",")


def _salt(spark: SparkSession, path: str | None) -> str | None:
    """A salt is read from a file, as arguments show in process lists and logs."""
    if path is None:
        return None
    rows = spark.read.text(path, wholetext=True).head(1)
    return rows[0][0].strip()


def main(argv: Sequence[str] | None = None, log_of=KafkaLog) -> None:
    args = _arguments().parse_args(argv)
    # Hours of feeds are labels: in UTC each of them exists on each day.
    spark = (
        SparkSession.builder.appName(f"tillroll-{args.job}")
        .config("spark.sql.session.timeZone", "UTC")
        .getOrCreate()
    )
    if args.job in ("publish", "land", "peek"):
        log = log_of(spark, args)
    if args.job == "publish":
        queries = start_publishing(
            spark,
            args.feeds,
            lambda records, feed: log.publish(records, f"{args.checkpoints}/publish-{feed.name}"),
            args.topic,
            date=args.dates,
            max_files_per_trigger=args.files_per_trigger,
            partitions=args.partitions,
            archive=args.archive,
        )
        wait(spark, queries.values(), args.once)
    elif args.job == "land":
        use_rocksdb_state(spark)
        tables = ["transaction", "customer", "product", "erasure"]
        to = Landing(
            tables=args.tables,
            checkpoints=args.checkpoints,
            fmt=args.format,
            once=args.once,
            every=args.every,
            envelope=args.envelope,
            product_dedup=args.dedup,
            watermark=args.watermark,
            mask=args.mask,
            mask_salt=_salt(spark, args.mask_salt),
            mask_columns=tuple(args.mask_columns),
            snapshots=args.snapshots,
            keep_unknown=args.keep_unknown,
            target_files=dict.fromkeys(tables, args.files) if args.files else {},
        )
        with BatchLog(spark, f"{args.tables}/_batches") as batches:
            queries = start_landing(log.open, to).values()
            wait(spark, queries, args.once, print)
            batches.settle(queries)
    elif args.job == "snapshot":
        for table in VERSIONS:
            write_snapshot(
                spark, args.tables, args.snapshots, table, args.date, args.hour, fmt=args.format
            )
    elif args.job == "compact":
        for table in ("transaction", "customer"):  # the feeds that land every hour
            compact_slice(
                spark, args.tables, args.compacted, table, args.date, args.hour, fmt=args.format
            )
    elif args.job == "erase":
        touched = erase_stored(
            spark,
            args.tables,
            args.curated,
            args.index,
            columns=args.mask_columns,
            method=args.mask,
            salt=_salt(spark, args.mask_salt),
            fmt=args.format,
        )
        for table, slices in touched.items():
            print(f"{table}: {len(slices)} slices")
    elif args.job == "expire":
        for table in VERSIONS:
            expire_snapshots(spark, args.snapshots, table, keep=args.keep, least_hours=args.hours)
        vacuum_curated(spark, args.curated, least_hours=args.hours)
    elif args.job in ("curate", "recurate"):
        options = {
            "mode": args.mode,
            "product_scope": args.products,
            "customer_scope": args.customers,
            "snapshots": args.snapshots,
            "fmt": args.format,
            "mask": args.mask,
            "mask_salt": _salt(spark, args.mask_salt),
            "mask_columns": args.mask_columns,
        }
        if args.job == "recurate":
            for date, hour in recurate_late(
                spark, args.tables, args.curated, since=args.since, **options
            ):
                print(f"{date} {hour}: curated again")
        else:
            options["allow_empty"] = args.allow_empty
            rows = curate_slice(spark, args.tables, args.curated, args.date, args.hour, **options)
            print(f"{args.date} {args.hour}: {rows} rows")
    else:
        for feed in FEEDS.values():
            peek(log.look(feed, args.offset, args.rows), args.rows).show(args.rows, truncate=False)


if __name__ == "__main__":
    main()
