"""Start a job: ``python -m tidewater JOB --source ... --sink ... --work DIR``."""

from __future__ import annotations

import argparse
from collections.abc import Sequence
from datetime import timedelta

from pyspark.sql import DataFrame, SparkSession

from tidewater.contract import (
    BOUNCE_WITHIN_MS,
    LATENESS_MS,
    PAGE_TOPIC,
    TOPIC_DB,
    TOPIC_LOG,
    VISIT_STATE_MS,
)
from tidewater.operators.scale import HOT_ROWS
from tidewater.session import build_session, shuffle_partitions
from tidewater.sinks.fanout import Sink, folder_sink, kafka_sink
from tidewater.sources.lines import file_lines, kafka_lines, kafka_options, stored_bytes
from tidewater.streaming import jobs
from tidewater.streaming.jobs import IDLE
from tidewater.streaming.lookups import PinnedLookup
from tidewater.streaming.replays import SeenFacts

SOURCE_TOPIC = {
    "log-split": TOPIC_LOG,
    "unique-visitors": PAGE_TOPIC,
    "user-jumps": PAGE_TOPIC,
    "cart-adds": TOPIC_DB,
    "dimensions": TOPIC_DB,
}


# Where the routing config's log is looked for, unless an option names another topic.
CONFIG_TOPIC = "table_process"


def pairs(items: Sequence[str]) -> dict[str, str]:
    return dict(item.split("=", 1) for item in items)


def parser() -> argparse.ArgumentParser:
    made = argparse.ArgumentParser(prog="tidewater", description=__doc__)
    made.add_argument("job", choices=sorted(SOURCE_TOPIC))
    made.add_argument("--work", required=True, help="folder for checkpoint and state")
    made.add_argument("--source", choices=("kafka", "files"), default="kafka")
    made.add_argument("--source-option", action="append", default=[], metavar="K=V")
    made.add_argument("--sink", choices=("kafka", "files"), default="kafka")
    made.add_argument("--sink-option", action="append", default=[], metavar="K=V")
    made.add_argument("--lookup", default="parquet", help="format of the config or dictionary")
    made.add_argument("--lookup-option", action="append", default=[], metavar="K=V")
    made.add_argument("--time-zone", default="Asia/Shanghai")
    made.add_argument("--interval", help='e.g. "30 seconds"; without it, stop when all is read')
    made.add_argument("--shape", choices=("nested", "flat"), default="nested")
    made.add_argument("--database", help="database of the cart or dimension changes")
    made.add_argument("--scoped", action="store_true", help="cart updates of that database only")
    made.add_argument("--target-topic", default="dwd_trade_cart_add")
    made.add_argument("--target-database", default="dim")
    made.add_argument("--on-error", choices=("drop", "fail"), default="drop", help="lines that are no page log")
    made.add_argument("--config-option", action="append", default=[], metavar="K=V",
                      help="source options of the routing config's log; --lookup is its snapshot then")
    made.add_argument("--trim", action="store_true", help="ignore blanks around a route's columns")
    made.add_argument("--with-action-ts", action="store_true", help="actions carry their line's time")
    made.add_argument("--keep-seen", default="7 days", help='how long facts sent again are known; "" for never')
    made.add_argument("--hot-rows", type=int, default=HOT_ROWS, help="a visitor of more rows is sorted in several tasks; 0: none is")
    made.add_argument("--within-ms", type=int, default=BOUNCE_WITHIN_MS, help="time in which a bounce's next page must come")
    made.add_argument("--lateness-ms", type=int, default=LATENESS_MS, help="how much later than the latest page one may come")
    made.add_argument("--idle-minutes", type=float, default=IDLE.total_seconds() / 60, help="a partition without rows is not waited for after that")
    made.add_argument("--lookup-minutes", type=float, default=60, help="how old a dictionary may be")
    made.add_argument("--keep-rejects", action="store_true", help="keep the text of what is left out")
    made.add_argument("--state-hours", type=float, default=VISIT_STATE_MS / 3_600_000, help="how long a visit is known")
    made.add_argument("--buckets", type=int, default=64, help="of the visitors' state; never change it")
    made.add_argument("--batch-gb", type=float, help="size of a batch; of files without --interval, it is known")
    return made


# Jobs that read what the split has sent, and may find it twice.
READS_FACTS = ("unique-visitors", "user-jumps")


def _lines(
    spark: SparkSession, args: argparse.Namespace, options: dict[str, str], topic: str
) -> DataFrame:
    headers = args.job in READS_FACTS
    if args.source == "files":
        return file_lines(spark, options.pop("path"), headers=headers, **options)
    servers = options.pop("kafka.bootstrap.servers", "")
    topic = options.pop("subscribe", topic)
    return kafka_lines(spark, kafka_options(servers, topic, headers=headers) | options)


def _stream(spark: SparkSession, args: argparse.Namespace) -> DataFrame:
    options = pairs(args.source_option)
    lines = _lines(spark, args, dict(options), SOURCE_TOPIC[args.job])
    if args.job != "dimensions" or not args.config_option:
        return lines
    # The same servers and settings, another topic or path.
    config = _lines(spark, args, options | pairs(args.config_option), CONFIG_TOPIC)
    return jobs.with_config(lines, config)


def _sink(args: argparse.Namespace) -> Sink:
    options = pairs(args.sink_option)
    if args.sink == "files":
        return folder_sink(options["path"])
    return kafka_sink(options.pop("kafka.bootstrap.servers"), **options)


def _process(args: argparse.Namespace) -> jobs.Process:
    work = args.work.rstrip("/")
    drops = jobs.drops_table(f"{work}/drops")

    def lookup(spark: SparkSession) -> DataFrame:
        return spark.read.format(args.lookup).options(**pairs(args.lookup_option)).load()

    def pinned(minutes: float) -> PinnedLookup | None:
        if not args.lookup_option:
            return None
        return PinnedLookup(f"{work}/lookup", lookup, int(minutes * 60_000))

    if args.job == "dimensions":
        log = jobs.config_log(f"{work}/config-log") if args.config_option else None
        if log is None and not args.lookup_option:
            raise SystemExit("dimensions needs --lookup-option or --config-option")
        return jobs.dimensions(
            jobs.dimension_values(f"{work}/values"), pinned(0),
            args.target_database, f"{work}/tables", source_database=args.database, drops=drops,
            log=log, trim=args.trim, rejects=folder_sink(f"{work}/rejects") if args.keep_rejects else None,
        )
    sink = _sink(args)
    hot_rows = args.hot_rows or None
    seen = SeenFacts(f"{work}/seen", args.keep_seen) if args.keep_seen else None
    if args.job == "log-split":
        return jobs.log_split(
            jobs.first_visits(f"{work}/visits", args.buckets), sink, args.shape,
            with_action_ts=args.with_action_ts,
        )
    if args.job == "unique-visitors":
        return jobs.unique_visitors(
            jobs.last_visits(f"{work}/visits", args.buckets), sink, on_error=args.on_error,
            drops=drops, seen=seen, hot_rows=hot_rows, state_ms=int(args.state_hours * 3_600_000),
            keep_rejects=args.keep_rejects,
        )
    if args.job == "user-jumps":
        return jobs.user_jumps(
            jobs.open_pages(f"{work}/open"), jobs.high_marks(f"{work}/marks"), sink,
            args.within_ms, args.lateness_ms, hot_rows=hot_rows, on_error=args.on_error,
            drops=drops, seen=seen, idle=timedelta(minutes=args.idle_minutes),
            keep_rejects=args.keep_rejects,
        )
    if not args.database:
        raise SystemExit("cart-adds needs --database")
    return jobs.cart_adds(
        sink, args.database, args.target_topic, pinned(args.lookup_minutes), args.scoped, drops,
        args.keep_rejects,
    )


def main(argv: Sequence[str] | None = None) -> None:
    args = parser().parse_args(argv)
    size = int(args.batch_gb * 1e9) if args.batch_gb else None
    spark = build_session(f"tidewater {args.job}", args.time_zone, input_bytes=size)
    if size is None and args.source == "files" and not args.interval:
        size = stored_bytes(spark, pairs(args.source_option)["path"])
        spark.conf.set("spark.sql.shuffle.partitions", shuffle_partitions(size))
    trigger = {"processingTime": args.interval} if args.interval else {"availableNow": True}
    query = jobs.start(
        _stream(spark, args), _process(args), f"{args.work.rstrip('/')}/checkpoint", trigger
    )
    query.awaitTermination()


if __name__ == "__main__":
    main()
