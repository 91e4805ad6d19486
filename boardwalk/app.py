"""The streaming job: source x sink are parameters, not four programs.

    spark-submit boardwalk/app.py --role producer --snapshots-path <feed folder> ... \\
        --sink kafka --sink-option kafka.bootstrap.servers=HOST:9094 --checkpoint <shared>/producer-ckpt

    spark-submit boardwalk/app.py --source kafka \\
        --updates-option kafka.bootstrap.servers=HOST:9094 --updates-option subscribe=trip_updates \\
        --status-option  kafka.bootstrap.servers=HOST:9094 --status-option  subscribe=trip_status \\
        --sink upsert --path <shared>/board --checkpoint <shared>/board-ckpt

Connection settings and credentials come from options or the Spark
configuration; nothing is written into code. The checkpoint decides the
restart position; a new checkpoint path is a fresh start.
"""

from __future__ import annotations

import argparse
import os
import sys

if __package__ in (None, ""):
    sys.path.insert(0, os.path.dirname(os.path.dirname(os.path.abspath(__file__))))

from pyspark.sql import SparkSession  # noqa: E402

from boardwalk.session import build_session, stream_session  # noqa: E402
from boardwalk.functions.timefn import FEED_SOURCE_TZ, MODES, REFERENCE, REFERENCE_SHIFT_TZ  # noqa: E402
from boardwalk.operators.feed import split_feed, union_feeds  # noqa: E402
from boardwalk.schemas import SNAPSHOT_FILE  # noqa: E402
from boardwalk.sources.envelope import read_envelope  # noqa: E402
from boardwalk.streaming.board_stream import board_stream, kept_heavy_trips  # noqa: E402
from boardwalk.streaming.sinks import publish_stream, write_append, write_upsert  # noqa: E402


def _options(pairs: list[str]) -> dict[str, str]:
    out = {}
    for p in pairs or []:
        k, _, v = p.partition("=")
        out[k] = v
    return out


def start_producer(spark: SparkSession, args: argparse.Namespace):
    """Feed snapshots (one JSON document per poll, one folder per feed) ->
    split into the two message kinds -> published."""
    feeds = [spark.readStream.schema(SNAPSHOT_FILE).json(p) for p in args.snapshots_path]
    msgs = split_feed(union_feeds(*feeds))
    fmt = "json" if args.sink == "files" else args.sink
    return publish_stream(msgs, fmt, args.checkpoint, _options(args.sink_option), path=args.path,
                          trigger=args.trigger, query_name=args.query_name, connector=args.connector)


def start(spark: SparkSession, args: argparse.Namespace):
    spark = stream_session(spark, args.state_partitions)
    needs_path = args.sink in ("append", "files") or (args.sink == "upsert" and not args.merge_into)
    if needs_path and not args.path:
        raise SystemExit(f"--sink {args.sink} needs --path")
    if args.role == "producer":
        if args.sink not in ("kafka", "kinesis", "files"):
            raise SystemExit("a producer publishes to --sink kafka, kinesis or files")
        return start_producer(spark, args)
    if args.sink not in ("append", "upsert"):
        raise SystemExit("a consumer writes the board with --sink append or --sink upsert")
    u = read_envelope(spark, args.source, _options(args.updates_option), path=args.updates_path, checkpoint=args.checkpoint, connector=args.connector)
    s = read_envelope(spark, args.source, _options(args.status_option), path=args.status_path, checkpoint=args.checkpoint, connector=args.connector)
    heavy = None
    if args.heavy_share:
        # What the source holds of the updates now; in a restart the kept list.
        options = {**_options(args.updates_option), "startingOffsets": "earliest"}
        history = read_envelope(spark, args.source, options, path=args.updates_path, stream=False, connector=args.connector)
        heavy = kept_heavy_trips(history, args.checkpoint, args.heavy_share)
    board = board_stream(
        u, s, mode=args.time_mode, bound=args.bound, watermark=args.watermark, salt=args.salt, heavy=heavy,
        keep_order=args.sink == "upsert", shift_tz=args.shift_tz, source_tz=args.source_tz,
    )
    if args.sink == "append":
        return write_append(board, args.path, args.checkpoint, trigger=args.trigger, query_name=args.query_name, by_start=args.by_start)
    return write_upsert(
        board, args.path, args.checkpoint, trigger=args.trigger, query_name=args.query_name,
        register_as=args.register_as, merge_into=args.merge_into, merge_every=args.merge_every or None,
    )


def parser() -> argparse.ArgumentParser:
    p = argparse.ArgumentParser(description="trip board stream")
    p.add_argument("--role", choices=["consumer", "producer"], default="consumer")
    p.add_argument("--source", choices=["kafka", "kinesis", "json", "parquet"], default="json")
    p.add_argument("--connector", default=None, help="name of the broker's data source, if it is not that of the kind")
    p.add_argument("--snapshots-path", action="append", default=[], help="producer: one folder per feed")
    p.add_argument("--sink-option", action="append", default=[], help="producer: options of the broker")
    p.add_argument("--updates-option", action="append", default=[])
    p.add_argument("--status-option", action="append", default=[])
    p.add_argument("--updates-path")
    p.add_argument("--status-path")
    p.add_argument("--sink", choices=["append", "upsert", "kafka", "kinesis", "files"], default="append")
    p.add_argument("--path", help="folder of the board or of published files")
    p.add_argument("--checkpoint", required=True)
    p.add_argument("--trigger", default=None, help="interval (default 10 seconds) or available_now")
    p.add_argument("--time-mode", choices=list(MODES), default=REFERENCE)
    p.add_argument("--shift-tz", default=REFERENCE_SHIFT_TZ, help="zone of the reference time mode")
    p.add_argument("--source-tz", default=FEED_SOURCE_TZ, help="zone of trip start times in instant mode")
    p.add_argument("--bound", default=None, help="e.g. '1 hour': watermarked, time-bounded join")
    p.add_argument("--watermark", default=None, help="delay of both watermarks (default: the bound)")
    p.add_argument("--salt", type=int, default=1, help="parts of every trip's updates in the join")
    p.add_argument("--heavy-share", type=float, default=None,
                   help="salt only trips with more than this share of the updates that the source holds at the first start")
    p.add_argument("--by-start", choices=["day", "month"], default=None, help="lay the append folder out by start of trip")
    p.add_argument("--merge-every", type=int, default=16, help="batches after which the upsert merges its folders (0: never)")
    p.add_argument("--state-partitions", type=int, default=None,
                   help="join state partitions of a fresh checkpoint (default: the cluster's cores)")
    p.add_argument("--register-as", default=None, help="catalog view of the upsert's latest rows")
    p.add_argument("--merge-into", default=None, help="upsert into this catalog table with MERGE (Delta, Iceberg)")
    p.add_argument("--query-name", default="trip_board")
    return p


def main(argv: list[str] | None = None) -> None:
    args = parser().parse_args(argv)
    spark = build_session(app="boardwalk")
    start(spark, args).awaitTermination()


if __name__ == "__main__":
    main()
