"""Stream sinks: the board appended to Parquet, or kept as the latest row
per trip (upsert) through ``foreachBatch``; and message publishing."""

from __future__ import annotations

import json
import uuid

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import DataStreamWriter, StreamingQuery

from boardwalk import schemas
from boardwalk.operators.latest import latest_per_key
from boardwalk.session import read_text
from boardwalk.sources.layout import PART, bloom_options, start_part
from boardwalk.sources.table import register_board_path
from boardwalk.sources.upsert import append_latest, is_upsert_path, merge_tiers

# Fixed value: the micro-batch interval of the original.
DEFAULT_TRIGGER = "10 seconds"
AVAILABLE_NOW = "available_now"


def with_trigger(w: DataStreamWriter, trigger: str | None) -> DataStreamWriter:
    """``None`` -> every 10 s; ``"available_now"`` -> drain what is there and
    stop (tests, backfills); any other text is a processing-time interval."""
    if trigger == AVAILABLE_NOW:
        return w.trigger(availableNow=True)
    return w.trigger(processingTime=trigger or DEFAULT_TRIGGER)


def write_append(
    board: DataFrame, path: str, checkpoint: str, trigger: str | None = None, query_name: str | None = None, by_start: str | None = None
) -> StreamingQuery:
    """Append every new board row to a Parquet folder. The file sink's log
    (under ``path/_spark_metadata``) makes each micro-batch exactly-once; a
    reader of the folder sees only committed files.

    ``by_start`` ("day" or "month") lays the folder out by start of trip, with
    a bloom filter for trip ids (``layout.py``); ``read_clustered`` reads it,
    and ``write_clustered`` makes few ordered files of what has gathered."""
    if by_start:
        board = board.select(*schemas.BOARD_COLUMNS, start_part(F.col("startTime"), by_start).alias(PART))
    w = board.writeStream.outputMode("append").format("parquet").option("path", path)
    w = w.option("checkpointLocation", checkpoint)
    if by_start:
        w = w.partitionBy(PART).options(**bloom_options())
    if query_name:
        w = w.queryName(query_name)
    return with_trigger(w, trigger).start()


def writer_id(spark: SparkSession, checkpoint: str) -> str:
    """A stream's own id. It is in the checkpoint's metadata from the start: a
    checkpoint made anew at the same path is another writer, whose batch ids
    (from 0 again) don't replace the old one's."""
    meta = read_text(spark, f"{checkpoint.rstrip('/')}/metadata")
    return json.loads(meta.splitlines()[0])["id"]


def merge_latest(batch: DataFrame, table: str, key: str = "tripId", order: list[str] | None = None) -> None:
    """Upsert one batch into a catalog table whose format supports ``MERGE``
    (Delta, Iceberg): the batch is reduced to one row per key, and a
    stored row is replaced only by a later one. Untested here: no such format
    is installed, and Parquet tables reject ``MERGE``."""
    order = order or schemas.LATEST_ORDER
    reduced = latest_per_key(batch, key, order)
    view = f"_boardwalk_batch_{uuid.uuid4().hex[:12]}"
    reduced.createOrReplaceTempView(view)
    newer = f"struct({', '.join('s.' + c for c in order)}) > struct({', '.join('t.' + c for c in order)})"
    try:
        reduced.sparkSession.sql(
            f"MERGE INTO {table} t USING {view} s ON t.{key} = s.{key} "
            f"WHEN MATCHED AND {newer} THEN UPDATE SET * WHEN NOT MATCHED THEN INSERT *"
        )
    finally:
        reduced.sparkSession.catalog.dropTempView(view)


def write_upsert(
    board: DataFrame,
    path: str | None,
    checkpoint: str,
    key: str = "tripId",
    order: list[str] | None = None,
    trigger: str | None = None,
    query_name: str | None = None,
    register_as: str | None = None,
    merge_into: str | None = None,
    merge_every: int | None = 16,
    fanout: int = 8,
    retain: int = 1,
    output_mode: str = "append",
) -> StreamingQuery:
    """Keep the latest board row per ``key`` at ``path``, or, with
    ``merge_into``, in that catalog table through ``MERGE`` (a table format
    that supports it; ``path`` is then unused).

    ``board`` must carry the order columns (``derive_board(keep_order=True)``).
    Each micro-batch adds its own latest rows (``upsert.append_latest``), so
    its cost follows the batch and not the table, and a replayed batch
    replaces itself. After every ``merge_every`` batches the sink merges folders
    in tiers of ``fanout`` and keeps what the last ``retain`` merges cover
    (``upsert.merge_tiers``; None: never). ``register_as`` names a persistent catalog view of the
    latest rows, made at the first batch; it needs no renewal after."""
    spark = board.sparkSession
    order = order or schemas.LATEST_ORDER
    if not merge_into and not path:
        raise ValueError("an upsert needs a path or a table to merge into")
    known: dict[str, str] = {}

    def writer() -> str:
        if "id" not in known:
            known["id"] = writer_id(spark, checkpoint)
        return known["id"]

    def merge(batch: DataFrame, batch_id: int) -> None:
        if merge_into:
            merge_latest(batch, merge_into, key, order)
            return
        append_latest(batch, path, writer(), batch_id, key, order)
        if merge_every and (batch_id + 1) % merge_every == 0:
            merge_tiers(spark, path, key, order, fanout=fanout, retain=retain)
        if register_as and "view" not in known and is_upsert_path(spark, path):
            register_board_path(spark, path, register_as)
            known["view"] = register_as

    w = board.writeStream.outputMode(output_mode).foreachBatch(merge).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    return with_trigger(w, trigger).start()


# Six digits, so that times read back are the times written.
JSON_TIMES = {"timestampFormat": "yyyy-MM-dd'T'HH:mm:ss.SSSSSSXXX"}


def _message_writer(messages: DataFrame, writer, fmt: str, options: dict[str, str], path: str | None, connector: str | None):
    """``writer(frame)`` set up for a message sink."""
    if fmt == "kafka":
        return writer(messages.select("topic", "key", "value")).format(connector or "kafka").options(**options)
    if fmt == "kinesis":
        # The stream is an option; each topic is published to its own.
        out = messages.select(F.col("key").alias("partitionKey"), F.col("value").cast("binary").alias("data"))
        return writer(out).format(connector or "kinesis").options(**options)
    if path is None:
        raise ValueError("a file sink needs a path")
    extra = JSON_TIMES if fmt == "json" else {}
    return writer(messages).format(fmt).partitionBy("topic").options(**{**extra, **options}).option("path", path)


def publish(messages: DataFrame, fmt: str, options: dict[str, str] | None = None, path: str | None = None, connector: str | None = None) -> None:
    """Write routed messages ``topic, key, value`` (batch). Kafka sends each
    row to the topic it names; Kinesis gets partition key and data, with the
    stream among the options (publish one topic at a time); a file format
    writes one folder per topic. ``connector`` names the broker's data source,
    if not by its kind."""
    _message_writer(messages, lambda df: df.write.mode("append"), fmt, dict(options or {}), path, connector).save()


def publish_stream(
    messages: DataFrame,
    fmt: str,
    checkpoint: str,
    options: dict[str, str] | None = None,
    path: str | None = None,
    trigger: str | None = None,
    query_name: str | None = None,
    connector: str | None = None,
) -> StreamingQuery:
    """Stream routed messages ``topic, key, value, ingest_ts`` out, as
    ``publish`` does. Exactly-once for files (sink log); at-least-once for
    brokers, as for any producer."""
    w = _message_writer(messages, lambda df: df.writeStream, fmt, dict(options or {}), path, connector)
    w = w.outputMode("append").option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    return with_trigger(w, trigger).start()
