"""Parsing as a stream of its own, with the messages that fail kept.

Messages are parsed once and written to one folder, parsed rows and dead
letters apart (``dead=false``, ``dead=true``). The file sink's log makes each
batch exactly-once. How many messages came and how many were dead is observed
as the batch runs and stands in the query's progress."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from boardwalk.session import path_exists
from boardwalk.sources.envelope import DEAD, parse_or_keep
from boardwalk.streaming.sinks import with_trigger

OBSERVED = "intake"
DEAD_LETTER = "key string, value string, ingest_ts timestamp"


def write_intake(
    envelopes: DataFrame, kind: str, path: str, checkpoint: str, trigger: str | None = None, query_name: str | None = None
) -> StreamingQuery:
    """Parses the messages of one kind ("updates", "status") into ``path``.
    Every micro-batch's progress has ``messages`` and ``dead`` under
    ``intake``."""
    rows = parse_or_keep(envelopes, kind)
    seen = rows.observe(OBSERVED, F.count(F.lit(1)).alias("messages"), F.count_if(F.col(DEAD)).alias("dead"))
    w = seen.writeStream.outputMode("append").format("parquet").partitionBy(DEAD).option("path", path)
    w = w.option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    return with_trigger(w, trigger).start()


def counts(query: StreamingQuery) -> dict[str, int]:
    """Messages and dead letters of the batches in a query's recent progress."""
    found = [p["observedMetrics"][OBSERVED] for p in query.recentProgress if OBSERVED in p["observedMetrics"]]
    return {c: sum(f[c] for f in found) for c in ("messages", "dead")}


def _schema(kind: str, spark: SparkSession):
    empty = spark.createDataFrame([], "key string, value string, ingest_ts timestamp")
    return parse_or_keep(empty, kind).schema


def read_parsed(spark: SparkSession, kind: str, path: str, stream: bool = False) -> DataFrame:
    """The parsed rows, as ``parse_updates`` / ``parse_status`` give them; as a
    stream they can be reshaped and joined without being parsed again."""
    schema = _schema(kind, spark)
    if not stream and not path_exists(spark, path):
        return spark.createDataFrame([], schema).drop(DEAD, "key", "value")
    reader = spark.readStream if stream else spark.read
    return reader.schema(schema).parquet(path).where(~F.col(DEAD)).drop(DEAD, "key", "value")


def read_dead_letters(spark: SparkSession, kind: str, path: str) -> DataFrame:
    """``key, value, ingest_ts`` of the messages that did not parse."""
    if not path_exists(spark, path):
        return spark.createDataFrame([], DEAD_LETTER)
    at = "u_ingest_ts" if kind == "updates" else "s_ingest_ts"
    rows = spark.read.schema(_schema(kind, spark)).parquet(path).where(F.col(DEAD))
    return rows.select("key", "value", F.col(at).alias("ingest_ts"))
