"""Feed a stream from table-derived messages, slice by slice.

The messages are written once by a Spark job, partitioned by slice and topic;
delivering a slice moves its files into the stream's input folder. The caller
delivers slices in groups, in slice order; each group is drained by one
``availableNow`` run, so the query restarts from its checkpoint in between.
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boardwalk import schemas
from boardwalk.session import delete_path, list_dir, make_dirs, move_files, path_exists, stream_session, working_folder
from boardwalk.sources.envelope import read_envelope
from boardwalk.sources.fixtures import STATUS_TOPIC, UPDATES_TOPIC

TOPICS = (UPDATES_TOPIC, STATUS_TOPIC)

# A replay's state: no row count is kept up (it costs a look-up per row put or
# removed, and nobody watches a replay's progress), and blocks read again are
# found in a cache larger than Spark's 8 MB a store.
REPLAY_CONF = {
    "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows": "false",
    "spark.sql.streaming.stateStore.rocksdb.blockCacheSizeMB": "32",
}


class FeedReplay:
    """A run folder under the shared ``spark.checkpoint.dir``."""

    def __init__(self, spark: SparkSession, name: str, root: str | None = None, state_partitions: int | None = None):
        self.spark = spark
        self.root = root or working_folder(spark, name)
        self.stream_spark = stream_session(spark, state_partitions)
        for k, v in REPLAY_CONF.items():
            self.stream_spark.conf.set(k, v)

    def path(self, *parts: str) -> str:
        return "/".join([self.root, *parts])

    def stage(self, messages: DataFrame, slice_col: Column, rows_per_file: int = 16384) -> None:
        """Write ``topic, key, value, ingest_ts`` messages by slice and topic.

        The rows are rebalanced: adaptive execution splits a slice's topic over
        as many tasks as its bytes ask for and joins small ones. A file holds
        ``rows_per_file`` messages at most, so the stream reads a slice with
        tasks that grow in number with it."""
        out = messages.select("topic", "key", "value", "ingest_ts", slice_col.cast("int").alias("slice"))
        out = out.hint("rebalance", "slice", "topic")
        out.write.partitionBy("slice", "topic").option("maxRecordsPerFile", rows_per_file).parquet(self.path("stage"))

    def staged(self, topic_name: str) -> DataFrame:
        """Messages of a topic that are staged and not yet delivered."""
        schema = T.StructType([*schemas.ENVELOPE, T.StructField("slice", T.IntegerType()), T.StructField("topic", T.StringType())])
        return self.spark.read.schema(schema).parquet(self.path("stage")).where(F.col("topic") == topic_name)

    def deliver(self, wanted: str) -> None:
        """Move the files of the slices for which ``wanted`` (a condition on
        ``slice``) holds to the input folders; no row is written again."""
        names = [n for n in list_dir(self.spark, self.path("stage")) if n.startswith("slice=")]
        numbers = [int(n.split("=")[1]) for n in names if n.split("=")[1].lstrip("-").isdigit()]
        hits = self.spark.createDataFrame([(n,) for n in numbers], "slice int").where(wanted).collect()
        for r in sorted(hits):
            for t in TOPICS:
                make_dirs(self.spark, self.path("in", t))
                folder = self.path("stage", f"slice={r['slice']}", f"topic={t}")
                if path_exists(self.spark, folder):
                    move_files(self.spark, folder, self.path("in", t), f"slice-{r['slice']}-")

    def release_inputs(self) -> None:
        """Drop the staged feed, the delivered input and the checkpoint once
        the replay is over; the sink's output (which carries its own commit
        log) is all that is read afterwards."""
        for part in ("stage", "in", "ckpt", "ckpt.heavy.json"):
            delete_path(self.spark, self.path(part))

    def envelopes(self, topic_name: str, options: dict[str, str] | None = None, checkpoint: str | None = None) -> DataFrame:
        """Streaming envelopes of one topic from its input folder, in the
        replay's stream session. Parquet keeps times to the microsecond."""
        d = self.path("in", topic_name)
        make_dirs(self.spark, d)
        return read_envelope(self.stream_spark, "parquet", options, path=d, checkpoint=checkpoint)
