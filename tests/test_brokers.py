"""The broker branches of sources and sinks over stand-in connectors: columns,
options, restarts, start position, data loss, publishing."""

import json
import os
import sys

import pytest
from pyspark import cloudpickle
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from boardwalk import schemas
from boardwalk.plans import trip_board
from boardwalk.plans.board_plan import FIXTURE_CLOCK, messages
from boardwalk.session import stream_session
from boardwalk.sources.envelope import read_envelope
from boardwalk.sources.fixtures import STATUS_TOPIC, UPDATES_TOPIC
from boardwalk.streaming import AVAILABLE_NOW, board_stream, publish, publish_stream, write_append
from conftest import SF_SMALL, rows

sys.path.insert(0, os.path.dirname(os.path.abspath(__file__)))
import standins  # noqa: E402

OPTIONS = {
    "kafka": lambda folder, topic, start: {"folder": folder, "subscribe": topic, "startingOffsets": start, "kafka.bootstrap.servers": "none:0"},
    "kinesis": lambda folder, topic, start: {"folder": folder, "streamName": topic, "startingposition": start.upper() if start == "latest" else "TRIM_HORIZON"},
}


@pytest.fixture(scope="module")
def session(spark):
    """A session that knows the stand-ins."""
    cloudpickle.register_pickle_by_value(standins)
    s = stream_session(spark, 3)
    for kind in (standins.Kafka, standins.Kinesis):
        s.dataSource.register(kind)
    return s


@pytest.fixture
def brokers(session, tmp_path):
    """The session, and a broker's folder."""
    return session, str(tmp_path)


def _feed(spark, part, parts=2):
    """Messages of a part of the trips, by topic."""
    msgs = messages(spark, SF_SMALL).where(F.pmod(F.col("key").cast("bigint"), F.lit(parts)) == part)
    out = {UPDATES_TOPIC: [], STATUS_TOPIC: []}
    for r in msgs.select("topic", "key", "value", F.unix_seconds("ingest_ts").alias("at")).collect():
        out[r.topic].append((r.key, r.value, r["at"]))
    return out


@pytest.mark.parametrize("kind", ["kafka", "kinesis"])
def test_two_topics_become_the_board(spark, brokers, kind):
    s, folder = brokers
    for part in range(2):
        for topic, some in _feed(spark, part).items():
            standins.put(f"{folder}/b", topic, some)
        u, v = (read_envelope(s, kind, OPTIONS[kind](f"{folder}/b", t, "earliest"), connector=f"standin_{kind}") for t in (UPDATES_TOPIC, STATUS_TOPIC))
        assert u.columns == ["key", "value", "ingest_ts"] and u.isStreaming
        assert [f.dataType for f in u.schema] == [f.dataType for f in schemas.ENVELOPE]
        write_append(board_stream(u, v, clock=FIXTURE_CLOCK), f"{folder}/out", f"{folder}/ckpt", trigger=AVAILABLE_NOW).awaitTermination()
    assert rows(spark.read.schema(schemas.BOARD).parquet(f"{folder}/out")) == rows(trip_board(spark, SF_SMALL))


@pytest.mark.parametrize("kind", ["kafka", "kinesis"])
def test_envelopes_as_a_batch(brokers, kind):
    s, folder = brokers
    standins.put(folder, "t", [("k", "{}", 1665568800), ("l", "x", 1665568801)])
    got = read_envelope(s, kind, OPTIONS[kind](folder, "t", "earliest"), stream=False, connector=f"standin_{kind}")
    assert [(r.key, r.value, r.ingest_ts.isoformat()) for r in got.orderBy("key").collect()] == [("k", "{}", "2022-10-12T10:00:00"), ("l", "x", "2022-10-12T10:00:01")]


def _drain(df, ckpt, seen):
    q = df.writeStream.foreachBatch(lambda b, i: seen.extend(r.value for r in b.collect())).option("checkpointLocation", ckpt)
    q.trigger(availableNow=True).start().awaitTermination()


@pytest.mark.parametrize("kind", ["kafka", "kinesis"])
def test_first_start_at_the_latest_then_the_checkpoint_counts(brokers, kind):
    s, folder = brokers
    seen: list = []
    standins.put(folder, "t", [("k", "old", 1)])
    latest = OPTIONS[kind](folder, "t", "latest")
    _drain(read_envelope(s, kind, latest, connector=f"standin_{kind}"), f"{folder}/ckpt", seen)
    assert seen == []
    standins.put(folder, "t", [("k", "new1", 2)])
    _drain(read_envelope(s, kind, latest, connector=f"standin_{kind}"), f"{folder}/ckpt", seen)
    # A restart goes on where the checkpoint is, whatever the option says.
    standins.put(folder, "t", [("k", "new2", 3)])
    _drain(read_envelope(s, kind, OPTIONS[kind](folder, "t", "earliest"), connector=f"standin_{kind}"), f"{folder}/ckpt", seen)
    assert seen == ["new1", "new2"]


@pytest.mark.parametrize("fail", ["true", "false"])
def test_lost_messages_fail_the_stream_or_are_passed_over(brokers, fail):
    s, folder = brokers
    seen: list = []
    options = {**OPTIONS["kafka"](folder, "t", "earliest"), "failOnDataLoss": fail}
    standins.put(folder, "t", [("k", "a", 1)])
    _drain(read_envelope(s, "kafka", options, connector="standin_kafka"), f"{folder}/ckpt", seen)
    standins.put(folder, "t", [("k", "b", 2), ("k", "c", 3)])
    standins.expire(folder, "t", 2)
    if fail == "true":
        with pytest.raises(StreamingQueryException, match="are lost"):
            _drain(read_envelope(s, "kafka", options, connector="standin_kafka"), f"{folder}/ckpt", seen)
        assert seen == ["a"]
    else:
        _drain(read_envelope(s, "kafka", options, connector="standin_kafka"), f"{folder}/ckpt", seen)
        assert seen == ["a", "c"]


def _published(folder):
    out = []
    for topic in sorted(os.listdir(folder)):
        for name in os.listdir(f"{folder}/{topic}"):
            with open(f"{folder}/{topic}/{name}") as f:
                out += [(topic, *sorted(json.loads(x).items())) for x in f]
    return sorted(out, key=str)


def test_publishing_routes_each_message_to_its_topic(spark, brokers):
    s, folder = brokers
    msgs = s.createDataFrame([("trip_updates", "1", "{}"), ("trip_status", "1", "{s}"), ("trip_updates", None, "{u}")], "topic string, key string, value string")
    publish(msgs, "kafka", {"folder": f"{folder}/k"}, connector="standin_kafka")
    got = [(topic, dict(fields)) for topic, *fields in _published(f"{folder}/k")]
    assert [t for t, _ in got] == ["trip_status", "trip_updates", "trip_updates"]
    assert sorted(m["value"] for _, m in got) == ["{s}", "{u}", "{}"] and {m["key"] for _, m in got} == {"1", None}
    publish(msgs.where("topic = 'trip_updates'"), "kinesis", {"folder": f"{folder}/n"}, connector="standin_kinesis")
    got = [dict(fields) for _, *fields in _published(f"{folder}/n")]
    assert sorted(m["data"] for m in got) == ["{u}", "{}"] and {m["partitionKey"] for m in got} == {"1", None}


def test_publishing_as_a_stream(brokers):
    s, folder = brokers
    s.createDataFrame([("trip_updates", "1", "{}"), ("trip_status", "2", "{s}")], "topic string, key string, value string").write.parquet(f"{folder}/in")
    msgs = s.readStream.schema("topic string, key string, value string").parquet(f"{folder}/in")
    publish_stream(msgs, "kafka", f"{folder}/ckpt", {"folder": f"{folder}/k"}, trigger=AVAILABLE_NOW, connector="standin_kafka").awaitTermination()
    assert _published(f"{folder}/k") == [("trip_status", ("key", "2"), ("value", "{s}")), ("trip_updates", ("key", "1"), ("value", "{}"))]
