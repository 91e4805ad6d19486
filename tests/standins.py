"""Stand-ins for broker connectors: Python data sources with the names, columns
and options of the real ones, over folders of JSON lines. They run inside the
test's own Spark session; nothing listens anywhere."""

import datetime as dt
import json
import os
import uuid

from pyspark.sql.datasource import DataSource, DataSourceStreamWriter, DataSourceWriter, InputPartition, DataSourceReader, SimpleDataSourceStreamReader, WriterCommitMessage

UTC = dt.timezone.utc


def put(folder, topic, rows):
    """Appends messages (key, value, seconds) to a topic."""
    os.makedirs(f"{folder}/{topic}", exist_ok=True)
    with open(f"{folder}/{topic}/{len(os.listdir(f'{folder}/{topic}')):06d}.jsonl", "w") as f:
        f.writelines(json.dumps(r) + "\n" for r in rows)


def expire(folder, topic, n):
    """The broker lets go of a topic's first ``n`` messages."""
    with open(f"{folder}/{topic}.expired", "w") as f:
        f.write(str(n))


def _messages(folder, topic):
    d = f"{folder}/{topic}"
    for name in sorted(os.listdir(d)) if os.path.isdir(d) else []:
        with open(f"{d}/{name}") as f:
            yield from map(json.loads, f)


class Stream(SimpleDataSourceStreamReader):
    def __init__(self, options, topic, start, row):
        self.folder, self.topic, self.start, self.row = options["folder"], topic, start, row
        self.fail = options.get("failondataloss", "true") == "true"

    def _all(self):
        return list(_messages(self.folder, self.topic))

    def initialOffset(self):
        return {"offset": len(self._all()) if self.start == "latest" else 0}

    def read(self, start):
        end = {"offset": len(self._all())}
        return self.readBetweenOffsets(start, end), end

    def readBetweenOffsets(self, start, end):
        path = f"{self.folder}/{self.topic}.expired"
        gone = int(open(path).read()) if os.path.exists(path) else 0
        if start["offset"] < gone and self.fail:
            raise ValueError(f"offsets {start['offset']} to {gone} of {self.topic} are lost")
        rows = self._all()[max(start["offset"], gone) : end["offset"]]
        return iter([self.row(i, m) for i, m in enumerate(rows)])

    def commit(self, end):
        pass


class Batch(DataSourceReader):
    def __init__(self, options, topic, row):
        self.folder, self.topic, self.row = options["folder"], topic, row

    def partitions(self):
        return [InputPartition(0)]

    def read(self, partition):
        return iter([self.row(i, m) for i, m in enumerate(_messages(self.folder, self.topic))])


def _bytes(x):
    return None if x is None else x.encode()


def _kafka_row(topic):
    return lambda i, m: (_bytes(m[0]), _bytes(m[1]), topic, 0, i, dt.datetime.fromtimestamp(m[2], UTC), 0)


def _kinesis_row(i, m):
    return (m[1].encode(), "shard-0", m[0], str(i), dt.datetime.fromtimestamp(m[2], UTC))


class _Write:
    def __init__(self, folder, columns):
        self.folder, self.columns = folder, columns

    def write(self, rows):
        name = uuid.uuid4().hex
        by = {}
        for r in rows:
            v = dict(zip(self.columns, r, strict=True))
            text = {k: x.decode() if isinstance(x, (bytes, bytearray)) else x for k, x in v.items()}
            by.setdefault(text.pop("topic", "stream"), []).append(text)
        for topic, some in by.items():
            os.makedirs(f"{self.folder}/{topic}", exist_ok=True)
            with open(f"{self.folder}/{topic}/{name}.jsonl", "w") as f:
                f.writelines(json.dumps(x) + "\n" for x in some)
        return WriterCommitMessage()

    def commit(self, messages, *batch):
        pass

    def abort(self, messages, *batch):
        pass


class BatchWrite(_Write, DataSourceWriter):
    pass


class StreamWrite(_Write, DataSourceStreamWriter):
    pass


class _Writable(DataSource):
    def writer(self, schema, overwrite):
        return BatchWrite(self.options["folder"], schema.names)

    def streamWriter(self, schema, overwrite):
        return StreamWrite(self.options["folder"], schema.names)


class Kafka(_Writable):
    @classmethod
    def name(cls):
        return "standin_kafka"

    def schema(self):
        return "key binary, value binary, topic string, partition int, offset bigint, timestamp timestamp, timestampType int"

    def simpleStreamReader(self, schema):
        topic = self.options["subscribe"]
        return Stream(self.options, topic, self.options.get("startingoffsets", "latest"), _kafka_row(topic))

    def reader(self, schema):
        topic = self.options["subscribe"]
        return Batch(self.options, topic, _kafka_row(topic))


class Kinesis(_Writable):
    @classmethod
    def name(cls):
        return "standin_kinesis"

    def schema(self):
        return "data binary, streamName string, partitionKey string, sequenceNumber string, approximateArrivalTimestamp timestamp"

    def simpleStreamReader(self, schema):
        start = "latest" if self.options.get("startingposition") == "LATEST" else "earliest"
        return Stream(self.options, self.options["streamname"], start, _kinesis_row)

    def reader(self, schema):
        return Batch(self.options, self.options["streamname"], _kinesis_row)
