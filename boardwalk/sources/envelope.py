"""Message sources and parsing.

Every source is normalised to the envelope ``(key, value, ingest_ts)``:
``value`` is the message text, ``ingest_ts`` the time the broker (or file
system) received it. Parsing uses the fixed schemas and is PERMISSIVE: a
malformed or null message gives a row of null fields, which the inner join
then drops.
"""

from __future__ import annotations

import hashlib
import json
from urllib.parse import unquote

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boardwalk import schemas
from boardwalk.session import file_times, list_dir, path_exists, read_text, write_text

KAFKA = "kafka"
KINESIS = "kinesis"
FILE_FORMATS = ("json", "parquet")


def read_envelope(
    spark: SparkSession,
    fmt: str,
    options: dict[str, str] | None = None,
    path: str | None = None,
    stream: bool = True,
    checkpoint: str | None = None,
    connector: str | None = None,
) -> DataFrame:
    """Read messages from Kafka, Kinesis or a folder of envelope files.

    Connection settings (brokers, stream names, credentials) come in
    ``options``, never from code. Start position and data-loss tolerance are
    plain options too (``startingOffsets``/``startingposition``,
    ``failOnDataLoss``); a checkpoint overrides the start position on restart.

    ``connector``: the name of the broker's data source on the class path, if it
    is not that of the kind (there are Kinesis sources of several names).

    A folder understands the same two options. ``startingOffsets=latest`` passes over
    the files that are there when the stream with this ``checkpoint`` is first
    set up; they are ruled out by name. With ``failOnDataLoss=false`` a file
    that went before it was read is skipped; else that is an error, after a
    restart too if ``checkpoint`` is given.
    """
    options = dict(options or {})
    reader = spark.readStream if stream else spark.read
    if fmt == KAFKA:
        raw = _load_connector(reader.format(connector or KAFKA).options(**options), "spark-sql-kafka-0-10")
        return raw.select(
            F.col("key").cast("string").alias("key"),
            F.col("value").cast("string").alias("value"),
            F.col("timestamp").alias("ingest_ts"),
        )
    if fmt == KINESIS:
        raw = _load_connector(reader.format(connector or KINESIS).options(**options), "a Kinesis source for Spark")
        return raw.select(
            F.col("partitionKey").cast("string").alias("key"),
            F.col("data").cast("string").alias("value"),
            F.col("approximateArrivalTimestamp").alias("ingest_ts"),
        )
    if fmt in FILE_FORMATS:
        if path is None:
            raise ValueError("a file source needs a path")
        start, lossy = options.pop("startingOffsets", "earliest"), options.pop("failOnDataLoss", "true") == "false"
        if lossy:
            options["ignoreMissingFiles"] = "true"
        elif stream and checkpoint and (gone := lost_files(spark, checkpoint)):
            raise FileNotFoundError(f"{len(gone)} files of an unfinished batch are gone, the first is {gone[0]}; failOnDataLoss=false passes over them")
        rows = reader.format(fmt).schema(schemas.ENVELOPE).options(**options).load(path)
        if start == "latest" and stream:
            if checkpoint is None:
                raise ValueError("starting at the latest file needs the checkpoint")
            rows = _without(rows, kept_start(spark, path, checkpoint))
        return rows
    raise ValueError(f"unknown source format {fmt!r}")


#: Names of files up to which they are ruled out by a filter on the listing.
NAMED = 10_000


def kept_start(spark: SparkSession, path: str, checkpoint: str) -> list[str]:
    """The files that are in a folder when a stream over it is first set up;
    kept beside the checkpoint for all restarts. Names, not times: a file may
    be moved in long after it was written."""
    at = f"{checkpoint.rstrip('/')}.start-{hashlib.sha256(path.encode()).hexdigest()[:12]}.json"
    if not path_exists(spark, at):
        write_text(spark, at, json.dumps(sorted(file_times(spark, path))))
    return json.loads(read_text(spark, at))


def lost_files(spark: SparkSession, checkpoint: str) -> list[str]:
    """Files of the batches that a stream over folders has planned but not
    finished, which a restart reads, and which are gone by now. Spark passes
    over such files without a word."""
    base = checkpoint.rstrip("/")
    number = lambda names: [int(n.split(".")[0]) for n in names if n.split(".")[0].isdigit()]
    done = max(number(list_dir(spark, f"{base}/commits")), default=-1)
    if max(number(list_dir(spark, f"{base}/offsets")), default=-1) <= done:
        return []
    before = json_lines(spark, f"{base}/offsets/{done}")[1:] if done >= 0 else []
    gone = []
    for source in list_dir(spark, f"{base}/sources"):
        at = before[int(source)] if int(source) < len(before) else None
        read = at.get("logOffset", -1) if at else -1
        for log in list_dir(spark, f"{base}/sources/{source}"):
            if number([log]):
                entries = [e for e in json_lines(spark, f"{base}/sources/{source}/{log}") if "path" in e and e["batchId"] > read]
                gone += [e["path"] for e in entries if not path_exists(spark, unquote(e["path"]))]
    return sorted(set(gone))


def json_lines(spark: SparkSession, path: str) -> list:
    """The JSON lines of one of a checkpoint's log files, after its version."""
    return [None if x in ("", "-") else json.loads(x) for x in read_text(spark, path).splitlines()[1:]]


def _without(rows: DataFrame, names: list[str]) -> DataFrame:
    """``rows`` of a folder less those of the files named. A filter on file
    names keeps Spark from opening them; a longer list is a join, after which
    the old files are opened once and their rows dropped."""
    name = F.col("_metadata.file_name")
    if len(names) <= NAMED:
        return rows.where(~name.isin(*names)) if names else rows
    old = rows.sparkSession.createDataFrame([(n,) for n in names], "_old string")
    return rows.withColumn("_file", name).join(old, F.col("_file") == F.col("_old"), "left_anti").drop("_file")


#: What a message that does not parse leaves; null in all others.
CORRUPT = "_corrupt_record"


def _parse_once(envelopes: DataFrame, schema, side: str, corrupt: bool = False) -> DataFrame:
    """``m`` (the parsed message), ingest time and message hash; with
    ``corrupt`` the key and, of a message that does not parse, its text.

    The parsed struct comes out of a one-row generator. The join above infers
    ``isnotnull`` on every key; through a plain projection Catalyst would push
    each of those predicates below the parse, substituting ``from_json`` into
    each one, and the message would be parsed once per key plus once for the
    output. Predicates on generator output stay above the generator, so every
    message is parsed exactly once (measured: half the board's run time)."""
    value = F.col("value").cast("string")
    parts = [F.col("ingest_ts").alias(f"{side}_ingest_ts"), F.xxhash64("value").alias(f"{side}_hash")]
    if corrupt:
        schema = T.StructType([*schema, T.StructField(CORRUPT, T.StringType())])
        parts += [F.col("key").alias("key"), F.coalesce(value, F.lit("")).alias("value")]
    row = F.struct(F.from_json(value, schema, {"columnNameOfCorruptRecord": CORRUPT}).alias("m"), *parts)
    return envelopes.select(F.inline(F.array(row)))


def _load_connector(reader, package: str) -> DataFrame:
    try:
        return reader.load()
    except Exception as e:  # the data source class is not on the classpath
        if "DATA_SOURCE_NOT_FOUND" in str(e) or "Failed to find data source" in str(e):
            raise RuntimeError(f"connector not installed: add {package} to spark.jars.packages or spark.jars") from e
        raise


def parse_updates(envelopes: DataFrame, stops: bool = True) -> DataFrame:
    """Trip-update messages to columns: the trip fields, the stop list (unless
    ``stops`` is false: then only the trip is parsed), and the envelope's
    ingest time and a hash of the message (for ordering). A stop's departure
    is not parsed: the board has no use for it."""
    parts = ["m.stopTimeUpdate"] if stops else []
    schema = schemas.BOARD_UPDATE if stops else schemas.TRIP_ONLY
    return _parse_once(envelopes, schema, "u").select("m.trip.*", *parts, "u_ingest_ts", "u_hash")


def parse_status(envelopes: DataFrame, detail: bool = True) -> DataFrame:
    """Trip-status messages to columns, with ingest time and message hash;
    without ``detail`` only the trip is parsed."""
    parts = ["m.currentStopSequence", "m.currentStatus", "m.timestamp", "m.stopId"] if detail else []
    schema = schemas.TRIP_STATUS if detail else schemas.TRIP_ONLY
    return _parse_once(envelopes, schema, "s").select("m.trip.*", *parts, "s_ingest_ts", "s_hash")


DEAD = "dead"


def parse_or_keep(envelopes: DataFrame, kind: str) -> DataFrame:
    """Messages of one kind ("updates" or "status"), parsed once, with those
    that do not parse kept: ``dead`` tells them apart. A dead row has the
    message's key and text (``value``), a parsed one the columns that
    ``parse_updates`` / ``parse_status`` give. A null message is dead, with an
    empty text; one of another shape that is still a JSON object is not."""
    if kind == "updates":
        schema, side, parts = schemas.BOARD_UPDATE, "u", ["stopTimeUpdate"]
    elif kind == "status":
        schema, side, parts = schemas.TRIP_STATUS, "s", ["currentStopSequence", "currentStatus", "timestamp", "stopId"]
    else:
        raise ValueError(f"unknown kind {kind!r}")
    rows = _parse_once(envelopes, schema, side, corrupt=True)
    dead = F.col("m").isNull() | F.col(f"m.{CORRUPT}").isNotNull()
    rows = rows.select("m", dead.alias(DEAD), "key", "value", f"{side}_ingest_ts", f"{side}_hash")
    live = [F.when(~F.col(DEAD), F.col(f"m.{c}")).alias(c) for c in parts]
    trip = [F.when(~F.col(DEAD), F.col(f"m.trip.{c}")).alias(c) for c in schemas.TRIP.names]
    text = F.when(F.col(DEAD), F.col("value")).alias("value")
    return rows.select(*trip, *live, f"{side}_ingest_ts", f"{side}_hash", DEAD, "key", text)
