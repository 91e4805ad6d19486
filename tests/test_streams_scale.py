"""Heavy trips, state inspection, staging, start position, lost files, dead
letters."""

import datetime as dt
import json
import uuid

import pytest
from pyspark.errors import StreamingQueryException
from pyspark.sql import functions as F

from boardwalk import schemas
from boardwalk.operators import heavy_trips, join_feeds
from boardwalk.plans import registered
from boardwalk.plans.board_plan import FIXTURE_CLOCK, board_from_messages, feeds, messages
from boardwalk.session import delete_path, list_dir, path_exists, shared_dir, stream_session
from boardwalk.sources import read_board
from boardwalk.sources.envelope import parse_or_keep, parse_status, parse_updates, read_envelope
from boardwalk.sources.fixtures import STATUS_TOPIC, UPDATES_TOPIC
from boardwalk.streaming import AVAILABLE_NOW, FeedReplay, board_stream, hot_partitions, join_state, kept_heavy_trips, state_by_partition, write_append, write_intake
from boardwalk.streaming import intake
from conftest import SF_SMALL, rows

HOT = "HOT"


def _new(spark, kind):
    return f"{shared_dir(spark)}/test-{kind}-{uuid.uuid4().hex[:8]}"


def _hot_feed(spark):
    """The fixture feed and a trip that has a third of all updates."""
    msgs = messages(spark, SF_SMALL).select("topic", "key", "value", "ingest_ts")
    n = msgs.where(F.col("topic") == UPDATES_TOPIC).count() // 2
    trip = {"tripId": HOT, "startTime": "10:00:00", "startDate": "20221012", "routeId": "R"}
    text = json.dumps({"trip": trip, "stopTimeUpdate": [{"arrival": {"time": "NO"}, "stopId": "S"}]})
    at = F.timestamp_seconds(F.col("id") + 1665568800).alias("ingest_ts")
    updates = spark.range(n).select(F.lit(UPDATES_TOPIC).alias("topic"), F.lit(HOT).alias("key"), F.replace(F.lit(text), F.lit("NO"), F.col("id").cast("string")).alias("value"), at)
    status = json.dumps({"trip": trip, "currentStopSequence": 1, "currentStatus": "STOPPED_AT", "timestamp": "1665568800", "stopId": "S"})
    statuses = spark.range(2).select(F.lit(STATUS_TOPIC).alias("topic"), F.lit(HOT).alias("key"), F.lit(status).alias("value"), at)
    return msgs.unionByName(updates).unionByName(statuses), n


def _slices(msgs):
    return F.pmod(F.xxhash64("topic", "key", "ingest_ts"), F.lit(2)).cast("int")


# -- heavy trips -------------------------------------------------------------------
def test_heavy_trips_are_those_over_the_share(spark):
    data = ["a"] * 50 + ["b"] * 30 + ["c"] * 3 + [None] * 40 + [f"x{i}" for i in range(77)]
    df = spark.createDataFrame([(k,) for k in data], "key string").repartition(4)
    assert heavy_trips(df, 0.1) == ["a", "b"] and heavy_trips(df, 0.2) == ["a"] and heavy_trips(df, 0.3) == []
    assert heavy_trips(df.limit(0)) == [] and heavy_trips(df.where("key IS NULL")) == []
    with pytest.raises(ValueError):
        heavy_trips(df, 0.001)


def test_salting_heavy_trips_alone_leaves_the_join_as_it_is(spark):
    msgs, _ = _hot_feed(spark)
    u, s = feeds(msgs)
    plain = rows(join_feeds(u, s))
    assert rows(join_feeds(u, s, salt=5, heavy=[HOT])) == plain
    assert rows(join_feeds(u, s, salt=5, heavy=[])) == plain


@pytest.mark.parametrize("bound", [None, "400 days"])
def test_a_hot_trip_is_spread_and_cold_statuses_are_stored_once(spark, bound):
    """A third of all updates on one trip, with restarts: the batch board's
    rows, the hot trip's state in many partitions, one copy of any other
    trip's status."""
    msgs, n = _hot_feed(spark)
    r = FeedReplay(spark, "test-hot", state_partitions=6)
    r.stage(msgs, _slices(msgs))
    heavy = kept_heavy_trips(r.staged(UPDATES_TOPIC), r.path("ckpt"))
    assert heavy == [HOT]
    for i in range(2):
        r.deliver(f"slice = {i}")
        # In a restart the kept list counts, whatever the source holds by then.
        kept = kept_heavy_trips(r.staged(UPDATES_TOPIC).limit(0), r.path("ckpt"))
        b = board_stream(r.envelopes(UPDATES_TOPIC), r.envelopes(STATUS_TOPIC), clock=FIXTURE_CLOCK, salt=4, heavy=kept, bound=bound, watermark=bound and "20000 days")
        write_append(b, r.path("board"), r.path("ckpt"), trigger=AVAILABLE_NOW).awaitTermination()
    assert rows(read_board(spark, r.path("board"))) == rows(board_from_messages(msgs))
    if bound:
        return
    state = join_state(r.stream_spark, r.path("ckpt"))
    per = {(x.side, x.hot): (x.n, x.parts) for x in state.groupBy("side", F.col("key").contains(HOT).alias("hot")).agg(F.count(F.lit(1)).alias("n"), F.count_distinct("partition_id").alias("parts")).collect()}
    statuses = msgs.where((F.col("topic") == STATUS_TOPIC) & (F.col("key") != HOT)).count()
    assert per["status", False][0] == statuses  # stored once
    assert per["status", True][0] == 2 * 4
    assert per["updates", True][0] == n and per["updates", True][1] >= 2
    by = state_by_partition(r.stream_spark, r.path("ckpt"))
    updates = msgs.where(F.col("topic") == UPDATES_TOPIC).count()
    assert {x.side: x.n for x in by.groupBy("side").agg(F.sum("rows").alias("n")).collect()} == {"updates": updates, "status": statuses + 8}
    assert max(x["share"] for x in by.where("side = 'updates'").collect()) < 0.5


def test_hot_partitions_show_an_unsalted_hot_trip(spark):
    msgs, _ = _hot_feed(spark)
    r = FeedReplay(spark, "test-hot-plain", state_partitions=16)
    r.stage(msgs, F.lit(0))
    r.deliver("slice = 0")
    b = board_stream(r.envelopes(UPDATES_TOPIC), r.envelopes(STATUS_TOPIC), clock=FIXTURE_CLOCK)
    write_append(b, r.path("board"), r.path("ckpt"), trigger=AVAILABLE_NOW).awaitTermination()
    hot = hot_partitions(r.stream_spark, r.path("ckpt")).collect()
    assert [x.side for x in hot] == ["updates"] and hot[0].share > 1 / 3


def test_bounded_state_is_evicted_on_both_sides(spark):
    """The state readers see what the watermark left."""
    root = _new(spark, "evict")
    trip = lambda k: {"tripId": k, "startTime": "10:00:00", "startDate": "20221012", "routeId": "R"}
    t0 = dt.datetime(2022, 10, 12, 10, 0)

    def add(keys, ts):
        for side, more in (("u", {}), ("s", {"currentStatus": "STOPPED_AT"})):
            spark.createDataFrame([(k, json.dumps({"trip": trip(k), **more}), ts) for k in keys], schemas.ENVELOPE).write.mode("append").json(f"{root}/{side}")

    s = stream_session(spark, 3)
    for keys, ts in ((["A", "B"], t0), (["C"], t0 + dt.timedelta(days=1)), (["D"], t0 + dt.timedelta(days=1, minutes=1))):
        add(keys, ts)
        b = board_stream(read_envelope(s, "json", path=f"{root}/u"), read_envelope(s, "json", path=f"{root}/s"), clock=F.col("u_ingest_ts"), bound="10 minutes")
        write_append(b, f"{root}/out", f"{root}/ckpt", trigger=AVAILABLE_NOW).awaitTermination()
    held = {(x.side, k) for x in join_state(s, f"{root}/ckpt").collect() for k in "ABCD" if f'"{k}"' in x.key}
    assert held == {(side, k) for side in ("updates", "status") for k in "CD"}


# -- staging -----------------------------------------------------------------------
def test_staging_and_reading_tasks_grow_with_the_feed(spark):
    """Files follow the rows of a slice, the tasks that write them its bytes;
    delivery moves files and writes nothing."""
    msgs = messages(spark, SF_SMALL)
    r = FeedReplay(spark, "test-grow")
    small = {"spark.sql.adaptive.advisoryPartitionSizeInBytes": "8k", "spark.sql.adaptive.coalescePartitions.enabled": "false"}
    before = {k: spark.conf.get(k) for k in small}
    for k, v in small.items():
        spark.conf.set(k, v)
    try:
        r.stage(msgs, F.lit(0), rows_per_file=200)
    finally:
        for k, v in before.items():
            spark.conf.set(k, v)
    names = list_dir(spark, r.path("stage", "slice=0", f"topic={UPDATES_TOPIC}"))
    names = [n for n in names if not n.startswith(".")]
    assert len(names) >= msgs.where(F.col("topic") == UPDATES_TOPIC).count() / 200
    assert len({n.split("-")[1] for n in names}) > 2  # tasks that wrote them
    r.deliver("slice = 0")
    assert [n for n in list_dir(spark, r.path("in", UPDATES_TOPIC)) if not n.startswith(".")] == [f"slice-0-{n}" for n in names if not n.startswith(".")]
    assert rows(spark.read.parquet(r.path("in", UPDATES_TOPIC)), ["key", "value", "ingest_ts"]) == rows(msgs.where(F.col("topic") == UPDATES_TOPIC), ["key", "value", "ingest_ts"])


# -- start position and lost files ---------------------------------------------------
def _put(spark, folder, key, ts=dt.datetime(2022, 10, 12, 10, 0)):
    spark.createDataFrame([(key, "{}", ts)], schemas.ENVELOPE).coalesce(1).write.mode("append").json(folder)


def _keys(spark, folder, ckpt, options, seen):
    df = read_envelope(spark, "json", options, path=folder, checkpoint=ckpt)
    q = df.writeStream.foreachBatch(lambda b, i: seen.extend(r.key for r in b.collect())).option("checkpointLocation", ckpt)
    q.trigger(availableNow=True).start().awaitTermination()


@pytest.mark.parametrize("named", [10_000, 0])
def test_starting_at_the_latest_file(spark, monkeypatch, named):
    from boardwalk.sources import envelope

    monkeypatch.setattr(envelope, "NAMED", named)
    root, seen = _new(spark, "latest"), []
    latest = {"startingOffsets": "latest"}
    for k in ("old1", "old2"):
        _put(spark, f"{root}/in", k)
    _keys(spark, f"{root}/in", f"{root}/ckpt", latest, seen)
    assert seen == []
    _put(spark, f"{root}/in", "new1")
    _keys(spark, f"{root}/in", f"{root}/ckpt", latest, seen)
    _put(spark, f"{root}/in", "new2")
    _keys(spark, f"{root}/in", f"{root}/ckpt", latest, seen)
    assert seen == ["new1", "new2"]
    _keys(spark, f"{root}/in", f"{root}/ckpt-early", {}, early := [])
    assert sorted(early) == ["new1", "new2", "old1", "old2"]
    with pytest.raises(ValueError):
        read_envelope(spark, "json", latest, path=f"{root}/in")


@pytest.mark.parametrize("fail", ["true", "false"])
def test_a_lost_file_fails_or_is_skipped(spark, fail):
    """A batch is planned, fails, and one of its files is gone at the restart."""
    root, seen = _new(spark, "lost"), []
    for k in ("a", "b", "c"):
        _put(spark, f"{root}/in", k)
    options, ckpt = {"failOnDataLoss": fail}, f"{root}/ckpt"

    def broken(batch, i):
        raise OSError("down")

    w = read_envelope(spark, "json", options, path=f"{root}/in", checkpoint=ckpt).writeStream.foreachBatch(broken)
    with pytest.raises(StreamingQueryException, match="down"):
        w.option("checkpointLocation", ckpt).trigger(availableNow=True).start().awaitTermination()
    files = [n for n in list_dir(spark, f"{root}/in") if n.startswith("part")]
    delete_path(spark, f"{root}/in/{files[0]}")
    if fail == "true":
        with pytest.raises(FileNotFoundError, match="1 files of an unfinished batch"):
            _keys(spark, f"{root}/in", ckpt, options, seen)
        assert seen == []
        return
    _keys(spark, f"{root}/in", ckpt, options, seen)
    assert len(seen) == 2
    _put(spark, f"{root}/in", "d")
    _keys(spark, f"{root}/in", ckpt, options, seen)
    assert len(seen) == 3 and seen[-1] == "d"


# -- dead letters ------------------------------------------------------------------
BAD = ["", "{", "not json", '{"trip": {"tripId": "x"', '[1, 2', None, '{"trip": 5']
ODD = ["{}", '{"trip": {"tripId": "t1"}}', '{"other": 1}']


def _odd(spark):
    ts = dt.datetime(2022, 10, 12, 10, 0)
    return spark.createDataFrame([(f"k{i}", v, ts) for i, v in enumerate(BAD + ODD)], schemas.ENVELOPE).repartition(3)


@pytest.mark.parametrize(("kind", "parse"), [("updates", parse_updates), ("status", parse_status)])
def test_dead_letters_and_parsed_rows_make_up_the_input(spark, kind, parse):
    rows_ = parse_or_keep(_odd(spark), kind)
    dead = rows_.where("dead")
    assert sorted((r.key, r.value) for r in dead.collect()) == sorted((f"k{i}", v or "") for i, v in enumerate(BAD))
    good = rows_.where("NOT dead").drop("dead", "key", "value")
    assert good.count() == len(ODD) and good.columns == parse(_odd(spark)).columns
    msgs = messages(spark, SF_SMALL).where(F.col("topic") == (UPDATES_TOPIC if kind == "updates" else STATUS_TOPIC))
    kept = parse_or_keep(msgs, kind)
    assert rows(kept.where("NOT dead").drop("dead", "key", "value")) == rows(parse(msgs))
    assert kept.where("dead").count() == 0
    plan = kept._jdf.queryExecution().executedPlan().toString()
    assert plan.count("from_json") == 1  # one parse
    with pytest.raises(ValueError):
        parse_or_keep(msgs, "other")


def test_intake_counts_what_it_reads(spark):
    root = _new(spark, "intake")
    total = dead = 0
    for part in range(2):
        _odd(spark).where(F.pmod(F.xxhash64("key"), F.lit(2)) == part).write.mode("append").parquet(f"{root}/in")
        q = write_intake(read_envelope(spark, "parquet", path=f"{root}/in"), "updates", f"{root}/out", f"{root}/ckpt", trigger=AVAILABLE_NOW)
        q.awaitTermination()
        found = intake.counts(q)
        total, dead = total + found["messages"], dead + found["dead"]
    assert (total, dead) == (len(BAD + ODD), len(BAD))
    assert intake.read_dead_letters(spark, "updates", f"{root}/out").count() == dead
    assert intake.read_parsed(spark, "updates", f"{root}/out").count() == total - dead
    assert intake.read_dead_letters(spark, "updates", f"{root}/none").count() == 0
    assert intake.read_parsed(spark, "updates", f"{root}/none").count() == 0


def test_a_stream_joins_what_the_intake_parsed(spark):
    """Parsed rows feed the join as streams; nothing is parsed again."""
    from boardwalk.operators import derive_board, reshape_status, reshape_updates

    r = registered._taken_in(spark, SF_SMALL)
    s = r.stream_spark
    u, v = (intake.read_parsed(s, k, r.path(k), stream=True) for k in registered.KINDS)
    board = derive_board(join_feeds(reshape_updates(u), reshape_status(v)), clock=FIXTURE_CLOCK)
    write_append(board, r.path("board"), r.path("ckpt2"), trigger=AVAILABLE_NOW).awaitTermination()
    assert rows(read_board(spark, r.path("board"))) == rows(registered.board_after_intake(spark, SF_SMALL))


def test_replays_leave_only_their_result(spark):
    msgs = messages(spark, SF_SMALL)
    r = registered._staged(spark, SF_SMALL, "test-release", registered._trip_slices)
    assert path_exists(spark, r.path("ckpt.heavy.json")) and heavy_trips(msgs.where(F.col("topic") == UPDATES_TOPIC)) == []
    r.release_inputs()
    assert list_dir(spark, r.root) == []


# -- latest row as an aggregation ------------------------------------------------------
@pytest.mark.parametrize("expire", [None, "3650 days"])
def test_unchanged_trips_are_not_written_again(spark, expire):
    from boardwalk.sources.upsert import read_deltas, read_latest
    from boardwalk.streaming import write_latest

    root = _new(spark, "changes")
    board = board_from_messages(messages(spark, SF_SMALL), keep_order=True)
    part = F.pmod(F.xxhash64("tripId"), F.lit(2))

    def add(rows_):
        rows_.coalesce(2).write.mode("append").parquet(f"{root}/in")
        stream = stream_session(spark, 4).readStream.schema(schemas.BOARD_WITH_ORDER).parquet(f"{root}/in")
        write_latest(stream, f"{root}/table", f"{root}/ckpt", expire=expire, trigger=AVAILABLE_NOW, merge_every=None).awaitTermination()
        return read_deltas(spark, f"{root}/table").count()

    first = add(board.where(part == 0))
    assert first == board.where(part == 0).select("tripId").distinct().count()
    assert add(board.where(part == 0)) == first  # a replay of what is known
    # Without a start time the clock stands in for it: an older one is another state.
    older = board.where((part == 0) & F.col("startTime").isNotNull()).withColumn("currentTime", F.col("currentTime") - F.expr("INTERVAL 1 DAY"))
    assert add(older) == first  # nothing later
    second = add(board.where(part == 1).union(board.where(part == 0).limit(20)))
    assert second == board.select("tripId").distinct().count()
    newer = board.where(part == 0).limit(1).withColumn("currentTime", F.col("currentTime") + F.expr("INTERVAL 1 DAY"))
    newer = spark.createDataFrame(newer.collect(), schemas.BOARD_WITH_ORDER)
    assert add(newer) == second + 1
    want = board.union(newer)
    from boardwalk.operators import latest_per_key

    assert rows(read_latest(spark, f"{root}/table")) == rows(latest_per_key(want, "tripId", schemas.LATEST_ORDER))


def test_state_of_ended_trips_expires(spark):
    from boardwalk.streaming import write_latest

    root = _new(spark, "expire")
    s = stream_session(spark, 3)
    board = board_from_messages(messages(spark, SF_SMALL), keep_order=True).where("startTime IS NOT NULL")
    early, late = board.where("startTime < TIMESTAMP_NTZ '1993-01-01'"), board.where("startTime > TIMESTAMP_NTZ '1998-06-01'")
    for part in (early, late, late.limit(1)):
        part.coalesce(1).write.mode("append").parquet(f"{root}/in")
        rows_ = s.readStream.schema(schemas.BOARD_WITH_ORDER).parquet(f"{root}/in")
        write_latest(rows_, f"{root}/table", f"{root}/ckpt", expire="30 days", trigger=AVAILABLE_NOW).awaitTermination()
    held = s.read.format("statestore").load(f"{root}/ckpt")
    kept = {r.tripId for r in held.select("key.tripId").collect()}
    assert kept and kept <= {r.tripId for r in late.select("tripId").collect()}


def test_app_salts_heavy_trips_and_lays_out_by_start(spark):
    from boardwalk.app import parser, start
    from boardwalk.sources.layout import read_clustered

    root = _new(spark, "app3")
    msgs, _ = _hot_feed(spark)
    for t in (UPDATES_TOPIC, STATUS_TOPIC):
        msgs.where(F.col("topic") == t).select("key", "value", "ingest_ts").write.json(f"{root}/in/{t}")
    args = parser().parse_args([
        "--source", "json", "--updates-path", f"{root}/in/{UPDATES_TOPIC}", "--status-path", f"{root}/in/{STATUS_TOPIC}",
        "--sink", "append", "--path", f"{root}/out", "--checkpoint", f"{root}/ckpt", "--trigger", "available_now",
        "--salt", "3", "--heavy-share", "0.1", "--by-start", "month", "--state-partitions", "4",
    ])
    start(spark, args).awaitTermination()
    assert kept_heavy_trips(msgs.limit(0), f"{root}/ckpt") == [HOT]
    cols = [c for c in schemas.BOARD_COLUMNS if c != "currentTime"]
    assert rows(read_clustered(spark, f"{root}/out").select(*cols)) == rows(board_from_messages(msgs).select(*cols))
