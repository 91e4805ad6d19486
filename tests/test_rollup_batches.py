"""A rollup's batch, however long it takes and whatever its clocks."""

import time
import uuid

from pyspark.sql import functions as F

from boardwalk.plans import registered
from boardwalk.session import shared_dir
from boardwalk.streaming import rollup
from boardwalk.streaming.rollup import append_rollup, fold_rollup
from boardwalk.streaming.state import side_state
from conftest import SF_SMALL, rows

BOARD = "tripId string, routeId string, currentTime timestamp_ntz, numOfFutureStops int"


def _new(spark):
    return f"{shared_dir(spark)}/test-rollup-{uuid.uuid4().hex[:8]}"


def test_a_batch_may_take_longer_than_a_broadcast(spark):
    """As in a stream: no adaptive execution, and rows that take their time."""
    s = spark.newSession()
    s.conf.set("spark.sql.adaptive.enabled", "false")
    s.conf.set("spark.sql.broadcastTimeout", "1s")

    def slow(x):
        time.sleep(2)
        return x

    ids = s.range(0, 4, 1, 1).withColumn("x", F.udf(slow, "bigint")("id"))
    board = ids.selectExpr("string(x) tripId", "'R' routeId", "timestamp_ntz'2020-01-01 00:00:00' + make_dt_interval(x div 2) currentTime", "int(x) + 1 numOfFutureStops")
    path = _new(spark)
    append_rollup(board, path, "w", 0)
    assert rows(rollup.trips_per_route(spark, path)) == [("R", 4)]
    assert rows(rollup.first_snapshot(spark, path).select("tripId", "numOfFutureStops")) == [("0", 1), ("1", 2)]


def test_earliest_clock_of_any_year_and_of_none(spark):
    clocks = ["+12000-01-01 00:00:00.000001", "-0044-03-15 12:00:00", "1999-12-31 23:59:59.999999"]
    path = _new(spark)
    for i, c in enumerate(clocks):
        at = spark.range(1).selectExpr(f"'t{i}' tripId", "'R' routeId", f"timestamp_ntz'{c}' currentTime", "1 numOfFutureStops")
        append_rollup(at, path, "w", i)
        assert [r.tripId for r in rollup.first_snapshot(spark, path).select("tripId").collect()] == ["t0" if i == 0 else "t1"]
    append_rollup(spark.createDataFrame([("n", "R", None, 1)], BOARD), path, "w", 3)  # no clock: counted, in no snapshot
    fold_rollup(spark, path, fanout=2)
    assert [r.tripId for r in rollup.first_snapshot(spark, path).select("tripId").collect()] == ["t1"]
    assert rows(rollup.trips_per_route(spark, path)) == [("R", 4)]


def test_a_rollup_stream_holds_what_it_folds_alone(spark):
    held = {}

    def look(r):
        for side in ("updates", "status"):
            held[side] = set(side_state(r.stream_spark, r.path("ckpt"), side).select("value.*").columns)

    def start(r):
        return rollup.write_rollup(registered._board_stream(r), r.path("rollup"), r.path("ckpt"), trigger=registered.AVAILABLE_NOW, fold_every=1, fanout=2)

    r = registered._replay(spark, SF_SMALL, "test-rollup", registered._trip_slices, start, then=look)
    assert "numOfFutureStops" in held["updates"] and not held["updates"] & {"nextArrival", "nextStopId", "lastArrival", "lastStopId"}
    assert not held["status"] & {"currentStopId", "currentStatus", "currentStopSequence"}
    board = registered.trip_board(spark, SF_SMALL)
    assert rows(rollup.trips_per_route(spark, r.path("rollup"))) == rows(registered.adhoc.q4_trips_per_route(board))
    assert rows(rollup.first_snapshot(spark, r.path("rollup"))) == rows(registered.adhoc.q9_first_snapshot(board))
