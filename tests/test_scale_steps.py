"""Steps that the board's queries share: what they move and read at size."""

from __future__ import annotations

import datetime as dt

from pyspark.sql import functions as F

from boardwalk.functions import compact_json, epoch_seconds
from boardwalk.sources.fixtures import trip_stops
from boardwalk.streaming import FeedReplay

def _plan(df) -> str:
    return df._jdf.queryExecution().optimizedPlan().toString()


def test_text_is_compacted_without_a_look_up_per_character(spark):
    texts = ["", None, " ", "\n", "a b\n c", "\t a\r\n", "é \u00a0 \u2028 x", '{"a": "4-NOT SPECIFIED"}\n', "\r \t", "no"]
    df = spark.createDataFrame([(t,) for t in texts], "t string").coalesce(1)
    out = df.select(compact_json("t").alias("c"), F.btrim(F.translate("t", "\n ", ""), F.lit("\t\r")).alias("was"))
    assert all(r.c == r.was for r in out.collect())
    assert "translate" not in _plan(spark.range(1).select(compact_json(F.col("id").cast("string"))))


def test_stops_carry_their_arrival(spark):
    at = [dt.datetime(1996, 3, 31, 10, 2), dt.datetime(1969, 12, 31, 23, 59, 59), None]
    rows = [(1, 2, at[0], 7), (1, 1, at[1], 9), (1, 1, at[0], 8), (1, 1, at[0], 8), (2, None, at[2], None), (None, 1, at[0], 3)]
    lines = spark.createDataFrame(rows, "l_orderkey long, l_linenumber int, l_shipdate timestamp_ntz, l_partkey long")
    got = {r.l_orderkey: [(x.l_linenumber, x.l_partkey, x.arrival) for x in r.lines] for r in trip_stops(lines).collect()}
    s = spark.range(1).select(*[epoch_seconds(F.lit(str(a)).cast("timestamp_ntz")) for a in at[:2]]).first()
    assert got == {1: [(1, 9, s[1]), (1, 8, s[0]), (1, 8, s[0]), (2, 7, s[0])], 2: [(None, None, None)], None: [(1, 3, s[0])]}


def test_replays_keep_no_row_count(spark):
    r = FeedReplay(spark, "conf")
    key = "spark.sql.streaming.stateStore.rocksdb.trackTotalNumberOfRows"
    assert r.stream_spark.conf.get(key) == "false" and spark.conf.get(key, "unset") != "false"
