"""Feed messages derived from the driver's tables.

This is the producer side as a Spark job: one order is one trip, its line
items are the trip's remaining stops. The rules below are fixed so that an
independent SQL over the base tables can compute the same board.

* tripId = o_orderkey as text; routeId = o_orderpriority; startDate = the
  order date as yyyyMMdd; startTime = HH:MM:00 with HH = o_orderkey % 22 + 3
  (24 is written as 25, which no parser accepts) and MM = o_orderkey % 60.
* stops: the order's lines sorted by (l_linenumber, l_shipdate, l_partkey);
  arrival = epoch seconds of l_shipdate, absent on the first stop when
  o_orderkey % 7 = 0; departure = arrival + 60; stopId = l_partkey.
* a second update one minute later for o_orderkey % 11 = 0, and no status
  for o_orderkey % 13 = 0 (an update without a status, dropped by the join).
* status: currentStopSequence = o_orderkey % 20; F -> STOPPED_AT,
  O -> IN_TRANSIT_TO, P -> absent; stopId = o_custkey; timestamp = epoch of
  o_orderdate. Ingest time of every message = o_orderdate (+ 1 min for the
  second update), so results repeat.

Every order and every line goes through; nothing is sampled. The per-trip
stop list is an aggregate of one order's lines (at most a trip's stops; the
feed format puts them in one message by definition).
"""

from __future__ import annotations

from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from boardwalk.functions import compact_json, epoch_seconds, utc_to_instant

UPDATES_TOPIC = "trip_updates"
STATUS_TOPIC = "trip_status"

# Status code of an order -> vehicle status in the feed.
ORDER_STATUS_TO_FEED = {"F": "STOPPED_AT", "O": "IN_TRANSIT_TO"}


def _trip(k: Column) -> Column:
    hour = k % 22 + 3
    hour = F.when(hour == 24, F.lit(25)).otherwise(hour)
    return F.struct(
        k.cast("string").alias("tripId"),
        F.format_string("%02d:%02d:00", hour, k % 60).alias("startTime"),
        F.date_format(F.to_date("o_orderdate"), "yyyyMMdd").alias("startDate"),
        F.col("o_orderpriority").alias("routeId"),
    )


_ORDER_COLS = ["o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority"]


def keyed_orders(orders: DataFrame) -> DataFrame:
    """Orders spread by order key, as a topic keyed by trip spreads messages
    over its partitions. This is the exchange the join with the stop lists
    needs anyway (same key); AQE sizes its partition count at run time."""
    return orders.select(*_ORDER_COLS).repartition(F.col("o_orderkey"))


def trip_stops(lineitem: DataFrame) -> DataFrame:
    """One row per order with its stops in trip order (map-side partial
    collect, one shuffle by order key). The arrival comes after all that the
    order goes by; taken per line, it is compiled code, unlike in a transform."""
    line = F.struct("l_linenumber", "l_shipdate", "l_partkey", epoch_seconds("l_shipdate").alias("arrival"))
    lines = F.sort_array(F.collect_list(line))
    return lineitem.groupBy("l_orderkey").agg(lines.alias("lines"))


def _stop_list(k: Column) -> Column:
    def stop(x: Column, i: Column) -> Column:
        arrival = x["arrival"]
        arrival_struct = F.struct(arrival.cast("string").alias("time"))
        return F.struct(
            F.when((i == 0) & (k % 7 == 0), F.lit(None)).otherwise(arrival_struct).alias("arrival"),
            x["l_partkey"].cast("string").alias("stopId"),
            F.struct((arrival + 60).cast("string").alias("time")).alias("departure"),
        )

    return F.transform("lines", stop)


def _status(k: Column) -> Column:
    code = F.col("o_orderstatus")
    feed_status = F.when(code == "F", F.lit(ORDER_STATUS_TO_FEED["F"])).when(
        code == "O", F.lit(ORDER_STATUS_TO_FEED["O"])
    )
    return F.struct(
        _trip(k).alias("trip"),
        (k % 20).cast("int").alias("currentStopSequence"),
        feed_status.alias("currentStatus"),
        epoch_seconds("o_orderdate").cast("string").alias("timestamp"),
        F.col("o_custkey").cast("string").alias("stopId"),
    )


def _polls(k: Column) -> Column:
    """Polls that carry an update of the trip: every 11th order is updated
    twice (one minute apart), so a trip has several board rows."""
    return F.when(k % 11 == 0, F.array(F.lit(0), F.lit(1))).otherwise(F.array(F.lit(0)))


def _sends_status(k: Column) -> Column:
    """Every 13th order sends no status: an update the inner join drops."""
    return k % 13 != 0


def trip_entities(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Per order and poll: the trip update and, on the first poll, the
    status. Columns ``o_orderkey, poll, ingest_ts, tripUpdate, vehicle``."""
    o = keyed_orders(orders)
    stops = trip_stops(lineitem)
    k = F.col("o_orderkey")
    joined = o.join(stops, o["o_orderkey"] == stops["l_orderkey"], "left")
    update = F.struct(_trip(k).alias("trip"), _stop_list(k).alias("stopTimeUpdate"))
    has_status = (F.col("poll") == 0) & _sends_status(k)
    # The generator gets its own select: struct field names written next to
    # a generator in one select are lost by the analyzer.
    exploded = joined.select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority", "lines",
        F.explode(_polls(k)).alias("poll"),
    )
    return exploded.select(
        "o_orderkey",
        "poll",
        utc_to_instant(F.timestamp_add("MINUTE", F.col("poll"), F.col("o_orderdate"))).alias("ingest_ts"),
        update.alias("tripUpdate"),
        F.when(has_status, _status(k)).alias("vehicle"),
        "o_orderpriority",
    )


def _envelope(topic_name: str, body: Column) -> list[Column]:
    return [
        F.lit(topic_name).alias("topic"),
        F.col("o_orderkey").cast("string").alias("key"),
        compact_json(F.to_json(body)).alias("value"),
        "ingest_ts",
    ]


def update_messages(orders: DataFrame, lineitem: DataFrame) -> DataFrame:
    """Trip-update messages ``topic, key, value, ingest_ts``, compacted as the
    producer sends them, keyed by the real trip id (a broker then spreads
    trips over partitions)."""
    e = trip_entities(orders, lineitem)
    return e.select(*_envelope(UPDATES_TOPIC, F.col("tripUpdate")))


def status_messages(orders: DataFrame, spread: bool = False) -> DataFrame:
    """Trip-status messages; built from orders alone (no stop list needed).
    ``spread`` deals the orders out by key first: for a table whose files are
    too few to keep the cores busy."""
    k = F.col("o_orderkey")
    o = keyed_orders(orders) if spread else orders.select(*_ORDER_COLS)
    o = o.where(_sends_status(k)).select(
        "o_orderkey", "o_custkey", "o_orderstatus", "o_orderdate", "o_orderpriority",
        utc_to_instant("o_orderdate").alias("ingest_ts"),
    )
    return o.select(*_envelope(STATUS_TOPIC, _status(k)))


def trip_key_messages(orders: DataFrame, spread: bool = False) -> DataFrame:
    """Both topics with messages that hold their trip alone: same trips, keys
    and ingest times as ``trip_messages``, made without the stop lists."""
    k = F.col("o_orderkey")
    o = keyed_orders(orders) if spread else orders.select(*_ORDER_COLS)
    polled = o.select(*_ORDER_COLS, F.explode(_polls(k)).alias("poll"))
    u = polled.select(
        "o_orderkey",
        utc_to_instant(F.timestamp_add("MINUTE", F.col("poll"), F.col("o_orderdate"))).alias("ingest_ts"),
        F.struct(_trip(k).alias("trip")).alias("tripUpdate"),
    )
    return u.select(*_envelope(UPDATES_TOPIC, F.col("tripUpdate"))).unionByName(status_messages(orders, spread))


def trip_messages(orders: DataFrame, lineitem: DataFrame, spread: bool = False) -> DataFrame:
    """Both topics in one frame, routed by ``topic``. Selecting one topic
    prunes the other branch of the union at planning time."""
    return update_messages(orders, lineitem).unionByName(status_messages(orders, spread))


# Four route-group feeds, as the transit operator publishes.
FEEDS = 4


def feed_id(route: Column) -> Column:
    """Route group of any route, a null one too: its hash folded onto FEEDS."""
    return F.pmod(F.xxhash64(route), F.lit(FEEDS)).cast("int")


def feed_snapshots(orders: DataFrame, lineitem: DataFrame, entities_per_doc: int = 256) -> DataFrame:
    """Polled feed documents ``feed, ingest_ts, value``: the entities of one
    route-group feed at one poll, in documents of at most
    ``entities_per_doc`` entities (a bounded group: a busy poll becomes more
    documents, never one huge one). Text is not compacted here."""
    e = trip_entities(orders, lineitem)
    entity = F.struct(
        F.col("o_orderkey").cast("string").alias("id"),
        F.col("tripUpdate"),
        F.col("vehicle"),
    )
    doc = F.floor(F.col("o_orderkey") / F.lit(entities_per_doc))
    grouped = e.groupBy(feed_id(F.col("o_orderpriority")).alias("feed"), "ingest_ts", doc.alias("doc")).agg(
        F.collect_list(entity).alias("entity")
    )
    return grouped.select("feed", "ingest_ts", F.to_json(F.struct("entity")).alias("value"))
