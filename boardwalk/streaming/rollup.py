"""Aggregates of the board kept up to date batch by batch.

Each micro-batch leaves one folder of partial results (``folders.py``): trips
per route, and future stops per trip for its earliest clock. Partials merge
(counts add up; of the earliest clocks the smallest wins and its sums add up),
so a question folds the folders instead of reading the board. A batch that is
replayed overwrites its folder; batches may come in any order.

``fold_rollup`` merges folders in tiers and lists what it covers; a covered
folder no longer counts. Only batches that a later one of the same writer has
followed are folded: those are committed and won't be replayed."""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.streaming import StreamingQuery

from boardwalk.session import delete_path
from boardwalk.sources.folders import COMPACTED, Folder, covered, declare, finished, merged_name
from boardwalk.streaming.sinks import with_trigger, writer_id

#: The board's columns that the partial results are made of.
FOLDED = ("tripId", "routeId", "currentTime", "numOfFutureStops")
ROUTE, FIRST = "route", "first"
ROLLUP = "kind string, routeId string, tripId string, currentTime timestamp_ntz, n long"


def _earliest(rows: DataFrame) -> DataFrame:
    """The rows of the smallest clock, which is asked in a job of its own. As a
    broadcast it would have to be there in ``spark.sql.broadcastTimeout``
    together with all that the rows come from, in a stream the whole batch."""
    clock = F.col("currentTime")
    # As text, so that no clock is out of Python's range.
    first = rows.agg(F.min(clock).cast("string")).first()[0]
    return rows.where(clock == F.lit(first).cast(rows.schema["currentTime"].dataType))


def partials(board: DataFrame) -> DataFrame:
    """The partial results (``ROLLUP``) of some board rows, which are read
    twice."""
    no = lambda c, t: F.lit(None).cast(t).alias(c)
    routes = board.groupBy("routeId").agg(F.count("tripId").alias("n"))
    first = _earliest(board).groupBy("tripId", "routeId", "currentTime").agg(F.sum("numOfFutureStops").alias("n"))
    kind = lambda k: F.lit(k).alias("kind")
    routes = routes.select(kind(ROUTE), "routeId", no("tripId", "string"), no("currentTime", "timestamp_ntz"), "n")
    return routes.unionByName(first.select(kind(FIRST), "routeId", "tripId", "currentTime", "n"))


def _folded(rows: DataFrame) -> DataFrame:
    """Partials of several folders as one."""
    routes = rows.where(F.col("kind") == ROUTE).groupBy("kind", "routeId", "tripId", "currentTime").agg(F.sum("n").alias("n"))
    first = _earliest(rows.where(F.col("kind") == FIRST))
    return routes.unionByName(first.groupBy("kind", "routeId", "tripId", "currentTime").agg(F.sum("n").alias("n")))


def append_rollup(batch: DataFrame, path: str, writer: str, batch_id: int) -> None:
    """The batch's partials as its folder; repeating it replaces it. A batch
    that a fold covers already is committed: it is left as it is."""
    name = f"writer={writer}/batch={batch_id}"
    if name in covered(finished(batch.sparkSession, path)):
        return
    kept = batch.select(*FOLDED).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        partials(kept).write.mode("overwrite").parquet(f"{path}/{name}")
    finally:
        kept.unpersist()


def _live(folders: list[Folder]) -> list[Folder]:
    """The folders that count: not covered and, of merges, only those that got
    as far as saying what they cover."""
    gone = covered(folders)
    whole = [f for f in folders if f.number >= 0 or not f.name.startswith(f"writer={COMPACTED}/")]
    return [f for f in whole if f.name not in gone]


def fold_rollup(spark: SparkSession, path: str, fanout: int = 8, retain: int = 1) -> int:
    """Merges ``fanout`` folders or more of a level into one of the next, and
    removes the folders that merges before the last ``retain`` cover. Returns
    the number of merges. For one caller at a time."""
    if fanout < 2:
        raise ValueError("fanout must be 2 or more")
    merges, level = 0, 0
    while True:
        folders = finished(spark, path)
        live = _live(folders)
        if level > max((f.level for f in live), default=-1):
            break
        last: dict[str, Folder] = {}
        for f in live:
            writer, batch = f.name.split("/batch=")
            if writer != f"writer={COMPACTED}" and (writer not in last or int(batch) > int(last[writer].name.split("/batch=")[1])):
                last[writer] = f
        group = [f for f in live if f.level == level and f not in last.values()]
        if len(group) >= fanout:
            name = merged_name(level + 1, group)
            rows = spark.read.schema(ROLLUP).parquet(*[f"{path}/{f.name}" for f in group])
            _folded(rows).write.mode("overwrite").parquet(f"{path}/{name}")
            # What the inputs covered stays covered, should it still be there.
            declare(spark, path, name, folders, {f.name for f in group}.union(*(f.covers for f in group)))
            merges += 1
        level += 1
    newest = max((f.number for f in folders), default=-1)
    old = covered([f for f in folders if 0 <= f.number <= newest - retain])
    for f in sorted((f for f in folders if f.name in old), key=lambda f: f.number):
        delete_path(spark, f"{path}/{f.name}")
    return merges


def read_rollup(spark: SparkSession, path: str) -> DataFrame:
    """The partials that count. Read lazily: a query that outlives ``retain``
    folds should be asked anew."""
    live = _live(finished(spark, path))
    if not live:
        return spark.createDataFrame([], ROLLUP)
    return spark.read.schema(ROLLUP).parquet(*[f"{path}/{f.name}" for f in live])


def trips_per_route(spark: SparkSession, path: str) -> DataFrame:
    """As ``adhoc.q4_trips_per_route`` of the board so far."""
    rows = read_rollup(spark, path).where(F.col("kind") == ROUTE)
    return rows.groupBy("routeId").agg(F.sum("n").alias("numOfTrips")).orderBy(F.col("routeId").asc_nulls_last())


def trip_count(spark: SparkSession, path: str) -> DataFrame:
    """As ``adhoc.q2_count`` of the board so far."""
    rows = read_rollup(spark, path).where(F.col("kind") == ROUTE)
    return rows.agg(F.coalesce(F.sum("n"), F.lit(0)).alias("numOfTrips"))


def first_snapshot(spark: SparkSession, path: str) -> DataFrame:
    """As ``adhoc.q9_first_snapshot`` of the board so far."""
    rows = _earliest(read_rollup(spark, path).where(F.col("kind") == FIRST))
    out = rows.groupBy("tripId", "routeId", "currentTime").agg(F.sum("n").alias("numOfFutureStops"))
    return out.orderBy(F.col("numOfFutureStops").desc())


def write_rollup(
    board: DataFrame, path: str, checkpoint: str, trigger: str | None = None, query_name: str | None = None,
    fold_every: int | None = 16, fanout: int = 8, retain: int = 1,
) -> StreamingQuery:
    """Keeps the partials of a board stream at ``path``. A batch costs what it
    holds; every ``fold_every`` batches folders are merged (None: never). The
    stream is asked for the columns folded alone, so that the join below holds
    no others in its state: nothing is pruned above a batch. A checkpoint from
    before that holds the whole board's columns and cannot be gone on with."""
    spark, known = board.sparkSession, {}

    def add(batch: DataFrame, batch_id: int) -> None:
        if "id" not in known:
            known["id"] = writer_id(spark, checkpoint)
        append_rollup(batch, path, known["id"], batch_id)
        if fold_every and (batch_id + 1) % fold_every == 0:
            fold_rollup(spark, path, fanout, retain)

    w = board.select(*FOLDED).writeStream.foreachBatch(add).option("checkpointLocation", checkpoint)
    if query_name:
        w = w.queryName(query_name)
    return with_trigger(w, trigger).start()
