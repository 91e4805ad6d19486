"""A board laid out for time ranges and for look-ups by trip.

Folders by start month or day (``startPart``), rows inside in order of start
time and trip, and a Parquet bloom filter for trip ids: a question about an
interval lists and opens the folders that it touches, row groups beyond it are
skipped by their statistics, and a look-up skips every row group whose filter
rules the trip out. Rows without a start time share a folder of their own."""

from __future__ import annotations

from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql import types as T

from boardwalk import schemas
from boardwalk.session import path_exists

PART = "startPart"
UNITS = ("day", "month")
CLUSTERED = T.StructType([*schemas.BOARD, T.StructField(PART, T.DateType())])


def start_part(start: Column, unit: str = "day") -> Column:
    if unit not in UNITS:
        raise ValueError(f"unit must be one of {UNITS}")
    return F.trunc(start.cast("date"), "month") if unit == "month" else start.cast("date")


def bloom_options(trips_per_group: int = 1 << 17) -> dict[str, str]:
    """Writer options: a bloom filter for trip ids in each row group, sized for
    so many distinct trips."""
    return {"parquet.bloom.filter.enabled#tripId": "true", "parquet.bloom.filter.expected.ndv#tripId": str(trips_per_group)}


def write_clustered(board: DataFrame, path: str, unit: str = "day", mode: str = "errorifexists", trips_per_group: int = 1 << 17) -> None:
    """The board (or one that has grown file by file, read back) written in
    the layout. Ranges of (part, start time, trip) are dealt out by sampled
    size, so a busy day is spread over several files and a quiet one is not."""
    rows = board.select(*schemas.BOARD_COLUMNS, start_part(F.col("startTime"), unit).alias(PART))
    order = [PART, "startTime", "tripId"]
    ranged = rows.repartitionByRange(*order).sortWithinPartitions(*order)
    ranged.write.mode(mode).partitionBy(PART).options(**bloom_options(trips_per_group)).parquet(path)


def read_clustered(spark: SparkSession, path: str, missing_ok: bool = False) -> DataFrame:
    """The board with its ``startPart``; the schema is declared."""
    if missing_ok and not path_exists(spark, path):
        return spark.createDataFrame([], CLUSTERED)
    return spark.read.schema(CLUSTERED).parquet(path)


def started_between(board: DataFrame, lo: str, hi: str, unit: str = "day") -> DataFrame:
    """Rows that started in ``[lo, hi]``, from the folders of that interval."""
    lo_ts, hi_ts = F.lit(lo).cast("timestamp_ntz"), F.lit(hi).cast("timestamp_ntz")
    parts = F.col(PART).between(start_part(lo_ts, unit), start_part(hi_ts, unit))
    return board.where(parts & F.col("startTime").between(lo_ts, hi_ts))


def of_trips(board: DataFrame, trip_ids: list[str]) -> DataFrame:
    """Rows of the trips named; the ids reach the scan as a filter."""
    return board.where(F.col("tripId").isin(*trip_ids))
