"""The latest row per key, on plain Parquet: deltas and a view.

Each micro-batch is reduced to its latest row per key and overwrites one
folder of its own:

    path/deltas/writer=<query>/batch=<n>/part-*.parquet

The table is what ``latest_per_key`` gives over all folders. A row that is
there twice changes nothing, so a replayed batch simply writes its folder
again, and a merge may add a folder with the merged rows of others long before
those go. Merged folders list the files they cover (``folders.py``); there is
no manifest of the table, no bucket count and no version. Readers are
DataFrame or SQL queries.

``merge_tiers`` keeps the number of folders small at a bounded cost: whenever
``fanout`` folders of a level are there, they become one of the next level, so
a row is rewritten once per level, a logarithmic number of times. ``compact``
merges everything at once.
"""

from __future__ import annotations

from pyspark import StorageLevel
from pyspark.sql import DataFrame, SparkSession

from boardwalk import schemas
from boardwalk.operators.latest import latest_per_key
from boardwalk.session import delete_path, modified_ms, path_exists, write_text
from boardwalk.sources.folders import COMPACTED, Folder, covered, declare, drop_covered_files, finished, merged_name

DELTAS = "deltas"


def _base(path: str) -> str:
    return f"{path.rstrip('/')}/{DELTAS}"


def _folder(path: str, writer: str, batch_id: int) -> str:
    return f"{_base(path)}/writer={writer}/batch={batch_id}"


def is_upsert_path(spark: SparkSession, path: str) -> bool:
    return path_exists(spark, f"{path.rstrip('/')}/{DELTAS}")


def append_latest(batch: DataFrame, path: str, writer: str, batch_id: int, key: str, order: list[str]) -> None:
    """The batch's latest row per key as its own folder, whole or not at all;
    repeating it replaces it. A batch without rows writes nothing."""
    reduced = latest_per_key(batch, key, order).persist(StorageLevel.MEMORY_AND_DISK)
    try:
        if not reduced.isEmpty():
            reduced.write.mode("overwrite").parquet(_folder(path, writer, batch_id))
    finally:
        reduced.unpersist()


def read_deltas(spark: SparkSession, path: str, schema=None) -> DataFrame:
    """All delta rows as written, without the folder names."""
    schema = schema or schemas.BOARD_WITH_ORDER
    return spark.read.schema(schema).parquet(f"{path.rstrip('/')}/{DELTAS}").select(*schema.names)


def read_latest(spark: SparkSession, path: str, key: str = "tripId", order: list[str] | None = None, schema=None) -> DataFrame:
    """One row per key; before the first batch, none."""
    schema = schema or schemas.BOARD_WITH_ORDER
    if not is_upsert_path(spark, path):
        return spark.createDataFrame([], schema)
    return latest_per_key(read_deltas(spark, path, schema), key, order or schemas.LATEST_ORDER)


def latest_sql(path: str, key: str = "tripId", order: list[str] | None = None, columns: list[str] | None = None) -> str:
    """``read_latest`` as a query over the files, for a catalog view: it lists
    the folders anew each time it is asked."""
    columns = columns or schemas.BOARD_COLUMNS
    rest = ", ".join(c for c in columns if c != key)
    by = ", ".join(order or schemas.LATEST_ORDER)
    files = f"parquet.`{path.rstrip('/')}/{DELTAS}`"
    best = f"SELECT {key}, max_by(struct({rest}), struct({by})) AS r FROM {files} GROUP BY {key}"
    return f"SELECT {', '.join(c if c == key else f'r.{c}' for c in columns)} FROM ({best})"


def _merge(spark: SparkSession, path: str, inputs: list[Folder], level: int, key: str, order: list[str] | None, schema) -> None:
    """One folder with the latest rows of ``inputs``, read file by file as they
    were listed."""
    base, schema = _base(path), schema or schemas.BOARD_WITH_ORDER
    rows = spark.read.schema(schema).parquet(*[f"{base}/{p}" for f in inputs for p in sorted(f.paths())])
    name = merged_name(level, inputs)
    latest_per_key(rows, key, order or schemas.LATEST_ORDER).write.mode("overwrite").parquet(f"{base}/{name}")
    declare(spark, base, name, finished(spark, base), set().union(*(f.paths() for f in inputs)))


def _live(folders: list[Folder]) -> list[Folder]:
    """Folders with a file that no merge covers."""
    gone = covered(folders)
    return [f for f in folders if f.paths() - gone]


def merge_tiers(
    spark: SparkSession, path: str, key: str = "tripId", order: list[str] | None = None, schema=None, fanout: int = 8, retain: int = 1
) -> int:
    """Merges the folders of every level that has ``fanout`` of them into one
    of the next; returns how many merges that took. What the last ``retain``
    merges cover stays for queries that may still read it, the rest goes.

    For one caller at a time (the sink, between its batches). Dying anywhere
    leaves the same latest rows."""
    if fanout < 2:
        raise ValueError("fanout must be 2 or more")
    base, merges, level = _base(path), 0, 0
    while True:
        folders = finished(spark, base)
        live = _live(folders)
        if level > max((f.level for f in live), default=-1):
            break
        group = [f for f in live if f.level == level]
        if len(group) >= fanout:
            _merge(spark, path, group, level + 1, key, order, schema)
            merges += 1
        level += 1
    newest = max((f.number for f in folders), default=-1)
    old = covered([f for f in folders if 0 <= f.number <= newest - retain])
    drop_covered_files(spark, base, folders, old)
    return merges


def compact(spark: SparkSession, path: str, key: str = "tripId", order: list[str] | None = None, schema=None, keep_s: float = 3600.0) -> None:
    """Merge all folders into one, then remove the files that a merge older
    than ``keep_s`` covers: queries that began before it have ended by then.
    Both times are the store's. Running it twice, or dying in between, leaves
    the same latest rows."""
    base = _base(path)
    if not path_exists(spark, base):
        return
    live = _live(finished(spark, base))
    if len(live) > 1:
        _merge(spark, path, live, 1 + max(f.level for f in live), key, order, schema)
    folders = finished(spark, base)
    now = f"{path.rstrip('/')}/_now"
    write_text(spark, now, "")
    limit = modified_ms(spark, now) - keep_s * 1000
    delete_path(spark, now)
    ready = [f for f in folders if f.covers and (modified_ms(spark, f"{base}/{f.name}/_SUCCESS") or limit + 1) <= limit]
    drop_covered_files(spark, base, folders, covered(ready))
