"""The board at rest: read it and register it with the catalog."""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession

from boardwalk import schemas
from boardwalk.session import path_exists
from boardwalk.sources.upsert import is_upsert_path, latest_sql, read_latest


def read_board(spark: SparkSession, path: str, fmt: str = "parquet", missing_ok: bool = False) -> DataFrame:
    """Scan a board written by the append sink (a Parquet folder) or any
    format Spark reads by path. The schema is declared, so no listing pass
    is spent on inference; filters and projections reach the scan. With
    ``missing_ok`` a folder that was never written (no batch ran) reads as an
    empty board instead of an error. The path of an upsert table reads as its
    latest rows."""
    if is_upsert_path(spark, path):
        return read_latest(spark, path).select(*schemas.BOARD_COLUMNS)
    if missing_ok and not path_exists(spark, path):
        return spark.createDataFrame([], schemas.BOARD)
    return spark.read.format(fmt).schema(schemas.BOARD).load(path)


def register_board(spark: SparkSession, df: DataFrame, name: str) -> DataFrame:
    """Make the board queryable by SQL under ``name`` (temp view)."""
    df.createOrReplaceTempView(name)
    return spark.table(name)


def _quote(name: str) -> str:
    return ".".join(f"`{part.replace('`', '``')}`" for part in name.split("."))


def register_board_path(spark: SparkSession, path: str, name: str, columns: list[str] | None = None) -> None:
    """A persistent catalog view over the files of a board at ``path`` (append
    folder or upsert table), like an external schema: any session of the
    catalog can ask it, and every query lists the files anew, so rows that a
    stream has committed since are seen.

    ``name`` (unquoted parts) may be ``database.view``; the database is
    created when absent. A view or an external table of that name is replaced
    (no files are touched); a managed table, whose data a drop would delete,
    is refused. ``columns``: of an append folder, if more than the board's."""
    quoted = _quote(name)
    if "." in name:
        spark.sql(f"CREATE DATABASE IF NOT EXISTS {_quote(name.rsplit('.', 1)[0])}")
    if spark.catalog.tableExists(quoted):
        kind = spark.catalog.getTable(quoted).tableType
        if kind not in ("EXTERNAL", "VIEW"):
            raise ValueError(f"{name} exists as a {kind.lower()} object: not replaced")
        if kind == "EXTERNAL":
            spark.sql(f"DROP TABLE {quoted}")
    files = path.rstrip("/").replace("`", "``")
    query = latest_sql(files) if is_upsert_path(spark, path) else f"SELECT {', '.join(columns or schemas.BOARD_COLUMNS)} FROM parquet.`{files}`"
    spark.sql(f"CREATE OR REPLACE VIEW {quoted} AS {query}")
