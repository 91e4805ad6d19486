"""What the operators share: reading tables, folds, and cutting lineage."""

from __future__ import annotations

import os
import tempfile
import zipfile
from collections.abc import Callable, Iterator

import pyarrow as pa
from pyspark.sql import Column, DataFrame, SparkSession
from pyspark.sql import functions as F
from pyspark.sql.types import StructType

from boardwalk.session import shared_dir

#: White space of the contracts: space and U+0009 to U+000D.
BLANKS = "\t\n\x0b\x0c\r "

_UPPER = "ABCDEFGHIJKLMNOPQRSTUVWXYZ"


def table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir}/{name}.parquet")


def ship(spark: SparkSession) -> None:
    """Gives executors this package, once per application, however the driver
    came to import it."""
    sc = spark.sparkContext
    if getattr(sc, "_boardwalk_shipped", False):
        return
    top = os.path.dirname(os.path.dirname(os.path.abspath(__file__)))
    path = os.path.join(tempfile.mkdtemp(prefix="boardwalk-"), "boardwalk.zip")
    with zipfile.ZipFile(path, "w") as z:
        for folder, _, names in os.walk(top):
            for n in sorted(x for x in names if x.endswith(".py")):
                full = os.path.join(folder, n)
                z.write(full, os.path.relpath(full, os.path.dirname(top)))
    sc.addPyFile(path)
    sc._boardwalk_shipped = True


def sliced(batches: Iterator[pa.RecordBatch], rows: int = 512) -> Iterator[pa.RecordBatch]:
    """The batches in smaller parts, so that what is made of one stays small."""
    for b in batches:
        for i in range(0, b.num_rows, rows):
            yield b.slice(i, rows)


def split_words(data: bytes, size: int = 1 << 20) -> Iterator[list[bytes]]:
    """Words of ``data``, which blanks separate, from bounded parts of it."""
    at = 0
    while len(data) - at > size:
        end = data.find(b" ", at + size)
        if end < 0:
            break
        yield data[at:end].split()
        at = end
    yield data[at:].split() if at else data.split()


def arrow_rows(df: DataFrame, run: Callable, schema: str | StructType) -> DataFrame:
    """``mapInArrow`` with the package on the executors."""
    ship(df.sparkSession)
    return df.mapInArrow(run, schema)


def settled(df: DataFrame) -> DataFrame:
    """``df`` computed once into the shared checkpoint folder, so that later
    readers neither recompute it nor depend on the executors that made it."""
    sc = df.sparkSession.sparkContext
    folder = shared_dir(df.sparkSession)
    if sc.getCheckpointDir() is None:  # the setting was made after the start
        sc.setCheckpointDir(folder)
    return df.checkpoint()


def lower_ascii(text: Column) -> Column:
    """A-Z in lower case, every other code point as it is. ``lower`` is the
    fast way and agrees wherever the text is ASCII."""
    plain = F.octet_length(text) == F.char_length(text)
    return F.when(plain, F.lower(text)).otherwise(F.translate(text, _UPPER, _UPPER.lower()))


def fold(doc_id: Column, parts: int) -> Column:
    """crc32 of the id's decimal text modulo ``parts``; a null id counts as ''."""
    return F.crc32(F.encode(F.coalesce(doc_id.cast("string"), F.lit("")), "utf-8")) % parts


def row_key(doc_id: Column, text: Column) -> Column:
    """Names a row by its id and 96 bits of its text; only rows equal in both
    share it, and every operator treats those alike."""
    return F.concat_ws(" ", F.coalesce(doc_id.cast("string"), F.lit("-")), F.xxhash64(text).cast("string"), F.hash(text).cast("string"))


def smallest(rows: DataFrame, n: int, *by) -> list:
    """The first ``n`` rows in the order of ``by``, merged in one task rather
    than on the driver; ``n`` is a documented bound."""
    return rows.orderBy(*by).limit(n).repartition(1).sortWithinPartitions(*by).collect()
