"""Hashed sparse features of texts, and their extraction as Spark rows."""

from __future__ import annotations

import zlib
from collections.abc import Callable, Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardwalk.llm.common import arrow_rows

#: Hash buckets, as powers of two: of single words, and of n-grams.
WORD_BITS, GRAM_BITS = 22, 18

_ASCII_MARKS = bytes(range(0x21, 0x30)) + bytes(range(0x3A, 0x41)) + bytes(range(0x5B, 0x61)) + bytes(range(0x7B, 0x7F))
_SPACED = bytes.maketrans(_ASCII_MARKS, b" " * len(_ASCII_MARKS))
_MIX = np.uint64(0x9E3779B97F4A7C15)


def _hashes(words: list[bytes]) -> np.ndarray:
    return np.fromiter(map(zlib.crc32, words), np.uint64, len(words))


def _bucket(h: np.ndarray, bits: int) -> np.ndarray:
    return ((h * _MIX) >> np.uint64(64 - bits)).astype(np.int32)


def word_set(text: bytes) -> tuple[np.ndarray, None]:
    """Buckets of the distinct words (lower case, without ASCII punctuation);
    no values: each counts 1."""
    return np.unique(_bucket(_hashes(text.lower().translate(_SPACED).split()), WORD_BITS)), None


def word_ngrams(text: bytes) -> tuple[np.ndarray, np.ndarray]:
    """Buckets of one- and two-word grams with L2-normalised counts. Grams are
    taken of the words as written and of their shapes (capitals only or not,
    last character if it is a mark); a repeated word is a gram of its own."""
    words = text.split()
    if not words:
        return np.empty(0, np.int32), np.empty(0, np.float32)
    h = _hashes(words)
    shape = np.fromiter((w.isupper() * 256 + (w[-1] if w[-1] in _ASCII_MARKS else 0) for w in words), np.uint64, len(words))
    pair = h[:-1] * np.uint64(31) + h[1:] + np.uint64(1 << 40)
    pair[h[:-1] == h[1:]] = np.uint64(1 << 41)
    shapes = shape + np.uint64(1 << 42)
    shape_pairs = shape[:-1] * np.uint64(1 << 10) + shape[1:] + np.uint64(1 << 43)
    ids, n = np.unique(_bucket(np.concatenate((h, pair, shapes, shape_pairs)), GRAM_BITS), return_counts=True)
    return ids, (n / np.sqrt((n * n).sum())).astype(np.float32)


Features = Callable[[bytes], tuple[np.ndarray, np.ndarray | None]]
Row = tuple[np.ndarray, np.ndarray | None, int]


def one_text(docs: DataFrame) -> DataFrame:
    """``doc_id, text``, a row per id: of the texts of an id that with the
    smallest hash, then the smallest, whatever order the rows come in."""
    return docs.groupBy("doc_id").agg(F.min(F.struct(F.xxhash64("text").alias("h"), "text")).alias("one")).select("doc_id", "one.text")


def collected(docs: DataFrame, make: Features, label: str) -> list[Row]:
    """``ids, values, label`` of each row of ``docs (<label>, text)``, which
    must be a bounded sample; the arrays travel as plain bytes."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            found = [make(t or b"") for t in b.column(1).cast(pa.large_binary()).to_pylist()]
            ids = pa.array([i.astype(np.int32).tobytes() for i, _ in found], pa.binary())
            vals = pa.array([None if v is None else v.astype(np.float32).tobytes() for _, v in found], pa.binary())
            yield pa.RecordBatch.from_arrays([b.column(0), ids, vals], ["label", "ids", "vals"])

    rows = arrow_rows(docs.select(F.col(label).cast("int").alias("label"), "text"), run, "label int, ids binary, vals binary")
    return [(np.frombuffer(r["ids"], np.int32), None if r["vals"] is None else np.frombuffer(r["vals"], np.float32), r["label"]) for r in rows.toLocalIterator()]


def scored(docs: DataFrame, make: Features, weights: np.ndarray, bias: float) -> DataFrame:
    """``doc_id, score, predicted`` per row: the logistic of the sparse dot
    product of the whole text's features."""
    w = docs.sparkSession.sparkContext.broadcast(weights.astype(np.float32))

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            z = np.empty(b.num_rows)
            for i, t in enumerate(b.column(1).cast(pa.large_binary())):
                ids, vals = make(t.as_py() or b"")
                mine = w.value[ids].astype(np.float64)
                z[i] = bias + (mine.sum() if vals is None else mine @ vals)
            score = 1 / (1 + np.exp(-np.clip(z, -500, 500)))
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(score), pa.array((score >= 0.5).astype(np.int32))], ["doc_id", "score", "predicted"])

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text")
    return arrow_rows(rows, run, "doc_id long, score double, predicted int")
