"""SimHash near-duplicates found through a positional byte index.

``fingerprints`` computes 64-bit SimHashes; ``near_duplicates`` links
fingerprints at most ``max_bits`` apart and returns each row's component.

Two fingerprints that differ in at most b bits share at least 8 - b of their 8
bytes, position by position. The index posts every distinct fingerprint under
triples of (position, byte). The triples form a covering design: whichever
bytes a pair shares, one posted triple lies among them, so every pair that
reaches the guaranteed minimum meets in some posting list. Where two meet,
their shared positional bytes are tallied, pairs below the minimum dropped and
the rest verified by bit distance.

A posting list is never expanded into its pairs: a task walks it and returns
one edge per fingerprint and group found. A list longer than ``block``
fingerprints is dealt into blocks and every pair of blocks is a unit of its
own, so no list meets whole in one task. Exact copies share a fingerprint and
are one row from the start.
"""

from __future__ import annotations

from collections.abc import Iterator
from itertools import combinations

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardwalk.llm.common import arrow_rows, row_key, settled, sliced
from boardwalk.llm.graph import connected_components

SEED = 42
BYTES = 8


def simhash(text: bytes | None, shingle: int) -> int:
    """The unsigned fingerprint of a text in UTF-8. Words are separated by
    ASCII white space; fewer words than a shingle make one shingle of all of
    them, none make fingerprint zero."""
    import xxhash

    words = (text or b"").lower().split()
    if not words:
        return 0
    line = b" ".join(words)
    ends = np.cumsum(np.fromiter(map(len, words), np.int64, len(words)) + 1) - 1
    starts = np.concatenate(([0], ends[:-1] + 1))
    last = max(len(words) - shingle, 0)
    ends = ends[-1:] if len(words) <= shingle else ends[shingle - 1 :]
    digest = xxhash.xxh64_intdigest
    hashes = [digest(line[a:b], SEED) for a, b in zip(starts[: last + 1].tolist(), ends.tolist(), strict=True)]
    bits = np.unpackbits(np.array(hashes, dtype=">u8").view(np.uint8).reshape(-1, BYTES), axis=1)
    return int.from_bytes(np.packbits(bits.sum(axis=0, dtype=np.int64) * 2 > len(hashes)).tobytes(), "big")


def fingerprints(docs: DataFrame, shingle: int = 4, id_col: str = "doc_id", text_col: str = "text") -> DataFrame:
    """``doc_id, row, fp`` per row of ``docs``: the SimHash of the whole
    lower-cased (A-Z) text as a signed long. A null text is an empty one; a
    null id stays null; other columns are not read."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            texts = b.column(1).cast(pa.large_binary())
            fps = np.fromiter((simhash(t.as_py(), shingle) for t in texts), np.uint64, len(texts))
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(2), pa.array(fps.view(np.int64))], ["doc_id", "row", "fp"])

    rows = docs.select(F.col(id_col).cast("long").alias("doc_id"), F.col(text_col).alias("text"), row_key(F.col(id_col), F.col(text_col)).alias("row"))
    return arrow_rows(rows, run, "doc_id long, row string, fp long")


def positions(max_bits: int) -> list[tuple[int, ...]]:
    """Position sets such that any ``8 - max_bits`` positions contain one of
    them. For up to four bits: the 20 triples of a covering of all 4-sets
    (positions in three parts; triples inside a part, or two of a part with
    one of the next); beyond, all sets of the guaranteed size."""
    if not 0 <= max_bits < BYTES:
        raise ValueError("max_bits must be 0 to 7")
    sure = BYTES - max_bits
    if sure < 4:
        return list(combinations(range(BYTES), sure))
    part = [0, 0, 0, 1, 1, 1, 2, 2]
    out = []
    for t in combinations(range(BYTES), 3):
        n = [sum(part[p] == k for p in t) for k in range(3)]
        if 3 in n or any(n[k] == 2 and n[(k + 1) % 3] == 1 for k in range(3)):
            out.append(t)
    return out


def _verified(a: np.ndarray, x: np.uint64, max_bits: int) -> np.ndarray:
    """Which of ``a`` link to ``x``: tally of shared positional bytes first,
    then the bit distance of those that reach the minimum."""
    diff = a ^ x
    hit = (diff.view(np.uint8).reshape(-1, BYTES) == 0).sum(axis=1) >= BYTES - max_bits
    near = np.flatnonzero(hit)
    hit[near] = np.bitwise_count(diff[near]) <= max_bits
    return hit


def _forest(a: np.ndarray, max_bits: int) -> list[tuple[int, int]]:
    """Edges ``(member, first member)`` of each group of linked fingerprints.
    A fingerprint is compared only with those not yet reached, so a dense
    group costs about one pass instead of all its pairs."""
    out, rest = [], a
    while len(rest) > 1:
        root, rest = rest[0], rest[1:]
        queue = [root]
        while queue and len(rest):
            hit = _verified(rest, queue.pop(), max_bits)
            if hit.any():
                found, rest = rest[hit], rest[~hit]
                out += [(x, root) for x in found]
                queue += list(found)
    return out


def _link(max_bits: int):
    """mapInArrow over rows ``cell, fp`` sorted by cell."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def edges(fp: np.ndarray, cuts: np.ndarray) -> pa.RecordBatch:
            # ``cuts`` ends with len(fp). Cells of two are compared at once.
            starts = np.concatenate(([0], cuts[:-1]))
            size = cuts - starts
            two = starts[size == 2]
            a, b = fp[two], fp[two + 1]
            diff = a ^ b
            ok = (diff.view(np.uint8).reshape(-1, BYTES) == 0).sum(axis=1) >= BYTES - max_bits
            ok &= np.bitwise_count(diff) <= max_bits
            more = [e for s, n in zip(starts[size > 2], size[size > 2], strict=True) for e in _forest(fp[s : s + n], max_bits)]
            u = np.concatenate((a[ok], np.array([e[0] for e in more], np.uint64)))
            v = np.concatenate((b[ok], np.array([e[1] for e in more], np.uint64)))
            return pa.RecordBatch.from_arrays([pa.array(u.view(np.int64)), pa.array(v.view(np.int64))], ["u", "v"])

        held_key, held = None, np.empty(0, np.uint64)
        for batch in batches:
            if not batch.num_rows:
                continue
            cols = [batch.column(i).to_numpy(zero_copy_only=False) for i in range(4)]
            fp = batch.column(4).to_numpy(zero_copy_only=False).view(np.uint64)
            new = np.zeros(len(fp), bool)
            for c in cols:
                new[1:] |= c[1:] != c[:-1]
            first = tuple(int(c[0]) for c in cols)
            cuts = np.flatnonzero(new)
            if held_key is not None and first != held_key:
                cuts = np.concatenate(([0], cuts))
            fp = np.concatenate((held, fp))
            cuts = cuts + len(held)
            held_key = tuple(int(c[-1]) for c in cols)
            done = int(cuts[-1]) if len(cuts) else 0
            held = fp[done:]
            if done:
                yield edges(fp[:done], cuts)
        if len(held) > 1:
            yield edges(held, np.array([len(held)]))

    return run


def links(fps: DataFrame, max_bits: int = 4, block: int = 16384) -> DataFrame:
    """Edges ``u, v`` between distinct fingerprints (column ``fp``), enough to
    join everything that is linked, directly or through others."""
    masks = [sum(0xFF << (8 * p) for p in t) for t in positions(max_bits)]
    signed = [m - (1 << 64) if m >> 63 else m for m in masks]
    posted = fps.select(
        "fp",
        F.explode(F.array(*[F.struct(F.lit(i).alias("part"), F.col("fp").bitwiseAND(F.lit(m)).alias("key")) for i, m in enumerate(signed)])).alias("p"),
    ).select("p.part", "p.key", "fp")
    # Lists of one hold no pair; the counts are combined before the shuffle.
    met = posted.groupBy("part", "key").agg(F.count(F.lit(1)).alias("n")).where("n > 1")
    met = posted.join(met, ["part", "key"]).withColumn("blocks", F.ceil(F.col("n") / block).cast("int"))
    own = F.pmod(F.xxhash64("fp"), F.col("blocks")).cast("int")
    cells = met.select("part", "key", "fp", own.alias("own"), F.explode(F.sequence(F.lit(0), F.col("blocks") - 1)).alias("other"))
    cells = cells.select("part", "key", F.least("own", "other").alias("lo"), F.greatest("own", "other").alias("hi"), "fp")
    by = ["part", "key", "lo", "hi"]
    return arrow_rows(cells.repartition(*by).sortWithinPartitions(*by), _link(max_bits), "u long, v long")


def near_duplicates(fps: DataFrame, max_bits: int = 4, block: int = 16384) -> DataFrame:
    """Adds ``root`` (a component's label) and ``component_id`` (its smallest
    ``doc_id``; null when it has none) to the rows of ``fingerprints``. Every
    row stays; rows with equal fingerprints are in one component."""
    by_fp = settled(fps.groupBy("fp").agg(F.min("doc_id").alias("low")))
    roots = connected_components(links(by_fp.select("fp"), max_bits, block))
    of = by_fp.join(roots, by_fp["fp"] == roots["node"], "left").select("fp", "low", F.coalesce("root", "fp").alias("root"))
    of = settled(of)
    least = of.groupBy("root").agg(F.min("low").alias("component_id"))
    return fps.join(of.join(least, "root").select("fp", "root", "component_id"), "fp")


def simhash_groups(docs: DataFrame, shingle: int = 4, max_bits: int = 4, block: int = 16384) -> DataFrame:
    """``doc_id, row, fp, root, component_id`` (``row``: see ``row_key``) per row of ``docs``.

    Nulls: a null text has no words (fingerprint zero, linked like any other);
    a null ``doc_id`` joins its component but never names it. Repeated rows
    each give a row. No rows: no rows."""
    return near_duplicates(settled(fingerprints(docs, shingle)), max_bits, block)


def keep_one(docs: DataFrame, groups: DataFrame) -> DataFrame:
    """The rows of ``docs`` that stand for their component: that with the
    smallest ``doc_id`` (then row key, for rows that share an id), once. A
    component without ids keeps its smallest row key."""
    first = F.min(F.struct(F.col("doc_id").isNull().alias("x"), "doc_id", "row")).alias("first")
    keep = groups.groupBy("root").agg(first).select(F.col("first.row").alias("__row_key"))
    keyed = docs.withColumn("__row_key", row_key(F.col("doc_id"), F.col("text")))
    # Semi join and removal of repeated rows share one exchange on the key.
    return keyed.join(keep, "__row_key", "left_semi").dropDuplicates(["__row_key"]).select(*docs.columns)
