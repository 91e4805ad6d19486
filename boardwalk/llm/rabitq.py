"""Nearest neighbours by inner product over randomly rotated one-bit codes.

A vector, less the centre, is turned by a random rotation and kept as its
signs (packed bits) and two scalars: its length r, and the product f of its
direction with the unit vector of its signs. For a query q the product of that
unit vector and the rotated query, divided by f, estimates the product of the
direction with q; times r, plus the centre's product with q, it estimates the
inner product sought. The error of the direction's estimate is about

    sqrt((1 - f^2) / f^2) * |q| / sqrt(dims - 1)

and ``sure`` times that bounds it but for a small probability. Per query the
best estimates are computed exactly first; a vector is reranked if its upper
bound reaches the worst of the nearest found by that. Reranking takes single
precision first, and double precision for what can be among the nearest within
the rounding error of that.

Every query meets every code, in blocks: queries and vectors are dealt into
blocks, a pair of blocks is one task's work and returns each query's nearest
in the pair, and those are merged. Nothing is broadcast but the rotation; the
centre is the mean of a bounded sample. Of equal vectors in a block only the
smallest ids can be among the nearest, so only those are scored.

Vectors that are null, zero or hold a null or non-finite component take no
part, nor do rows without ``vec_id``. Vectors of different length are never
compared. An id is one vector: of several the smallest in array order.
"""

from __future__ import annotations

from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boardwalk.llm.common import arrow_rows, settled, ship, smallest

_CODES = "vec_id long, dims int, code binary, r double, f double, vec binary"
_NEAREST = "query_id long, vec_id long, score double"


def rotation(dims: int, seed: int) -> np.ndarray:
    """A random rotation to a multiple of eight dimensions."""
    padded = -(-dims // 8) * 8
    q, r = np.linalg.qr(np.random.default_rng((seed, dims)).standard_normal((padded, padded)))
    return (q * np.sign(np.diag(r)))[:dims]


def encode(vectors: np.ndarray, centre: np.ndarray, turn: np.ndarray) -> tuple[np.ndarray, ...]:
    """Packed signs, r and f, by row."""
    rest = vectors - centre
    r = np.sqrt((rest * rest).sum(axis=1))
    turned = rest @ turn
    f = np.abs(turned).sum(axis=1) / np.sqrt(turn.shape[1]) / np.where(r > 0, r, 1)
    return np.packbits(turned >= 0, axis=1), r, np.where(r > 0, f, 1)


def exact(vectors: np.ndarray, rows: np.ndarray, queries: np.ndarray, query_rows: np.ndarray, lot: int = 8192) -> np.ndarray:
    """Inner products of pairs of rows in double precision, summed from the
    first component on, so equal vectors get equal scores."""
    out = np.zeros(len(rows))
    for i in range(0, len(rows), lot):
        part = slice(i, i + lot)
        v = np.ascontiguousarray(vectors[rows[part]].T, np.float64)
        v *= queries[query_rows[part]].T
        total = out[part]
        for component in v:
            total += component
    return out


def search_block(query_ids, queries, ids, vectors, codes, r, f, centre, turn, k: int, sure: float, lot: int = 64) -> tuple[np.ndarray, ...]:
    """``query row, vector row, score`` of each query's ``k`` nearest."""
    dims = turn.shape[1]
    signs = (np.unpackbits(codes, axis=1).astype(np.float32) * 2 - 1) / np.float32(np.sqrt(dims))
    signs *= (r / f)[:, None].astype(np.float32)
    error = r * np.sqrt(np.maximum(1 - f * f, 0)) / f / np.sqrt(max(dims - 1, 1)) * sure
    error = (error + 1e-5 * r).astype(np.float32)  # single precision
    single = np.ascontiguousarray(vectors, np.float32)
    # Of a product of two single-precision vectors, by their lengths.
    rounding = np.float32((vectors.shape[1] + 2) * 2.0**-23) * np.sqrt((single * single).sum(axis=1)).max(initial=0)
    at = {int(x): i for i, x in enumerate(ids)}
    found: list[tuple[np.ndarray, ...]] = []
    for i in range(0, len(queries), lot):
        q = queries[i : i + lot]
        length = np.sqrt((q * q).sum(axis=1)).astype(np.float32)
        guess = (q @ turn).astype(np.float32) @ signs.T  # (queries, vectors)
        guess += (q @ centre).astype(np.float32)[:, None]
        for n, x in enumerate(query_ids[i : i + lot].tolist()):
            if x in at:  # a query is not its own neighbour
                guess[n, at[x]] = -np.inf
        first = min(4 * k, guess.shape[1])
        tried = np.argpartition(guess, -first, axis=1)[:, -first:]
        score = exact(vectors, tried.ravel(), q, np.repeat(np.arange(len(q)), first)).reshape(len(q), first)
        score[np.isneginf(np.take_along_axis(guess, tried, 1))] = -np.inf
        worst = np.partition(score, -min(k, first), axis=1)[:, -min(k, first)].astype(np.float32)
        worst -= np.float32(1e-6) * (1 + np.abs(worst))
        guess += length[:, None] * error  # now the upper bounds
        chosen = (guess >= worst[:, None]) & ~np.isneginf(guess)
        near = np.where(chosen, q.astype(np.float32) @ single.T, -np.inf)
        tail = min(k, near.shape[1])
        least = np.partition(near, -tail, axis=1)[:, -tail] - 2 * rounding * length
        rows, cols = np.nonzero(chosen & ~(near < least[:, None]))  # overflows stay
        score = exact(vectors, cols, q, rows)
        order = np.lexsort((ids[cols], -score, rows))
        rows, cols, score = rows[order], cols[order], score[order]
        best = np.arange(len(rows)) - np.searchsorted(rows, rows) < k
        found.append((rows[best] + i, cols[best], score[best]))
    return tuple(np.concatenate(x) for x in zip(*found, strict=True))


def _smallest_of_equal(ids: np.ndarray, vectors: np.ndarray, k: int) -> np.ndarray:
    """Rows but those beyond the ``k`` smallest ids of equal vectors."""
    _, of = np.unique(np.ascontiguousarray(vectors).view(np.dtype((np.void, vectors.dtype.itemsize * vectors.shape[1]))).ravel(), return_inverse=True)
    order = np.lexsort((ids, of))
    nth = np.arange(len(order)) - np.searchsorted(of[order], of[order])
    return np.sort(order[nth < k])


def usable(vector: Column) -> Column:
    finite = F.forall(vector, lambda x: x.isNotNull() & ~F.isnan(x) & (F.abs(x) < F.lit(float("inf"))))
    return vector.isNotNull() & (F.size(vector) > 0) & finite & F.exists(vector, lambda x: x != 0)


def _matrix(column, dims: int) -> np.ndarray:
    """Rows of packed vectors, in the precision they were packed in."""
    data = b"".join(column.to_pylist())
    return np.frombuffer(data, np.float32 if len(data) == 4 * dims * len(column) else np.float64).reshape(-1, dims)


def build_index(vectors: DataFrame, sample: int = 4096, seed: int = 17) -> tuple[DataFrame, dict[int, np.ndarray]]:
    """Codes of every usable row of ``vectors (vec_id, embedding)`` and the
    centres by length: means over the ``sample`` rows with the smallest hash."""
    rows = vectors.select(F.col("vec_id").cast("long").alias("vec_id"), F.col("embedding").cast("array<double>").alias("v"))
    rows = rows.where(F.col("vec_id").isNotNull() & usable(F.col("v")))
    rows = rows.groupBy("vec_id").agg(F.min("v").alias("v")).withColumn("dims", F.size("v"))
    got: dict[int, list] = {}
    for r in smallest(rows, sample, F.xxhash64("vec_id"), "vec_id"):
        got.setdefault(r["dims"], []).append(r["v"])
    centres = {d: np.mean(v, axis=0) for d, v in got.items()}

    kept = np.float32 if dict(vectors.dtypes)["embedding"] == "array<float>" else np.float64  # exactly, either way

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        turns: dict[int, np.ndarray] = {}
        for b in batches:
            all_dims = b.column(2).to_numpy()
            for d in np.unique(all_dims).tolist():
                part = b.filter(pa.array(all_dims == d))
                x = part.column(1).flatten().to_numpy().reshape(-1, d)
                turn = turns.setdefault(d, rotation(d, seed))
                code, r, f = encode(x, centres.get(d, np.zeros(d)), turn)
                packed = lambda m: pa.array([row.tobytes() for row in m], pa.binary())
                yield pa.RecordBatch.from_arrays(
                    [part.column(0), part.column(2), packed(code), pa.array(r), pa.array(f), packed(x.astype(kept))],
                    [x.split()[0] for x in _CODES.split(", ")],
                )

    return settled(arrow_rows(rows, run, _CODES)), centres


def search(codes: DataFrame, centres: dict[int, np.ndarray], queries: Column, k: int = 20, sure: float = 2.5, vector_block: int = 32768, query_block: int = 8192, seed: int = 17) -> DataFrame:
    """``query_id, rank, vec_id, score``: the ``k`` nearest found of each row
    of the index for which ``queries`` holds, its own left out, by score and
    then smaller vec_id."""
    ship(codes.sparkSession)
    n = {r["dims"]: (r["n"], r["q"]) for r in codes.groupBy("dims").agg(F.count(F.lit(1)).alias("n"), F.count_if(queries).alias("q")).collect()}
    if not n:
        return codes.sparkSession.createDataFrame([], "query_id long, rank int, vec_id long, score double")
    blocks = max(1, -(-max(x for x, _ in n.values()) // vector_block))
    query_blocks = max(1, -(-max(x for _, x in n.values()) // query_block))
    span = lambda m: F.explode(F.sequence(F.lit(0), F.lit(m - 1)))
    own = lambda m: F.pmod(F.xxhash64("vec_id"), F.lit(m)).cast("int")
    left = codes.where(queries).select("dims", own(query_blocks).alias("qb"), span(blocks).alias("vb"), "vec_id", "vec")
    right = codes.select("dims", span(query_blocks).alias("qb"), own(blocks).alias("vb"), "vec_id", "code", "r", "f", "vec")

    def pair(q: pa.Table, v: pa.Table) -> pa.Table:
        empty = pa.table({"query_id": pa.array([], pa.int64()), "vec_id": pa.array([], pa.int64()), "score": pa.array([], pa.float64())})
        if not q.num_rows or not v.num_rows:
            return empty
        d = v["dims"][0].as_py()
        ids, x = v["vec_id"].to_numpy(), _matrix(v["vec"], d)
        keep = _smallest_of_equal(ids, x, k + 1)
        v, ids, x = v.take(keep), ids[keep], x[keep]
        code = np.frombuffer(b"".join(v["code"].to_pylist()), np.uint8).reshape(len(ids), -1)
        q_ids = q["vec_id"].to_numpy()
        rows, cols, score = search_block(q_ids, _matrix(q["vec"], d).astype(np.float64), ids, x, code, v["r"].to_numpy(), v["f"].to_numpy(), centres.get(d, np.zeros(d)), rotation(d, seed), k, sure)
        return pa.table({"query_id": q_ids[rows], "vec_id": ids[cols], "score": score})

    by = ["dims", "qb", "vb"]
    near = left.groupBy(*by).cogroup(right.groupBy(*by)).applyInArrow(pair, _NEAREST)
    rank = F.row_number().over(Window.partitionBy("query_id").orderBy(F.desc("score"), "vec_id"))
    return near.withColumn("rank", rank).where(F.col("rank") <= k).select("query_id", "rank", "vec_id", "score")


def nearest(vectors: DataFrame, queries: Column, k: int = 20, **how) -> DataFrame:
    """``search`` of an index of ``vectors`` for its rows with ``queries``."""
    codes, centres = build_index(vectors)
    return search(codes, centres, queries, k, **how)
