"""Toxicity by non-negative positive-unlabelled learning.

Learned from texts confirmed as toxic and from unlabelled texts, any texts with
their labels ignored, which hold an unknown mix. With class prior p, the risk
of a classifier is

    p * loss(positives as 1) + max(0, loss(unlabelled as 0) - p * loss(positives as 0))

The second part estimates the loss on clean texts. When a batch makes it
negative, the model has begun to memorise, and the step goes the other way for
that part. The classifier is linear over the hashed words that occur
significantly more or less often in the positives, fitted in numpy by Adam.
Weights are shrunk, so probabilities come out too even; at the end the bias is
set so that the share of unlabelled texts called toxic is the prior.

The prior is the share of toxic rows where labels say both; where they only
confirm, it is estimated from the unlabelled texts (``mixture_share``).
"""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardwalk.llm import features
from boardwalk.llm.common import fold

Rows = list[tuple[np.ndarray, None]]


class Sparse:
    """Rows of (column, value) pairs end to end."""

    def __init__(self, rows: Rows, column: np.ndarray):
        self.size = np.array([len(i) for i, _ in rows], np.int64)
        ids = column[np.concatenate([i for i, _ in rows])] if rows else np.empty(0, np.int64)
        keep = ids >= 0
        owner = np.repeat(np.arange(len(rows)), self.size)[keep]
        self.ids, self.n = ids[keep], len(rows)
        self.ends = np.searchsorted(owner, np.arange(self.n + 1))

    def take(self, rows: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Columns of the given rows, and which of those each belongs to."""
        sizes = self.ends[rows + 1] - self.ends[rows]
        at = np.repeat(self.ends[rows] - np.concatenate(([0], np.cumsum(sizes)[:-1])), sizes) + np.arange(sizes.sum())
        return self.ids[at], np.repeat(np.arange(len(rows)), sizes)


BUCKETS = 1 << features.WORD_BITS


def telling(positive: Rows, unlabelled: Rows, min_rows: int, z: float) -> np.ndarray:
    """Buckets in at least ``min_rows`` texts whose share of the positives and
    of the unlabelled differ by ``z`` standard errors or more."""
    p = np.bincount(np.concatenate([i for i, _ in positive]), minlength=BUCKETS)
    u = np.bincount(np.concatenate([i for i, _ in unlabelled]), minlength=BUCKETS)
    n, m = len(positive), len(unlabelled)
    pooled = (p + u) / (n + m)
    error = np.sqrt(pooled * (1 - pooled) * (1 / n + 1 / m))
    return np.flatnonzero((p + u >= min_rows) & (np.abs(p / n - u / m) >= z * error) & (error > 0))


def mixture_share(positive: Rows, unlabelled: Rows, min_rows: int = 5, z: float = 4.0, delta: float = 0.1) -> float:
    """The share of positives among the unlabelled, from positives alone.

    One half of either kind gives the words that tell, and how much; the other
    half is scored by them. Texts above a threshold make up a share u of the
    unlabelled and p of the positives, so positives are at most u / p of the
    unlabelled; far up hardly anything else is left there, and the ratio is the
    share itself. The threshold is that whose ratio is smallest once u is
    raised by its sampling error."""
    if len(positive) < 4 or len(unlabelled) < 4:
        return 0.5
    p, u = positive[::2], unlabelled[::2]
    kept = telling(p, u, min_rows, z)
    column = np.full(BUCKETS, -1, np.int64)
    column[kept] = np.arange(len(kept))
    share = lambda x: (np.bincount(Sparse(x, column).ids, minlength=len(kept)) + 1) / (len(x) + 2)
    weight = np.log(share(p) / share(u))

    def scores(rows: Rows) -> np.ndarray:
        ids, owner = Sparse(rows, column).take(np.arange(len(rows)))
        return np.sort(np.bincount(owner, weight[ids], len(rows)))

    sp, su = scores(positive[1::2]), scores(unlabelled[1::2])
    above = lambda s, t: 1 - np.searchsorted(s, t) / len(s)
    ts = np.unique(sp)
    error = np.sqrt(np.log(4 / delta) / 2) * (1 / np.sqrt(len(su)) + 1 / np.sqrt(len(sp)))
    best = ts[np.argmin((above(su, ts) + error) / above(sp, ts))]
    return float(np.clip(above(su, best) / above(sp, best), 1 / len(su), 1 - 1 / len(su)))


def fit_nnpu(positive: Rows, unlabelled: Rows, prior: float | None, min_rows: int = 5, z: float = 4.0, rounds: int = 1000, batch: int = 512, rate: float = 0.05, decay: float = 0.01, seed: int = 11) -> tuple[np.ndarray, float]:
    """Weights by bucket (zero but for ``telling`` ones) and the bias. Without
    a prior it is estimated. Without positives or unlabelled texts the score is
    the prior."""
    prior = mixture_share(positive, unlabelled, min_rows, z) if prior is None else prior
    weights, bias = np.zeros(BUCKETS), float(np.log(max(prior, 1e-6) / max(1 - prior, 1e-6)))
    if not positive or not unlabelled:
        return weights, bias
    kept = telling(positive, unlabelled, min_rows, z)
    column = np.full(BUCKETS, -1, np.int64)
    column[kept] = np.arange(len(kept))
    pos, unl = Sparse(positive, column), Sparse(unlabelled, column)
    rng = np.random.default_rng(seed)
    w, m, v = np.zeros(len(kept) + 1), np.zeros(len(kept) + 1), np.zeros(len(kept) + 1)
    w[-1] = bias

    def scores(x: Sparse, rows: np.ndarray):
        ids, owner = x.take(rows)
        return np.bincount(owner, w[ids], len(rows)) + w[-1], ids, owner

    def gradient(ids: np.ndarray, owner: np.ndarray, g: np.ndarray) -> np.ndarray:
        return np.append(np.bincount(ids, g[owner], len(kept)), g.sum())

    logistic = lambda z: 1 / (1 + np.exp(-np.clip(z, -50, 50)))
    loss = lambda z: np.logaddexp(0, z).mean()
    for step in range(1, rounds + 1):
        zp, ip, op = scores(pos, rng.integers(0, pos.n, batch))
        zu, iu, ou = scores(unl, rng.integers(0, unl.n, 2 * batch))
        clean = loss(zu) - prior * loss(zp)
        rest = gradient(iu, ou, logistic(zu) / len(zu)) - prior * gradient(ip, op, logistic(zp) / len(zp))
        if clean >= 0:
            g = prior * gradient(ip, op, (logistic(zp) - 1) / len(zp)) + rest
        else:
            g = -rest
        g[:-1] += decay / 10 * w[:-1]
        m += 0.1 * (g - m)
        v += 0.01 * (g * g - v)
        w -= rate * min(1.0, 2 * (1 - step / (rounds + 1))) * (m / (1 - 0.9**step)) / (np.sqrt(v / (1 - 0.99**step)) + 1e-6)
    weights[kept] = w[:-1]
    # The prior's share of the unlabelled lies above the middle of this gap.
    every = np.sort(scores(unl, np.arange(unl.n))[0])
    least = np.quantile(every, 1 - prior, method="higher")
    below = every[every < least - 1e-9]
    return weights, float(w[-1] - (least + (below[-1] if len(below) else least)) / 2)


def _collected(docs: DataFrame, ids: DataFrame) -> Rows:
    """Features of one text (``features.one_text``) of each id of ``ids``, a
    bounded table, in the order of ids."""
    ids = F.broadcast(ids.select("doc_id").distinct())
    chosen = features.one_text(docs.join(ids, "doc_id", "left_semi")).orderBy("doc_id").select(F.lit(1).alias("one"), "text")
    return [(ids, None) for ids, _, _ in features.collected(chosen, features.word_set, "one")]


def fit(docs: DataFrame, labels: DataFrame, usable, most_positive: int = 4000, most_unlabelled: int = 12000, prior: float | None = None) -> tuple[np.ndarray, float]:
    """Fitted on at most ``most_positive`` confirmed and ``most_unlabelled``
    unlabelled texts, chosen by the hash of their id among the rows where
    ``usable`` holds. The unlabelled are drawn from all texts, labels ignored:
    the mix that the risk assumes, even if every text has a label.

    ``prior``: the share of toxic texts, if known. Else it is the share of toxic
    rows among the usable labelled ones or, where those are toxic throughout,
    estimated. A text with any row that says 1 is confirmed; a null label is
    none. Each id is used once, with its text of smallest hash where rows of
    one id differ."""
    known = labels.where("toxic IS NOT NULL AND doc_id IS NOT NULL").where(usable)
    if prior is None:
        share = known.agg(F.avg((F.col("toxic") > 0).cast("double"))).first()[0]
        prior = 0.0 if share is None else None if share == 1 else share
    pick = lambda df, n: df.select("doc_id").distinct().orderBy(F.xxhash64("doc_id"), "doc_id").limit(n)
    positive = pick(known.where("toxic > 0"), most_positive)
    every = docs.where("doc_id IS NOT NULL").where(usable)
    return fit_nnpu(_collected(docs, positive), _collected(docs, pick(every, most_unlabelled)), prior)


def score(docs: DataFrame, labels: DataFrame, parts: int = 5, held: int = 0, prior: float | None = None) -> DataFrame:
    """``doc_id, score, predicted, held_out`` per row of ``docs``, learned from
    the rows whose fold (crc32 of the id modulo ``parts``) is not ``held``.
    Whole texts; a null text is an empty one, which gets the bias alone."""
    out_of = fold(F.col("doc_id"), parts) == held
    weights, bias = fit(docs, labels, ~out_of, prior=prior)
    return features.scored(docs, features.word_set, weights, bias).withColumn("held_out", out_of)
