"""Quality by logistic regression over hashed word n-grams, trained with
follow-the-regularised-leader (FTRL-proximal) updates."""

from __future__ import annotations

import numpy as np
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardwalk.llm import features
from boardwalk.llm.common import fold


class Ftrl:
    """Per-coordinate FTRL-proximal with L1 and L2 penalties. The weights are
    a function of the gradients' sums, so a bucket never seen weighs nothing."""

    def __init__(self, buckets: int = 1 << features.GRAM_BITS, rate: float = 0.3, beta: float = 1.0, l1: float = 0.02, l2: float = 0.1):
        self.z, self.n = np.zeros(buckets + 1), np.zeros(buckets + 1)  # the last is the bias
        self.rate, self.beta, self.l1, self.l2 = rate, beta, l1, l2

    def weights(self, ids=slice(None)) -> np.ndarray:
        z, n = self.z[ids], self.n[ids]
        shrunk = np.sign(z) * np.maximum(np.abs(z) - self.l1, 0)
        return -shrunk / ((self.beta + np.sqrt(n)) / self.rate + self.l2)

    def update(self, ids: np.ndarray, vals: np.ndarray, label: int) -> None:
        ids, vals = np.append(ids, len(self.z) - 1), np.append(vals, 1.0)
        w = self.weights(ids)
        p = 1 / (1 + np.exp(-np.clip(w @ vals, -35, 35)))
        g = (p - label) * vals
        n = self.n[ids]
        self.z[ids] += g - (np.sqrt(n + g * g) - np.sqrt(n)) / self.rate * w
        self.n[ids] = n + g * g


def fit_ftrl(rows: list[tuple[np.ndarray, np.ndarray, int]], epochs: int = 3, seed: int = 5) -> tuple[np.ndarray, float]:
    """Weights by bucket and the bias, from (ids, values, label)."""
    model, rng = Ftrl(), np.random.default_rng(seed)
    for _ in range(epochs):
        for i in rng.permutation(len(rows)):
            model.update(*rows[i])
    w = model.weights()
    return w[:-1], float(w[-1])


def fit(docs: DataFrame, labels: DataFrame, usable, most: int = 12000) -> tuple[np.ndarray, float]:
    """Fitted on at most ``most`` labelled texts, chosen by the hash of their
    id among the rows where ``usable`` holds. Null labels don't count; of
    several for one id the smallest does. Each id is used once, with its text of
    smallest hash where rows of one id differ (``features.one_text``)."""
    known = labels.where("quality IS NOT NULL AND doc_id IS NOT NULL").where(usable)
    known = known.groupBy("doc_id").agg(F.min((F.col("quality") > 0).cast("int")).alias("label"))
    # At most ``most`` rows, so small enough to broadcast.
    chosen = known.orderBy(F.xxhash64("doc_id"), "doc_id").limit(most)
    texts = features.one_text(docs.join(F.broadcast(chosen.select("doc_id")), "doc_id", "left_semi")).join(F.broadcast(chosen), "doc_id")
    return fit_ftrl(features.collected(texts.orderBy("doc_id"), features.word_ngrams, "label"))


def score(docs: DataFrame, labels: DataFrame, parts: int = 3, held: int = 1) -> DataFrame:
    """``doc_id, score, predicted, held_out`` per row of ``docs``, learned from
    the rows whose fold (crc32 of the id modulo ``parts``) is not ``held``.
    Whole texts; a null text is an empty one, which gets the bias alone."""
    out_of = fold(F.col("doc_id"), parts) == held
    weights, bias = fit(docs, labels, ~out_of)
    return features.scored(docs, features.word_ngrams, weights, bias).withColumn("held_out", out_of)
