"""Language identification by a bidirectional gated recurrent network over
the bytes of a text, trained in numpy by backpropagation through time.

Both directions read windows of ``window`` bytes; at each position their two
states give a probability for every language, so every byte of the text gets a
label. A document's probabilities are the mean over all its positions.

Layout: arrays are (direction, feature, batch) with the batch contiguous, so a
step is a few long vector operations for thousands of windows at once.
"""

from __future__ import annotations

from collections.abc import Iterator
from dataclasses import dataclass

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from boardwalk.llm.common import arrow_rows, fold, sliced, smallest

UNKNOWN = "und"
#: Fills a window after the end of its text; never a byte of UTF-8.
PAD = 0xFF
#: Parts that a language's rows are ranked in first.
SALTS = 64


@dataclass
class Network:
    languages: list[str]
    inputs: np.ndarray  # (2, 3h, 256): what each byte adds to the gates
    recurrent: np.ndarray  # (2, 3h, h)
    bias: np.ndarray  # (2, h): of the candidate's recurrent part
    out: np.ndarray  # (2, languages, h)
    out_bias: np.ndarray  # (languages,)

    def arrays(self) -> list[np.ndarray]:
        return [self.inputs, self.recurrent, self.bias, self.out, self.out_bias]


def new_network(languages: list[str], hidden: int, seed: int) -> Network:
    rng = np.random.default_rng(seed)
    f = np.float32
    draw = lambda *s, scale: (rng.standard_normal(s) * scale).astype(f)
    n = len(languages)
    return Network(
        languages,
        draw(2, 3 * hidden, 256, scale=0.3),
        draw(2, 3 * hidden, hidden, scale=hidden**-0.5),
        np.zeros((2, hidden), f),
        draw(2, n, hidden, scale=hidden**-0.5),
        np.zeros(n, f),
    )


def _gates(net: Network, steps: np.ndarray, t: int, h: np.ndarray, x: np.ndarray, g: np.ndarray) -> tuple[np.ndarray, ...]:
    """Update gate, reset gate, candidate and the candidate's recurrent part
    of both directions at step ``t``; ``x`` and ``g`` are scratch."""
    k = h.shape[1]
    for d, at in ((0, t), (1, len(steps) - 1 - t)):
        np.take(net.inputs[d], steps[at], axis=1, out=x[d], mode="clip")
    np.matmul(net.recurrent, h, out=g)
    zr = x[:, : 2 * k]
    zr += g[:, : 2 * k]
    zr *= 0.5  # the logistic function by way of tanh
    np.tanh(zr, out=zr)
    zr += 1
    zr *= 0.5
    u = g[:, 2 * k :]
    u += net.bias[:, :, None]
    n = x[:, 2 * k :]
    n += zr[:, k:] * u
    np.tanh(n, out=n)
    return zr[:, :k], zr[:, k:], n, u


def _position_probs(net: Network, states: np.ndarray) -> np.ndarray:
    """(window, languages, batch) from (window, 2, h, batch)."""
    logits = np.matmul(net.out[0], states[:, 0])
    logits += np.matmul(net.out[1], states[::-1, 1])
    logits += net.out_bias[:, None]
    logits -= logits.max(axis=1, keepdims=True)
    np.exp(logits, out=logits)
    logits /= logits.sum(axis=1, keepdims=True)
    return logits


def label_positions(net: Network, windows: np.ndarray) -> np.ndarray:
    """Probabilities (window, languages, batch) for rows of bytes."""
    steps = np.ascontiguousarray(windows.T).astype(np.intp)
    w, batch = steps.shape
    k = net.recurrent.shape[2]
    h = np.zeros((2, k, batch), np.float32)
    x, g = np.empty((2, 3 * k, batch), np.float32), np.empty((2, 3 * k, batch), np.float32)
    states = np.empty((w, 2, k, batch), np.float32)
    for t in range(w):
        z, _, n, _ = _gates(net, steps, t, h, x, g)
        h -= n
        h *= z
        h += n
        states[t] = h
    return _position_probs(net, states)


def gradients(net: Network, windows: np.ndarray, labels: np.ndarray) -> tuple[float, list[np.ndarray]]:
    """Mean cross-entropy over all positions that hold a byte, and its
    gradients by backpropagation through time."""
    steps = np.ascontiguousarray(windows.T).astype(np.intp)
    w, batch = steps.shape
    k = net.recurrent.shape[2]
    h = np.zeros((2, k, batch), np.float32)
    states, tape = np.empty((w, 2, k, batch), np.float32), []
    for t in range(w):
        x, g = np.empty((2, 3 * k, batch), np.float32), np.empty((2, 3 * k, batch), np.float32)
        z, r, n, u = _gates(net, steps, t, h, x, g)
        tape.append((z, r, n, u, h))
        h = n + z * (h - n)
        states[t] = h
    p = _position_probs(net, states)
    valid = (steps != PAD).astype(np.float32)
    valid /= max(valid.sum(), 1)
    each = np.arange(batch)
    loss = float(-(np.log(p[:, labels, each] + 1e-9) * valid).sum())
    p[:, labels, each] -= 1
    p *= valid[:, None]
    d_out = np.stack([np.einsum("wlb,whb->lh", p, states[:, 0], optimize=True), np.einsum("wlb,whb->lh", p, states[::-1, 1], optimize=True)])
    d_bias_out = p.sum(axis=(0, 2))
    d_states = np.stack([np.matmul(net.out[0].T, p), np.matmul(net.out[1].T, p)[::-1]], axis=1)
    d_rec, d_bias = np.zeros_like(net.recurrent), np.zeros_like(net.bias)
    d_x = np.empty((w, 2, 3 * k, batch), np.float32)
    back = net.recurrent.transpose(0, 2, 1)
    dh = np.zeros((2, k, batch), np.float32)
    for t in range(w - 1, -1, -1):
        z, r, n, u, before = tape[t]
        dh = dh + d_states[t]
        dn = dh * (1 - z) * (1 - n * n)
        dx = d_x[t]
        dx[:, :k] = dh * (before - n) * z * (1 - z)
        dx[:, k : 2 * k] = dn * u * r * (1 - r)
        dx[:, 2 * k :] = dn
        dg = dx.copy()
        dg[:, 2 * k :] *= r
        d_bias += dg[:, 2 * k :].sum(axis=2)
        d_rec += np.matmul(dg, before.transpose(0, 2, 1))
        dh = dh * z + np.matmul(back, dg)
    d_in = np.zeros((2, 256, 3 * k), np.float32)
    for d, order in ((0, steps), (1, steps[::-1])):
        np.add.at(d_in[d], order.ravel(), d_x[:, d].transpose(0, 2, 1).reshape(-1, 3 * k))
    return loss, [d_in.transpose(0, 2, 1), d_rec, d_bias, d_out, d_bias_out]


def train(sample: Sample, hidden: int = 8, rounds: int = 240, batch: int = 256, rate: float = 0.03, seed: int = 7) -> Network:
    """A network fitted by Adam on windows of bytes; each batch draws texts
    evenly over the languages, and a window of each from all of the text."""
    net = new_network(sample.languages, hidden, seed)
    rng = np.random.default_rng(seed)
    rows = [np.flatnonzero(sample.labels == i) for i in range(len(sample.languages))]
    m, v = [np.zeros_like(a) for a in net.arrays()], [np.zeros_like(a) for a in net.arrays()]
    for step in range(1, rounds + 1):
        take = np.concatenate([rng.choice(r, -(-batch // len(rows))) for r in rows])
        _, grads = gradients(net, sample.draw(rng, take), sample.labels[take])
        norm = np.sqrt(sum(float((g * g).sum()) for g in grads))
        lr = rate * min(1.0, 2 * (1 - step / (rounds + 1)))
        for a, g, m1, v1 in zip(net.arrays(), grads, m, v, strict=True):
            g = g / max(norm, 1.0)
            m1 += 0.1 * (g - m1)
            v1 += 0.01 * (g * g - v1)
            a -= lr * (m1 / (1 - 0.9**step)) / (np.sqrt(v1 / (1 - 0.99**step)) + 1e-8)
    return net


@dataclass
class Sample:
    """Training texts cut into windows, end to end: text i has the windows from
    ``starts[i]`` to ``starts[i + 1]`` and the label ``labels[i]``."""

    windows: np.ndarray
    starts: np.ndarray
    labels: np.ndarray
    languages: list[str]

    def draw(self, rng: np.random.Generator, texts: np.ndarray) -> np.ndarray:
        """A window of each text, any with the same chance."""
        size = self.starts[texts + 1] - self.starts[texts]
        return self.windows[self.starts[texts] + (rng.random(len(texts)) * size).astype(np.int64)]


def _windows(raw: bytes, window: int) -> np.ndarray:
    """The windows that a text is made up of, the last one filled up."""
    out = np.full(max(1, -(-len(raw) // window)) * window, PAD, np.uint8)
    out[: len(raw)] = np.frombuffer(raw, np.uint8)
    return out.reshape(-1, window)


def training_sample(docs: DataFrame, window: int, per_language: int, most: int) -> Sample:
    """A bounded sample of rows: up to ``per_language`` a language and ``most``
    in all, chosen by the hash of ``doc_id``; of rows that share an id each
    text once, those of smallest hash first. The chosen texts are whole. With
    more languages than ``most`` the last in order are never learned."""
    ids = docs.where("lang IS NOT NULL AND doc_id IS NOT NULL AND octet_length(text) > 0")
    ids = ids.select("doc_id", "lang", F.xxhash64("text").alias("h"), F.pmod(F.hash("doc_id"), F.lit(SALTS)).alias("salt"))
    order = [F.xxhash64("doc_id"), "doc_id", "h"]
    for by in (["lang", "salt"], ["lang"]):  # no language meets in one task but its first few
        ids = ids.withColumn("n", F.row_number().over(Window.partitionBy(*by).orderBy(*order))).where(F.col("n") <= per_language)
    got = smallest(ids.select("n", "lang", "doc_id", "h"), most, "n", "lang", "doc_id", "h")
    # At most ``most`` rows; the texts come a partition at a time.
    keys = docs.sparkSession.createDataFrame([(r["doc_id"], r["lang"], r["h"]) for r in got], docs.select("doc_id", "lang", F.lit(0).cast("long").alias("h")).schema)
    chosen = docs.select("doc_id", "lang", F.xxhash64("text").alias("h"), F.encode("text", "utf-8").alias("raw")).join(F.broadcast(keys.distinct()), ["doc_id", "lang", "h"])
    texts = {(r["lang"], r["doc_id"], r["h"]): bytes(r["raw"]) for r in chosen.toLocalIterator()}
    languages = sorted({k[0] for k in texts})
    cut = [_windows(texts[k], window) for k in sorted(texts)]
    starts = np.cumsum([0, *map(len, cut)])
    windows = np.concatenate(cut) if cut else np.empty((0, window), np.uint8)
    return Sample(windows, starts, np.array([languages.index(k[0]) for k in sorted(texts)], np.int64), languages)


def document_probs(net: Network, texts: list[bytes], window: int, batch: int = 2048) -> tuple[np.ndarray, np.ndarray]:
    """Per text: the sums over its positions of the probabilities, and the
    number of positions labelled with each language."""
    n = len(net.languages)
    sums, counts = np.zeros((len(texts), n)), np.zeros((len(texts), n), np.int64)
    sizes = np.fromiter(map(len, texts), np.int64, len(texts))
    rows = -(-sizes // window)
    flat = np.full(int(rows.sum()) * window, PAD, np.uint8)
    at = 0
    for t, r in zip(texts, rows.tolist(), strict=True):
        flat[at : at + len(t)] = np.frombuffer(t, np.uint8)
        at += r * window
    windows, owner = flat.reshape(-1, window), np.repeat(np.arange(len(texts)), rows)
    for i in range(0, len(windows), batch):
        part = windows[i : i + batch]
        p = label_positions(net, part)
        valid = part.T != PAD
        best = p.argmax(axis=1)
        p *= valid[:, None]
        np.add.at(sums, owner[i : i + batch], p.sum(axis=0).T)
        for k in range(n):
            np.add.at(counts[:, k], owner[i : i + batch], ((best == k) & valid).sum(axis=0))
    return sums, counts


def fit(docs: DataFrame, window: int = 64, per_language: int = 768, most: int = 8192, **how) -> Network | None:
    """The network learned from the rows of ``docs`` (doc_id, text, lang) with
    a language; None if there is none. See ``training_sample`` for the bound."""
    sample = training_sample(docs, window, per_language, most)
    return train(sample, **how) if sample.languages else None


def _pooled(net: Network | None, texts: pa.Array, lettered: pa.Array, window: int) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
    """Per row: index of the label (-1: none), its mean probability and the
    number of positions of each label."""
    n = len(net.languages) if net else 0
    label, score, counts = np.full(len(texts), -1), np.zeros(len(texts)), np.zeros((len(texts), n), np.int64)
    if net:
        ok = lettered.to_numpy(zero_copy_only=False).astype(bool)
        raw = [t.as_py() if x else b"" for t, x in zip(texts.cast(pa.binary()), ok, strict=True)]
        sums, counts = document_probs(net, raw, window)
        size = np.fromiter(map(len, raw), np.int64, len(raw))
        label = np.where(size > 0, sums.argmax(axis=1), -1)
        score = np.where(size > 0, sums.max(axis=1) / np.maximum(size, 1), 0.0).clip(0, 1)
    return label, score, counts


def _lettered() -> Column:
    return F.coalesce(F.col("text").rlike(r"\p{L}"), F.lit(False))


def identify(docs: DataFrame, net: Network | None, window: int = 128) -> DataFrame:
    """``doc_id, lang_pred, score, languages, positions`` per row of
    ``docs``: the pooled label and its mean probability, and how many positions
    (bytes) got the label of each of ``languages``.

    A text that is null or has no letter is ``und`` with score 0, as is
    everything without a network. Texts are read whole. Only ``doc_id`` and
    ``text`` are read."""
    languages = net.languages if net else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            label, scores, counts = _pooled(net, b.column(1), b.column(2), window)
            labels = [UNKNOWN if k < 0 else languages[k] for k in label.tolist()]
            yield pa.RecordBatch.from_arrays(
                [b.column(0), pa.array(labels, pa.string()), pa.array(scores), pa.array(counts.tolist(), pa.list_(pa.int64()))],
                ["doc_id", "lang_pred", "score", "positions"],
            )

    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", _lettered().alias("lettered"))
    out = arrow_rows(rows, run, "doc_id long, lang_pred string, score double, positions array<long>")
    return out.withColumn("languages", F.array(*map(F.lit, languages)).cast("array<string>"))


def keep_identified(docs: DataFrame, net: Network | None, min_score: float = 0.0, window: int = 128, into: str | None = None) -> DataFrame:
    """The rows of ``docs`` that get a language; ``und`` goes, as do those whose
    mean probability is under ``min_score``. The text column ``into`` (None: no
    column) takes the language; all others are as they are."""
    languages = net.languages if net else []

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in sliced(batches):
            label, score, _ = _pooled(net, b.column(b.schema.get_field_index("text")), b.column(b.num_columns - 1), window)
            ok = (label >= 0) & (score >= min_score)
            kept = b.filter(pa.array(ok)).select(range(b.num_columns - 1))
            cols = kept.columns
            if into is not None:
                cols[kept.schema.get_field_index(into)] = pa.array([languages[k] for k in label[ok].tolist()], pa.string())
            yield pa.RecordBatch.from_arrays(cols, kept.schema.names)

    rows = docs.select("*", _lettered().alias("__lettered"))
    return arrow_rows(rows, run, docs.schema)


def learn_and_identify(docs: DataFrame, parts: int = 4, held: int = 2, **how) -> DataFrame:
    """``identify`` with a network learned from the rows whose fold (crc32 of
    the id modulo ``parts``) is not ``held``; adds ``held_out``."""
    out_of = fold(F.col("doc_id"), parts) == held
    found = identify(docs, fit(docs.where(~out_of).select("doc_id", "text", "lang"), **how))
    return found.withColumn("held_out", out_of)
