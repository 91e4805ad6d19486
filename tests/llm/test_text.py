"""BPE, language ID and the language model."""

import hashlib
import math
import random
from collections import Counter, defaultdict

import duckdb
import numpy as np
import public_tokenizers
import pytest
from cases import SF, empty, fold, lower, messy, messy_rows
from hypothesis import given, settings
from hypothesis import strategies as st
from pyspark.sql import functions as F
from tokenizers import Tokenizer

from boardwalk.llm import bpe, langid, lm, queries

PATH = public_tokenizers.path("byte_bpe_50k.json")


@pytest.fixture(scope="module")
def codec():
    with open(PATH, "rb") as f:
        return bpe.Codec(f.read())


@pytest.fixture(scope="module")
def library():
    return Tokenizer.from_file(PATH)


def _ids(codec, text):
    return [i for part in codec.encode(text) for i in part]


# --- BPE ---------------------------------------------------------------------


def _digests(library, text):
    ids = library.encode(text or "", add_special_tokens=False).ids
    sha = lambda s: hashlib.sha256(s.encode()).hexdigest()
    return len(ids), sha(",".join(map(str, ids))), sha(library.decode(ids, skip_special_tokens=False))


def test_bpe_query_against_the_library(spark, library):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    got = queries.op3_bpe(spark, SF).collect()
    assert Counter(map(tuple, got)) == Counter((i, *_digests(library, t)) for i, t in docs)


def test_bpe_messy_and_empty(spark, library):
    got = bpe.tokenized(messy(spark), PATH, with_ids=True).collect()
    assert Counter(tuple(r)[:4] for r in got) == Counter((r[0], *_digests(library, r[1])) for r in messy_rows())
    assert all(len(r.ids) == r.n_tokens for r in got)
    assert bpe.tokenized(empty(spark), PATH).collect() == []


@settings(max_examples=150, deadline=None)
@given(st.text(st.one_of(st.sampled_from("aeht n\n'.ls7é中\U0001f600\x00\x85 "), st.characters(exclude_categories=["Cs"])), max_size=120))
def test_bpe_any_text(codec, library, text):
    ids = _ids(codec, text)
    assert ids == library.encode(text, add_special_tokens=False).ids
    d = bpe.Decoder(codec)
    assert "".join(d.feed([i]) for i in ids) + d.close() == library.decode(ids, skip_special_tokens=False)


def test_bpe_special_token_long_pieces_and_slices(codec, library, monkeypatch):
    monkeypatch.setattr(bpe, "SLICE", 50)
    rng = random.Random(1)
    letters = "".join(rng.choice("etaoinshrdlu") for _ in range(4000))
    for text in ("<|endoftext|>", "a<|endoftext|> b<|endoftext|>", letters, "=" * 3000, " " * 2500 + "x", (letters[:30] + "  \n ") * 40):
        assert _ids(codec, text) == library.encode(text, add_special_tokens=False).ids


def test_bpe_stream_holds_no_more_than_the_lookahead(codec):
    rng = random.Random(2)
    data = "".join(rng.choice("etaoinshrdlu") for _ in range(5000)).encode()
    whole = codec._merged(data)
    for step in (1, 7, 64):
        read = 0

        def steps(step=step):
            nonlocal read
            for i in range(0, len(data), step):
                read = i + len(data[i : i + step])
                yield data[i : i + step]

        out, end, widest = [], 0, 0
        for t in codec.stream(steps()):
            out.append(t)
            end += len(codec.bytes_of[t])
            if read < len(data):
                assert read - end >= codec.lookahead
                widest = max(widest, read - end)
        assert out == whole
        assert widest <= codec.lookahead + step + max(map(len, codec.bytes_of))


def test_sufficient_lookahead_of_small_lists():
    # One merge: a token changes with the next byte only.
    assert bpe.sufficient_lookahead([(0, 1, 2)], [1, 1, 2]) == 1
    # (b c) before (a b): whether a joins b hangs on the c after it.
    assert bpe.sufficient_lookahead([(1, 2, 3), (0, 1, 4)], [1, 1, 1, 2, 2]) == 2
    assert bpe.sufficient_lookahead([], [1]) == 0


def test_decoder_holds_back_unfinished_sequences(codec):
    one = codec.one
    for data in ("é中😀x".encode(), b"\xe4\xb8", b"\xf0\x9f\x98A\xe4\xb8\xad", b"\xff\xc3(\x80\x80", b"\xe0\x80\xaf\xed\xa0\x80"):
        d = bpe.Decoder(codec)
        parts = [d.feed([one[b]]) for b in data]
        assert len(d.held) <= 3
        assert "".join(parts) + d.close() == data.decode("utf-8", "replace")


# --- language ID ----------------------------------------------------------------


def test_langid_gradients():
    rng = np.random.default_rng(0)
    windows = rng.integers(97, 123, (6, 9)).astype(np.uint8)
    windows[0, 5:] = langid.PAD
    labels = np.array([0, 1, 2, 0, 1, 2])
    net = langid.new_network(["a", "b", "c"], 4, 1)
    _, grads = langid.gradients(net, windows, labels)
    for a, g in zip(net.arrays(), grads, strict=True):
        at = np.unravel_index(np.abs(g).argmax(), g.shape)
        old, losses = a[at], []
        for d in (1e-2, -1e-2):
            a[at] = old + d
            losses.append(langid.gradients(net, windows, labels)[0])
        a[at] = old
        assert abs((losses[0] - losses[1]) / 2e-2 - g[at]) < 1e-3 + 0.02 * abs(g[at])


def test_langid_labels_every_position_alike_in_any_batch():
    net = langid.new_network(["a", "b"], 4, 1)
    texts = [b"", b"abc", b"x" * 300, "é".encode() * 65]
    sums, counts = langid.document_probs(net, texts, 64)
    assert counts.sum(axis=1).tolist() == [len(t) for t in texts]
    assert np.allclose(sums.sum(axis=1), [len(t) for t in texts], atol=1e-3)
    again, _ = langid.document_probs(net, texts, 64, batch=2)
    assert np.allclose(sums, again, atol=1e-4)


def test_langid_query_held_out_accuracy(spark):
    truth = dict(duckdb.sql(f"SELECT doc_id, lang FROM '{SF}/documents.parquet'").fetchall())
    got = queries.op2_language_id(spark, SF).collect()
    assert len(got) == len(truth)
    held = [r for r in got if r.held_out]
    assert {r.doc_id for r in held} == {i for i in truth if fold(i, 4) == 2}
    assert np.mean([r.lang_pred == truth[r.doc_id] for r in held]) > 0.9
    assert all(0 <= r.score <= 1 for r in got)


def test_langid_messy_and_empty(spark):
    got = {(r.doc_id, r.lang_pred == langid.UNKNOWN, r.score > 0) for r in langid.learn_and_identify(messy(spark), rounds=5).collect()}
    assert {(4, True, False), (5, True, False), (6, True, False), (7, True, False), (8, False, True), (10, False, True)} <= got
    assert langid.learn_and_identify(empty(spark)).collect() == []
    unlabelled = messy(spark).selectExpr("doc_id", "text", "cast(null AS string) AS lang")
    assert {r.lang_pred for r in langid.learn_and_identify(unlabelled).collect()} <= {langid.UNKNOWN}
    net = langid.new_network(["a", "b"], 4, 1)
    kept = langid.keep_identified(messy(spark), net, 0.0)
    assert kept.columns == messy(spark).columns
    lettered = [r for r in messy_rows() if r[1] and any(c.isalpha() for c in r[1])]
    assert Counter((r.doc_id, r.text) for r in kept.collect()) == Counter(r[:2] for r in lettered)


# --- language model ---------------------------------------------------------------


class _Ppm:
    """Symbol by symbol, with the counts in dictionaries."""

    def __init__(self, texts):
        self.counts = [defaultdict(Counter) for _ in range(lm.ORDER + 1)]
        for t in texts:
            s = bytes([lm.START]) * lm.ORDER + t + bytes([lm.END])
            for i in range(lm.ORDER, len(s)):
                for k in range(lm.ORDER + 1):
                    self.counts[k][s[i - k : i]][s[i]] += 1

    def prob(self, context, symbol):
        p, excluded = 1.0, set()
        for k in range(lm.ORDER, -1, -1):
            seen = {b: n for b, n in self.counts[k][context[lm.ORDER - k :]].items() if b not in excluded}
            if not seen:
                continue
            total, kinds = sum(seen.values()), len(seen)
            if symbol in seen:
                return p * seen[symbol] / (total + kinds)
            p *= kinds / (total + kinds)
            excluded |= set(seen)
        return p / (256 - len(excluded))

    def score(self, t):
        s = bytes([lm.START]) * lm.ORDER + t + bytes([lm.END])
        return sum(math.log10(self.prob(s[i - lm.ORDER : i], s[i])) for i in range(lm.ORDER, len(s)))


def _brute(rows):
    texts = [lower(t or "").encode() for _, t in rows]
    learn = [t for (i, _), t in zip(rows, texts, strict=True) if fold(i, 7) != 2]
    counts = Counter(w for t in learn for w in [*t.split(), None])
    n, v, model = sum(counts.values()), len(counts), _Ppm(learn)
    out = []
    for (i, _), t in zip(rows, texts, strict=True):
        toks = [*t.split(), None]
        base = sum(math.log10((counts[w] + 1) / (n + v + 1)) for w in toks)
        out.append((i, fold(i, 7) == 2, len(toks), sum(counts[w] > 0 for w in toks), n, base, model.score(t)))
    return out


def _same(got, want):
    key = lambda r: (r[0] is not None, r[0] or 0, r[2], r[5])
    got, want = sorted(got, key=key), sorted(want, key=key)
    assert [r[:5] for r in got] == [r[:5] for r in want]
    assert np.allclose([r[5:] for r in got], [r[5:] for r in want], rtol=1e-9)


NAMES = ["doc_id", "held_out", "n_tokens", "n_known", "train_tokens", "base_score", "score"]


@pytest.mark.parametrize("block_bytes", [1 << 24, 4000])
def test_lm_messy_against_brute_force(spark, block_bytes):
    got = lm.held_out_scores(messy(spark), block_bytes=block_bytes).select(*NAMES)
    _same([tuple(r) for r in got.collect()], _brute([r[:2] for r in messy_rows()]))


def test_lm_query_against_brute_force(spark):
    docs = duckdb.sql(f"SELECT doc_id, text FROM '{SF}/documents.parquet'").fetchall()
    _same([tuple(r) for r in queries.op8_lm_score(spark, SF).select(*NAMES).collect()], _brute(docs))


def test_lm_probabilities_sum_to_one():
    model = _Ppm([b"abracadabra", b"abba"])
    for context in (b"\xfe" * 4, b"abra", b"zzzz", b"zbra", b"cada"):
        assert abs(sum(model.prob(context, b) for b in range(256)) - 1) < 1e-9


def test_lm_without_rows_or_training(spark):
    assert lm.held_out_scores(empty(spark)).collect() == []
    got = lm.scores(messy(spark).where("doc_id = 10"), F.lit(False)).first()
    assert (got.n_tokens, got.n_known, got.train_tokens) == (2, 0, 0)
    assert abs(got.score + 4 * math.log10(256)) < 1e-9 and got.base_score == 0


@pytest.mark.parametrize("fan", [2, 64])
def test_lm_tree_of_totals_and_hot_rows(spark, monkeypatch, fan):
    """A third of all rows equal, many blocks: scores as ever, dictionary rows
    in proportion to the blocks, no block with more than its share."""
    monkeypatch.setattr(lm, "FAN", fan)
    monkeypatch.setattr(lm, "PARTS", 3)
    monkeypatch.setattr(lm, "MOST_PARTS", 3)
    rows = [r[:2] for r in messy_rows()] + [(77, "the same text again and again")] * 60 + [(100 + i, f"text {i} of many {i % 7}") for i in range(100)]
    docs = spark.createDataFrame(rows, "doc_id long, text string").repartition(4)
    seen, real = [], lm.settled

    def noted(df):
        out = real(df)
        seen.append(out)
        return out

    monkeypatch.setattr(lm, "settled", noted)
    got = lm.held_out_scores(docs, block_bytes=3000, block_rows=10).select(*NAMES)
    _same([tuple(r) for r in got.collect()], _brute(rows))
    dicts = next(d for d in seen if d.columns[:3] == ["part", "block", "kind"])
    blocks = dicts.select("block").distinct().count()
    assert blocks > 12 and dicts.count() <= 2 * 3 * blocks
    placed, hot = lm._rows(docs, F.lit(True), 750, 2)
    assert hot and placed.where("doc_id = 77").select("times").collect() == [(60,)]
    assert placed.agg(F.sum("times")).first()[0] == len(rows)


def test_lm_table():
    rng = np.random.default_rng(1)
    keys = np.unique(rng.integers(0, 2**63, 5000).astype(np.uint64))
    table = lm.Table(np.append(np.uint64(0), keys), np.append(-1.0, np.arange(len(keys))))
    ask = rng.permutation(len(keys))
    assert (table.get(keys[ask]) == ask).all() and table.get(np.zeros(3, np.uint64)).tolist() == [-1] * 3
