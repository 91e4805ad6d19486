"""Byte-level BPE as a streaming transducer, and its incremental decoder.

Encoding. A merge list has a sufficient lookahead L, computed here from the
list alone: whatever follows, the tokens that end at least L bytes before the
end of what has been read are those of the finished text. So a piece is read
in steps, merged with what is still open, and every token that has become
stable is emitted; only the open tail (L bytes and a token) is kept. Since a
stable boundary is never merged over, what follows it can be merged without
what precedes.

Why L holds: let reading go on, and compare the merges of the text so far with
those of the longer text, in merge order. The first merge that only one of
them has joins a token u left of the end to one that starts there; from then
on they differ from the start of u. Whenever a later merge (u', v') carries
the difference further left, by len(u'), v' starts with the u before, and its
rank is higher. So the difference moves left by at most the largest sum of
len(u) over such a chain of merges, which one pass over the list finds.

Decoding. Token bytes run through a state machine that holds back the at most
three bytes of an unfinished UTF-8 sequence; malformed bytes become U+FFFD.

Pieces are what the tokenizer's pattern splits off; ids of short pieces are
remembered in a table of bounded size.
"""

from __future__ import annotations

import hashlib
import json
from collections.abc import Iterator
from itertools import chain, islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardwalk.llm.common import arrow_rows, sliced

# Fixed value: the pattern of the byte-level pre-tokenizer.
PATTERN = r"""'s|'t|'re|'ve|'m|'ll|'d| ?\p{L}+| ?\p{N}+| ?[^\s\p{L}\p{N}]+|\s+(?!\S)|\s+"""

#: Longer texts are split a number of pieces at a time; longer pieces give their
#: tokens as they become stable.
SLICE, PIECES = 1 << 20, 1 << 16
#: Pieces up to this length are remembered, at most so many twice over.
SHORT, REMEMBERED = 48, 1 << 17


def _byte_letters() -> dict[str, int]:
    """The letters that stand for bytes in the vocabulary: printable Latin-1
    for itself, the others for code points from 256 on, in order."""
    own = [*range(0x21, 0x7F), *range(0xA1, 0xAD), *range(0xAE, 0x100)]
    rest = [b for b in range(256) if b not in set(own)]
    return {chr(b): b for b in own} | {chr(256 + i): b for i, b in enumerate(rest)}


def sufficient_lookahead(rules: list[tuple[int, int, int]], size: list[int]) -> int:
    """Bytes after which a token can no longer change. ``rules``: (left,
    right, merged) ids by rank; ``size``: bytes of each token.

    reach[t]: the most that a chain of the rules so far moves a difference to
    the left, if its last rule has t on the left."""
    left = {m: a for a, _, m in rules}
    reach: dict[int, int] = {}
    for a, b, _ in rules:
        far, t = 0, b
        while t is not None:  # the tokens that b starts with, down to a byte
            far = max(far, reach.get(t, 0))
            t = left.get(t)
        reach[a] = max(reach.get(a, 0), size[a] + far)
    return max(reach.values(), default=0)


class Remembered(dict):
    """Ids by piece. When full, the table becomes the older half and entries
    move back as they are used again."""

    def __init__(self, codec: Codec, limit: int = REMEMBERED):
        super().__init__()
        self.codec, self.limit, self.older = codec, limit, {}

    def __missing__(self, piece: str) -> list[int]:
        ids = self.older.get(piece)
        if ids is None:
            ids = self.codec.encode_piece(piece.encode("utf-8", "replace"))
        if len(piece) <= SHORT:
            if len(self) >= self.limit:
                self.older = dict(self)
                self.clear()
            self[piece] = ids
        return ids


class Codec:
    def __init__(self, spec: bytes):
        import regex

        j = json.loads(spec)
        vocab, merges = j["model"]["vocab"], j["model"]["merges"]
        letters = _byte_letters()
        self.special = {t["content"]: t["id"] for t in j.get("added_tokens") or []}
        self.bytes_of = [b""] * (1 + max([*vocab.values(), *self.special.values()]))
        for token, i in vocab.items():
            if token not in self.special:
                self.bytes_of[i] = bytes(letters[c] for c in token)
        for token, i in self.special.items():
            self.bytes_of[i] = token.encode()
        self.id_text = [str(i) for i in range(len(self.bytes_of))]
        pairs = [m.split(" ") if isinstance(m, str) else m for m in merges]
        self.rules = [(vocab[a], vocab[b], vocab[a + b]) for a, b in pairs]
        self.rank = {(a, b): r for r, (a, b, _) in enumerate(self.rules)}
        made = {m: r for r, (_, _, m) in enumerate(self.rules)}
        if any(max(made.get(a, -1), made.get(b, -1)) >= r for r, (a, b, _) in enumerate(self.rules)):
            raise ValueError("a merge uses a token that a later merge makes")
        one = [0] * 256
        for letter, b in letters.items():
            one[b] = vocab[letter]
        self.one = one
        self.lookahead = sufficient_lookahead(self.rules, [len(b) for b in self.bytes_of])
        self.pieces = regex.compile(PATTERN).findall
        self.matches = regex.compile(PATTERN).finditer
        specials = "|".join(regex.escape(t) for t in sorted(self.special, key=len, reverse=True))
        self.split = regex.compile(f"({specials})").split if specials else lambda t: [t]
        self.known = Remembered(self)

    def _merged(self, data: bytes) -> list[int]:
        """Tokens of ``data`` on its own: lowest rank first, leftmost first."""
        ids = [self.one[b] for b in data]
        rank, none = self.rank.get, len(self.rules)
        ranks = [rank(p, none) for p in zip(ids, ids[1:])]  # noqa: B905
        while ranks:
            best = min(ranks)
            if best == none:
                break
            k = ranks.index(best)
            ids[k : k + 2] = [self.rules[best][2]]
            del ranks[k]
            if k < len(ranks):
                ranks[k] = rank((ids[k], ids[k + 1]), none)
            if k:
                ranks[k - 1] = rank((ids[k - 1], ids[k]), none)
        return ids

    def stream(self, steps: Iterator[bytes]) -> Iterator[int]:
        """Tokens of the piece that ``steps`` make up, each as soon as it is
        stable; keeps no more than the lookahead, a token and a step."""
        held = b""
        for step in steps:
            held += step
            if len(held) <= self.lookahead:
                continue
            end, stable = 0, len(held) - self.lookahead
            for t in self._merged(held):
                if end + len(self.bytes_of[t]) > stable:
                    break
                end += len(self.bytes_of[t])
                yield t
            held = held[end:]
        yield from self._merged(held)

    def encode_piece(self, data: bytes) -> list[int]:
        if len(data) <= 2 * self.lookahead:
            return self._merged(data)
        n = self.lookahead
        return list(self.stream(data[i : i + n] for i in range(0, len(data), n)))

    def _long(self, text: str) -> Iterator[list[int]]:
        """Ids of a long text: a bounded number of pieces at a time, and of a
        long piece a bounded number of tokens."""
        matches = self.matches(text)
        while some := [m.group() for m in islice(matches, PIECES)]:
            ids: list[int] = []
            for piece in some:
                if len(piece) <= SLICE:
                    ids += self.known[piece]
                    continue
                yield ids
                n, data = self.lookahead, piece.encode("utf-8", "replace")
                tokens = self.stream(data[i : i + n] for i in range(0, len(data), n))
                while ids := list(islice(tokens, PIECES)):
                    yield ids
            yield ids

    def encode(self, text: str) -> Iterator[list[int]]:
        """Ids of a text, a bounded part at a time."""
        for i, part in enumerate(self.split(text)):
            if i % 2:
                yield [self.special[part]]
            elif len(part) > SLICE:
                yield from self._long(part)
            elif part:
                yield list(chain.from_iterable(map(self.known.__getitem__, self.pieces(part))))


class Decoder:
    """Bytes in, text out; holds back an unfinished sequence."""

    def __init__(self, codec: Codec):
        self.of, self.held = codec.bytes_of, b""

    @staticmethod
    def _open(data: bytes) -> int:
        """Length of the unfinished sequence that ``data`` ends with."""
        for k in range(1, min(3, len(data)) + 1):
            b = data[-k]
            if b < 0x80:
                return 0
            if b >= 0xC0:
                return k if k < (2 if b < 0xE0 else 3 if b < 0xF0 else 4) else 0
        return 0

    def feed(self, ids: list[int]) -> str:
        data = self.held + b"".join(map(self.of.__getitem__, ids))
        n = self._open(data)
        self.held = data[len(data) - n :]
        return data[: len(data) - n].decode("utf-8", "replace")

    def close(self) -> str:
        rest, self.held = self.held.decode("utf-8", "replace"), b""
        return rest


_codecs: dict[bytes, Codec] = {}


def codec(spec: bytes) -> Codec:
    """The codec of a tokenizer file, built once per Python process."""
    key = hashlib.sha256(spec).digest()
    if key not in _codecs:
        _codecs.clear()
        _codecs[key] = Codec(spec)
    return _codecs[key]


def tokenized(docs: DataFrame, path: str, with_ids: bool = False, also: tuple[str, ...] = ()) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` per row of ``docs``
    (and ``ids`` if asked for): the whole text encoded with the tokenizer file
    at ``path``, and the text decoded from those ids.

    The file is read by the driver and sent to executors (its size does not
    depend on the data). A null text is an empty one; an empty text has no
    ids; ``doc_id`` is passed on as it is, as are the columns ``also``, which
    come last. Other columns are not read."""
    spark = docs.sparkSession
    with open(path, "rb") as f:
        spec = spark.sparkContext.broadcast(f.read())

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        c = codec(spec.value)
        for b in sliced(batches, 128):
            n, ids_sha, text_sha, all_ids = [], [], [], []
            for text in b.column(1):
                count, seen, back, decoder, kept = 0, hashlib.sha256(), hashlib.sha256(), Decoder(c), []
                for ids in c.encode(text.as_py() or ""):
                    if count and ids:
                        seen.update(b",")
                    seen.update(",".join(map(c.id_text.__getitem__, ids)).encode())
                    back.update(decoder.feed(ids).encode())
                    count += len(ids)
                    if with_ids:
                        kept.append(np.array(ids, np.int32))
                back.update(decoder.close().encode())
                n.append(count)
                ids_sha.append(seen.hexdigest())
                text_sha.append(back.hexdigest())
                all_ids += kept
            cols = [b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                cols, names = [*cols, pa.ListArray.from_arrays(pa.array(np.cumsum([0, *n]), pa.int32()), pa.array(np.concatenate([*all_ids, np.empty(0, np.int32)])))], [*names, "ids"]
            yield pa.RecordBatch.from_arrays([*cols, *b.columns[2:]], [*names, *also])

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    rows = docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text", *also)
    return arrow_rows(rows, run, schema + "".join(f", {c} {rows.schema[c].dataType.simpleString()}" for c in also))
