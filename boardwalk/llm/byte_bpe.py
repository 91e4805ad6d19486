"""Byte-level BPE over rank files, by matrices of pieces.

A text is split by the pattern; every match is merged on its own: a match that
is a token is that token, any other starts as its bytes and joins, again and
again, its leftmost pair of least rank, until no pair is a token. The rank of
a pair is that of its joined bytes, which is also the joined token's id.

Pieces not met before are merged together, a matrix of token ids per bucket of
lengths, a piece per row, padded on the right. Each round looks up the ranks
of new pairs in a hash table of (left, right) ids, joins each row's leftmost
least pair and closes the gap. Rows without a pair left go, so all others lose
one token a round and the matrix one column. A piece of more than ``WIDE``
bytes is a matrix of its own: one row cut into stretches, with the least rank
kept per stretch, so that a round costs a stretch and not the piece.

Decoding gathers the bytes of all ids of a part at once.
"""

from __future__ import annotations

import base64
import hashlib
from collections.abc import Iterable, Iterator
from itertools import islice

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardwalk.llm.common import arrow_rows, sliced

#: Characters of a short text, also the pieces of a longer one that are looked
#: at together; characters of short texts that are; bytes of a piece up to which
#: it shares a matrix, and of a longer one's stretches.
PART, TOGETHER, WIDE, STRETCH = 1 << 16, 1 << 20, 512, 256
#: Pieces up to this length are remembered, so many at most.
SHORT, REMEMBERED = 64, 1 << 18

_MIX = np.uint64(0x9E3779B97F4A7C15)


def read_ranks(spec: bytes) -> dict[bytes, int]:
    """Tokens and ranks of a rank file: base64 and a number per line."""
    return {base64.b64decode(a): int(b) for a, b in (line.split() for line in spec.splitlines() if line)}


class PairTable:
    """(left, right) -> joined id, open addressing in three numpy arrays."""

    def __init__(self, pairs: np.ndarray, joined: np.ndarray):
        bits = max(4, int(np.ceil(np.log2(2 * max(len(pairs), 1)))))
        self.shift, self.mask = np.uint64(64 - bits), (1 << bits) - 1
        self.keys = np.full(1 << bits, -1, np.int64)
        self.vals = np.zeros(1 << bits, np.int64)
        at, left = self._slot(pairs), np.arange(len(pairs))
        self.probes = 0
        while len(left):  # of those that want a free slot, one gets it
            self.probes += 1
            slot = at[left]
            free = left[self.keys[slot] == -1]
            self.keys[at[free]] = pairs[free]
            self.vals[at[free]] = joined[free]
            left = left[self.keys[slot] != pairs[left]]
            at[left] = (at[left] + 1) & self.mask
        # Two that wanted one slot wrote both arrays; make sure they agree.
        self.vals[self._find(pairs)] = joined

    def _slot(self, pairs: np.ndarray) -> np.ndarray:
        return ((pairs.astype(np.uint64) * _MIX) >> self.shift).astype(np.int64)

    def _find(self, pairs: np.ndarray) -> np.ndarray:
        """Slot of each pair; that of a pair not in the table holds another key."""
        at = self._slot(pairs)
        open_ = np.flatnonzero((self.keys[at] != pairs) & (self.keys[at] != -1))
        for _ in range(self.probes):
            if not len(open_):
                break
            at[open_] = (at[open_] + 1) & self.mask
            key = self.keys[at[open_]]
            open_ = open_[(key != pairs[open_]) & (key != -1)]
        return at

    def ranks(self, left: np.ndarray, right: np.ndarray, none: int) -> np.ndarray:
        """Rank (and id) of each joined pair, ``none`` where it is no token."""
        pairs = ((left << 32) | right).ravel()
        at = self._find(pairs)
        return np.where(self.keys[at] == pairs, self.vals[at], none).reshape(left.shape)


class Ranks:
    """Encoder and decoder of one rank file. Every byte must be a token."""

    def __init__(self, spec: bytes, pattern: str):
        import regex

        rank = read_ranks(spec)
        missing = [b for b in range(256) if bytes([b]) not in rank]
        if missing:
            raise ValueError(f"bytes without a token: {missing}")
        self.rank, self.none = rank, 1 + max(rank.values())
        self.one = np.array([rank[bytes([b])] for b in range(256)], np.int64)
        # Bytes of all tokens in id order, for decoding.
        by_id: list[bytes] = [b""] * self.none
        for token, i in rank.items():
            by_id[i] = token
        self.size = np.array([len(t) for t in by_id], np.int64)
        self.start = np.concatenate(([0], np.cumsum(self.size)))
        self.bytes = np.frombuffer(b"".join(by_id), np.uint8)
        get = rank.get
        cuts = ((get(t[:k]), get(t[k:]), i) for t, i in rank.items() for k in range(1, len(t)))
        whole = np.array([c for c in cuts if c[0] is not None and c[1] is not None], np.int64).reshape(-1, 3)
        self.pairs = PairTable((whole[:, 0] << 32) | whole[:, 1], whole[:, 2])
        self.matches = regex.compile(pattern).finditer
        self.findall = regex.compile(pattern).findall
        self.known: dict[str, bytes] = {}

    # -- merging ------------------------------------------------------------------
    def _merge_rows(self, rows: list[bytes]) -> list[np.ndarray]:
        """Ids of each piece; all fit one matrix of the longest one's width."""
        n, size = len(rows), np.fromiter(map(len, rows), np.int64, len(rows))
        width = int(size.max())
        raw = np.frombuffer(b"".join(r.ljust(width, b"\0") for r in rows), np.uint8).reshape(n, width)
        ids = self.one[raw]
        out: list[np.ndarray] = [np.empty(0, np.int64)] * n
        at = np.arange(n)  # the piece of each row that is left
        ranks = self.pairs.ranks(ids[:, :-1], ids[:, 1:], self.none)
        ranks[np.arange(width - 1) >= size[:, None] - 1] = self.none
        while True:
            k = ranks.argmin(axis=1) if ranks.shape[1] else np.zeros(len(at), np.int64)
            least = ranks[np.arange(len(at)), k] if ranks.shape[1] else np.full(len(at), self.none)
            going = least < self.none
            for r in np.flatnonzero(~going):
                out[at[r]] = ids[r, : size[r]].copy()
            if not going.any():
                return out
            if not going.all():
                ids, ranks, at, size, k, least = ids[going], ranks[going], at[going], size[going], k[going], least[going]
            row = np.arange(len(at))
            ids[row, k] = least
            col = np.arange(ids.shape[1] - 1)
            ids = np.take_along_axis(ids, col + (col > k[:, None]), axis=1)
            col = np.arange(ranks.shape[1] - 1)
            ranks = np.take_along_axis(ranks, col + (col >= k[:, None]), axis=1)
            size = size - 1
            # Two pairs are new: the joined token with either neighbour.
            for side in (-1, 0):
                r = np.flatnonzero((k + side >= 0) & (k + side < size - 1))
                c = k[r] + side
                ranks[r, c] = self.pairs.ranks(ids[r, c], ids[r, c + 1], self.none)

    def _merge_long(self, piece: bytes) -> np.ndarray:
        """Ids of a long piece. Tokens keep their places; ``after`` and
        ``before`` lead over places that were joined away."""
        n = -(-len(piece) // STRETCH) * STRETCH
        ids = np.zeros(n, np.int64)
        ids[: len(piece)] = self.one[np.frombuffer(piece, np.uint8)]
        ranks = np.full(n, self.none, np.int64)
        end = len(piece)
        ranks[: end - 1] = self.pairs.ranks(ids[: end - 1], ids[1:end], self.none)
        grid, none = ranks.reshape(-1, STRETCH), self.none
        low = grid.min(axis=1)
        after, before = np.arange(1, n + 1), np.arange(-1, n - 1)
        joined = np.zeros(n, bool)
        joined[end:] = True
        known: dict[tuple[int, int], int] = {}

        def pair(a: int, b: int) -> int:
            if (a, b) not in known:
                known[a, b] = int(self.pairs.ranks(np.array([a]), np.array([b]), none)[0])
            return known[a, b]

        while True:
            s = int(low.argmin())
            if low[s] == none:
                return ids[~joined]
            i = s * STRETCH + int(grid[s].argmin())
            j = int(after[i])
            ids[i] = ranks[i]
            joined[j], ranks[j] = True, none
            k, h = int(after[j]), int(before[i])
            after[i] = k
            ranks[i] = pair(int(ids[i]), int(ids[k])) if k < end else none
            if k < end:
                before[k] = i
            if h >= 0:
                ranks[h] = pair(int(ids[h]), int(ids[i]))
            for t in {s, j // STRETCH, max(h, 0) // STRETCH}:
                low[t] = grid[t].min()

    def merged(self, pieces: list[bytes]) -> list[bytes]:
        """Ids of pieces, each on its own, as little-endian 32-bit numbers."""
        out: list[bytes] = [b""] * len(pieces)
        buckets: dict[int, list[int]] = {}
        for i, p in enumerate(pieces):
            whole = self.rank.get(p)
            if whole is not None:
                out[i] = whole.to_bytes(4, "little")
            elif len(p) > WIDE:
                out[i] = self._merge_long(p).astype("<u4").tobytes()
            else:  # widths 4, 8, 16, ...: a row is padded to twice its length at most
                buckets.setdefault(max(4, 1 << (len(p) - 1).bit_length()), []).append(i)
        for width, which in buckets.items():
            step = max(1, (1 << 20) // width)
            for k in range(0, len(which), step):
                some = which[k : k + step]
                for i, ids in zip(some, self._merge_rows([pieces[i] for i in some]), strict=True):
                    out[i] = ids.astype("<u4").tobytes()
        return out

    def _learn(self, pieces: set[str]) -> dict[str, bytes]:
        """Ids of all ``pieces``; new short ones are remembered."""
        new = [p for p in pieces if p not in self.known]
        found = dict(zip(new, self.merged([p.encode("utf-8", "replace") for p in new]), strict=True))
        if len(self.known) + len(found) > REMEMBERED:
            self.known = {}
            return dict(zip(pieces, self.merged([p.encode("utf-8", "replace") for p in pieces]), strict=True))
        self.known.update((p, ids) for p, ids in found.items() if len(p) <= SHORT)
        return self.known if all(len(p) <= SHORT for p in new) else self.known | found

    # -- texts --------------------------------------------------------------------
    def encode_all(self, texts: Iterable[str]) -> Iterator[Iterator[bytes]]:
        """For each text its ids, in parts, to be read in order. Short texts
        are learned together, so that their new pieces share matrices."""
        group: list[list[str]] = []
        chars = 0
        for t in texts:
            if len(t) > PART:
                yield from self._together(group)
                group, chars = [], 0
                yield (b"".join(map(self._learn(set(part)).__getitem__, part)) for part in self._parts(t))
                continue
            group.append(self.findall(t))
            chars += len(t)
            if chars > TOGETHER:
                yield from self._together(group)
                group, chars = [], 0
        yield from self._together(group)

    def _together(self, group: list[list[str]]) -> Iterator[Iterator[bytes]]:
        ids = self._learn(set().union(*group))
        for pieces in group:
            yield iter((b"".join(map(ids.__getitem__, pieces)),))

    def _parts(self, text: str) -> Iterator[list[str]]:
        """The pieces of a long text, a bounded number at a time."""
        it = self.matches(text)
        while part := [m.group() for m in islice(it, PART)]:
            yield part

    def decode(self, ids: np.ndarray) -> bytes:
        """The bytes of ids, one gather for all."""
        ids = np.asarray(ids, np.int64)
        size = self.size[ids]
        ends = np.cumsum(size)
        if not len(ids):
            return b""
        return self.bytes[np.repeat(self.start[ids] - ends + size, size) + np.arange(ends[-1])].tobytes()


_ranks: dict[bytes, Ranks] = {}


def ranks_of(spec: bytes, pattern: str) -> Ranks:
    """The encoder of a rank file, built once per Python process."""
    key = hashlib.sha256(spec + b"\0" + pattern.encode()).digest()
    if key not in _ranks:
        _ranks.clear()
        _ranks[key] = Ranks(spec, pattern)
    return _ranks[key]


def _file(df: DataFrame, path: str):
    """The rank file, read by the driver and sent to executors; its size does
    not depend on the data."""
    with open(path, "rb") as f:
        return df.sparkSession.sparkContext.broadcast(f.read())


def tokenized(docs: DataFrame, path: str, pattern: str, with_ids: bool = False) -> DataFrame:
    """``doc_id, n_tokens, ids_sha256, decoded_sha256`` per row of ``docs``
    (and ``ids`` if asked for): the whole text encoded with the rank file at
    ``path``, each match of ``pattern`` separately, and decoded from those ids.
    ``ids_sha256`` is of the ids as little-endian 32-bit numbers.

    A null text is an empty one; an empty text has no ids; a null ``doc_id``
    stays; repeated rows give a row each; no rows: no rows. A long text is
    encoded in parts of ``PART`` pieces. Other columns are not read."""
    spec = _file(docs, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = ranks_of(spec.value, pattern)
        for b in sliced(batches, 256):
            n, ids_sha, text_sha, kept = [], [], [], []
            for parts in r.encode_all(t.as_py() or "" for t in b.column(1)):
                count, seen, back = 0, hashlib.sha256(), hashlib.sha256()
                for part in parts:
                    ids = np.frombuffer(part, "<u4")
                    seen.update(part)
                    back.update(r.decode(ids))
                    count += len(ids)
                    if with_ids:
                        kept.append(ids.astype(np.int32))
                n.append(count)
                ids_sha.append(seen.hexdigest())
                text_sha.append(back.hexdigest())
            cols = [b.column(0), pa.array(n, pa.int64()), pa.array(ids_sha, pa.string()), pa.array(text_sha, pa.string())]
            names = ["doc_id", "n_tokens", "ids_sha256", "decoded_sha256"]
            if with_ids:
                flat = pa.array(np.concatenate([*kept, np.empty(0, np.int32)]))
                cols, names = [*cols, pa.ListArray.from_arrays(pa.array(np.cumsum([0, *n]), pa.int32()), flat)], [*names, "ids"]
            yield pa.RecordBatch.from_arrays(cols, names)

    schema = "doc_id long, n_tokens long, ids_sha256 string, decoded_sha256 string" + ", ids array<int>" * with_ids
    return arrow_rows(docs.select(F.col("doc_id").cast("long").alias("doc_id"), "text"), run, schema)


def decoded(rows: DataFrame, path: str, pattern: str) -> DataFrame:
    """``doc_id, data`` per row of ``rows (doc_id, ids)``: the bytes that the
    ids stand for (none for null ids). An id that no token has is an error."""
    spec = _file(rows, path)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        r = ranks_of(spec.value, pattern)
        for b in sliced(batches, 256):
            data = [r.decode(ids.values.to_numpy(zero_copy_only=False)) if ids.is_valid else b"" for ids in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(data, pa.binary())], ["doc_id", "data"])

    return arrow_rows(rows.select(F.col("doc_id").cast("long").alias("doc_id"), F.col("ids").cast("array<int>").alias("ids")), run, "doc_id long, data binary")
