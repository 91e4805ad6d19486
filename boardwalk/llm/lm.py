"""Language-model scores: a byte model by partial matching (PPM) beside the
unigram word model of the contract.

The byte model is a trie of contexts of up to four bytes with the counts of
what followed them in all training texts. A symbol is coded in the longest
context seen; each failure there escapes to the next shorter one (escape
estimate C: distinct followers over occurrences plus distinct followers), and
symbols of the longer context are excluded from the shorter one's counts. In a
pretrained trie a symbol's code length depends on its five bytes alone, so it
is worked out once per distinct gram.

Nothing of the corpus's vocabulary is broadcast or sent to the driver, but
numbers bounded by the alphabet (65,536 pairs of bytes). Documents are dealt
into blocks of about ``block_bytes``. A block's dictionary (its distinct grams
and word hashes with training counts) is a few packed arrays; Spark deals them
by key to be totalled, grams on to the part of the trie they belong to, and
the answers back to the blocks, where the texts are scored:

    documents by block -> dictionaries -> by key: totals
                                            grams -> by subtree: code lengths -> by key
                                                                  -> by block, with the documents: scores

A subtree holds the contexts that end in the same two bytes; it has 2^24 grams
at most. Words are told apart by 64-bit hashes.

Dictionaries are dealt into a number of parts that hardly grows with the
corpus, so their rows grow with the blocks and not with the blocks' square. A
part is totalled up a tree: ``FAN`` blocks' rows become one, ``FAN`` of those
one, and the answers come down the same way, so no task reads a part of more
than ``FAN`` blocks or nodes.

A row (equal id and text) that is there so often that it would unbalance the
blocks is scored and learned from once, with its number.
"""

from __future__ import annotations

import math
import zlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from boardwalk.llm.common import arrow_rows, fold, row_key, settled, ship

ORDER = 4
START, END = 0xFE, 0xFF  # never bytes of UTF-8
GRAM, WORD = 0, 1
#: Positions worked on at a time.
CHUNK = 1 << 22
#: Blocks or nodes that a node of the tree of totals sums; parts of a
#: dictionary, at least (but one per block) and at most; grams of a subtree's
#: part, on average; rows that are counted as hot, at most.
FAN, PARTS, MOST_PARTS, SUBTREE, HOT = 64, 32, 1024, 1 << 21, 1 << 16

_DICT = "part int, block int, kind int, keys binary, counts binary"


# --- packed arrays -------------------------------------------------------


def pack_keys(keys: np.ndarray) -> bytes:
    """Sorted 64-bit keys as compressed differences."""
    return zlib.compress(np.diff(keys, prepend=np.uint64(0)).tobytes(), 1)


def unpack_keys(data: bytes) -> np.ndarray:
    return np.cumsum(np.frombuffer(zlib.decompress(data), np.uint64), dtype=np.uint64)


def pack_values(values: np.ndarray) -> bytes:
    return zlib.compress(np.asarray(values, np.float64).tobytes(), 1)


def unpack_values(data: bytes) -> np.ndarray:
    return np.frombuffer(zlib.decompress(data), np.float64)


def _mixed(keys: np.ndarray) -> np.ndarray:
    return (keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(33)


def _summed(keys: list[np.ndarray], values: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys, sorted, with the sums of their values."""
    if not keys:
        return np.empty(0, np.uint64), np.empty(0)
    distinct, at = np.unique(np.concatenate(keys), return_inverse=True)
    return distinct, np.bincount(at, np.concatenate(values), len(distinct))


class Table:
    """Open-addressing look-up of 64-bit keys, whole arrays at a time."""

    def __init__(self, keys: np.ndarray, values: np.ndarray):
        self.bits = max(4, int(4 * len(keys)).bit_length())
        size = 1 << self.bits
        self.keys, self.values, self.full = np.zeros(size, np.uint64), np.zeros(size), np.zeros(size, bool)
        left, slot = np.arange(len(keys)), self._slot(keys)
        while len(left):
            free = left[~self.full[slot[left]]]
            self.keys[slot[free]] = keys[free]  # the last writer of a slot stays
            self.full[slot[free]] = True
            won = free[self.keys[slot[free]] == keys[free]]
            self.values[slot[won]] = values[won]
            left = np.setdiff1d(left, won, assume_unique=True)
            slot[left] = (slot[left] + 1) & (size - 1)

    def _slot(self, keys: np.ndarray) -> np.ndarray:
        return ((keys * np.uint64(0x9E3779B97F4A7C15)) >> np.uint64(64 - self.bits)).astype(np.int64)

    def get(self, keys: np.ndarray) -> np.ndarray:
        """Values of keys that are all in the table."""
        slot = self._slot(keys)
        miss = np.flatnonzero(self.keys[slot] != keys)
        while len(miss):
            slot[miss] = (slot[miss] + 1) & (len(self.keys) - 1)
            miss = miss[self.keys[slot[miss]] != keys[miss]]
        return self.values[slot]


# --- texts ----------------------------------------------------------------


def grams(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Codes of five bytes for every symbol of the texts and their ends, and
    where each text's codes begin."""
    sizes = np.fromiter(map(len, texts), np.int64, len(texts)) + 1
    b = np.frombuffer(b"".join(x for t in texts for x in (bytes([START]) * ORDER, t, bytes([END]))), np.uint8)
    code = np.zeros(len(b) - ORDER, np.uint64)
    for i in range(ORDER + 1):
        code <<= np.uint64(8)
        code |= b[i : len(b) - ORDER + i]
    code = code[(code & np.uint64(0xFF)) != START]
    return code, np.concatenate(([0], np.cumsum(sizes)[:-1]))


def word_hashes(text: bytes) -> np.ndarray:
    import xxhash

    words = text.split()
    # Zero marks the end token.
    return np.maximum(np.fromiter(map(xxhash.xxh64_intdigest, words), np.uint64, len(words)), np.uint64(1))


def _lots(texts: list[bytes]) -> Iterator[slice]:
    """Runs of texts of about CHUNK bytes."""
    start, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= CHUNK:
            yield slice(start, i + 1)
            start, size = i + 1, 0
    if start < len(texts):
        yield slice(start, len(texts))


def _lowered(column: pa.ChunkedArray | pa.Array) -> list[bytes]:
    return [(x or b"").lower() for x in column.cast(pa.large_binary()).to_pylist()]


# --- dictionaries ----------------------------------------------------------


def _count(parts: int):
    """One block's documents (block, train, text, times) to its dictionary,
    dealt into ``parts`` by key."""

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        held: dict[int, dict[int, list]] = {}
        for b in batches:
            blocks, train = b.column(0).to_numpy(), b.column(1).to_numpy(zero_copy_only=False).astype(bool)
            all_times = b.column(3).to_numpy()
            texts = _lowered(b.column(2))
            for block in np.unique(blocks):
                rows = np.flatnonzero(blocks == block)
                mine, learn, times = [texts[i] for i in rows], train[rows], all_times[rows]
                kinds = held.setdefault(int(block), {GRAM: [], WORD: []})
                for lot in _lots(mine):
                    code, starts = grams(mine[lot])
                    hashes = [word_hashes(t) for t in mine[lot]]
                    ends = [np.zeros(1, np.uint64)] * len(hashes)
                    word = np.concatenate([x for pair in zip(hashes, ends, strict=True) for x in pair])
                    for kind, keys, sizes in (
                        (GRAM, code, np.diff(starts, append=len(code))),
                        (WORD, word, np.fromiter((len(h) + 1 for h in hashes), np.int64, len(hashes))),
                    ):
                        often = np.repeat(np.where(learn[lot], times[lot], 0), sizes)
                        once = often == 1
                        seen, n = np.unique(keys[once], return_counts=True)
                        rest, at = np.unique(keys[~once], return_inverse=True)
                        kinds[kind].append(_summed([seen, rest], [n.astype(float), np.bincount(at, often[~once], len(rest))]))
                for kind, found in kinds.items():
                    if len(found) > 8:
                        kinds[kind] = [_summed([k for k, _ in found], [v for _, v in found])]
        for block, kinds in held.items():
            for kind, found in kinds.items():
                keys, counts = _summed([k for k, _ in found], [v for _, v in found])
                yield from _dealt(block, kind, keys, counts, (_mixed(keys) % np.uint64(parts)).astype(np.int64))

    return run


def _dealt(block: int, kind: int, keys: np.ndarray, values: np.ndarray, to: np.ndarray) -> Iterator[pa.RecordBatch]:
    """One packed row for each part that ``to`` names; keys stay sorted."""
    order = np.argsort(to, kind="stable")
    parts, starts = np.unique(to[order], return_index=True)
    rows = [(int(p), block, kind, pack_keys(keys[i]), pack_values(values[i])) for p, i in zip(parts, np.split(order, starts[1:]), strict=True)]
    if rows:
        yield pa.RecordBatch.from_arrays([pa.array(c, t) for c, t in zip(zip(*rows, strict=True), _TYPES, strict=True)], _NAMES)


_NAMES = ["part", "block", "kind", "keys", "counts"]
_TYPES = [pa.int32(), pa.int32(), pa.int32(), pa.binary(), pa.binary()]


def _table(batches: list[pa.RecordBatch]) -> pa.Table:
    return pa.Table.from_batches(batches, pa.schema(list(zip(_NAMES, _TYPES, strict=True))))


def _totals(t: pa.Table) -> tuple[np.ndarray, np.ndarray]:
    return _summed([unpack_keys(k) for k in t["keys"].to_pylist()], [unpack_values(v) for v in t["counts"].to_pylist()])


def _answered(t: pa.Table, keys: np.ndarray, values: np.ndarray) -> Iterator[pa.RecordBatch]:
    """The rows of a part, with ``values`` of their keys for counts."""
    rows = []
    for part, block, kind, k in zip(*(t[c].to_pylist() for c in _NAMES[:4]), strict=True):
        rows.append((part, block, kind, k, pack_values(values[np.searchsorted(keys, unpack_keys(k))])))
    yield pa.RecordBatch.from_arrays([pa.array(c, ty) for c, ty in zip(zip(*rows, strict=True), _TYPES, strict=True)], _NAMES)


def _word_totals(t: pa.Table) -> pa.Table:
    return _table(list(_answered(t, *_totals(t))))


def _vocabulary(t: pa.Table) -> pa.Table:
    _, n = _totals(t)
    sizes = {"tokens": int(n.sum()), "types": int((n > 0).sum()), "grams": len(n)}
    return pa.table({"kind": t["kind"].slice(0, 1)} | {c: pa.array([x], pa.int64()) for c, x in sizes.items()})


def _to_subtrees(parts: int):
    """A part's grams with their totals, dealt by the context's last two
    bytes; ``block`` is the part to answer to."""

    def run(t: pa.Table) -> pa.Table:
        keys, n = _totals(t)
        ends = (keys >> np.uint64(8)) & np.uint64(0xFFFF)
        return _table(list(_dealt(int(t["part"][0].as_py()), GRAM, keys, n, (_mixed(ends) % np.uint64(parts)).astype(np.int64))))

    return run


def _pairs(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    n = np.zeros(1 << 16)
    for b in batches:
        for k, v in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), strict=True):
            n += np.bincount((unpack_keys(k) & np.uint64(0xFFFF)).astype(np.int64), unpack_values(v), 1 << 16)
    at = np.flatnonzero(n)
    yield pa.RecordBatch.from_arrays([pa.array(at, pa.int32()), pa.array(n[at], pa.float64())], ["pair", "n"])


# --- the trie ---------------------------------------------------------------


def code_lengths(gram: np.ndarray, count: np.ndarray, pairs: np.ndarray) -> np.ndarray:
    """log10 probability of the last byte of each gram after its first four.

    ``gram``: sorted distinct codes, complete for the two-byte contexts they
    end in, with training ``count``; ``pairs``: counts of byte pairs (256, 256)
    of the whole corpus, for contexts of one byte and none."""
    m = len(gram)
    # Per order k, for each gram: count of (context, symbol), occurrences and
    # distinct followers of the context, and what is left of the next shorter
    # context once the followers are excluded.
    c, n, q = [np.zeros(m) for _ in range(ORDER + 1)], [np.zeros(m) for _ in range(ORDER + 1)], [np.zeros(m) for _ in range(ORDER + 1)]
    n_rest, q_rest = [np.zeros(m) for _ in range(ORDER + 1)], [np.zeros(m) for _ in range(ORDER + 1)]
    last, symbol = ((gram >> np.uint64(8)) & np.uint64(0xFF)).astype(np.int64), (gram & np.uint64(0xFF)).astype(np.int64)
    alone = pairs.sum(axis=0)
    c[1], n[1], q[1] = pairs[last, symbol], pairs.sum(axis=1)[last], (pairs > 0).sum(axis=1)[last].astype(float)
    c[0], n[0], q[0] = alone[symbol], np.full(m, alone.sum()), np.full(m, float((alone > 0).sum()))
    for k in range(ORDER, 1, -1):
        node, at = np.unique(gram & np.uint64((1 << 8 * (k + 1)) - 1), return_inverse=True)
        total = np.bincount(at, count, len(node))
        context, of = np.unique(node >> np.uint64(8), return_inverse=True)
        c[k] = total[at]
        n[k] = np.bincount(of, total, len(context))[of][at]
        q[k] = np.bincount(of, total > 0, len(context))[of][at]
    for k in range(1, ORDER + 1):
        node, first, at = np.unique(gram & np.uint64((1 << 8 * (k + 1)) - 1), return_index=True, return_inverse=True)
        if k > 1:
            context, of = np.unique(node >> np.uint64(8), return_inverse=True)
            gone = np.bincount(of, np.where(c[k][first] > 0, c[k - 1][first], 0.0), len(context))[of][at]
        else:
            gone = ((pairs > 0) * alone).sum(axis=1)[last]
        n_rest[k], q_rest[k] = n[k - 1] - gone, q[k - 1] - q[k]
    out, open_, entered = np.zeros(m), np.ones(m, bool), np.zeros(m, bool)
    for k in range(ORDER, -1, -1):
        shorter = entered & (k < ORDER)
        total = np.where(shorter, n_rest[min(k + 1, ORDER)], n[k])
        kinds = np.where(shorter, q_rest[min(k + 1, ORDER)], q[k])
        known = open_ & (entered | (n[k] > 0)) & (total + kinds > 0)
        hit = known & (c[k] > 0)
        out[hit] += np.log10(c[k][hit] / (total + kinds)[hit])
        open_ &= ~hit
        fail = known & ~hit
        out[fail] += np.log10(kinds[fail] / (total + kinds)[fail])
        entered |= n[k] > 0
    out[open_] -= np.log10(256 - (alone > 0).sum())
    return out


def _model(pairs: np.ndarray):
    """A subtree's grams to their code lengths, back by part (in ``block``)."""

    def run(t: pa.Table) -> pa.Table:
        keys, n = _totals(t)
        length = code_lengths(keys, n, pairs)
        rows = []
        for to, k in zip(t["block"].to_pylist(), t["keys"].to_pylist(), strict=True):
            rows.append((to, 0, GRAM, k, pack_values(length[np.searchsorted(keys, unpack_keys(k))])))
        return pa.Table.from_arrays([pa.array(c, ty) for c, ty in zip(zip(*rows, strict=True), _TYPES, strict=True)], _NAMES)

    return run


def _answer(asked: pa.Table, known: pa.Table) -> pa.Table:
    """Dictionaries of a part with the values that ``known`` has of their keys."""
    if not asked.num_rows:
        return _table([])
    return _table(list(_answered(asked, *_totals(known))))


def _summed_rows(t: pa.Table) -> pa.Table:
    """A node of the tree: the rows below it as one."""
    keys, n = _totals(t)
    block, part, kind = (t[c][0].as_py() for c in ("up", "part", "kind"))
    row = [part, block, kind, pack_keys(keys), pack_values(n)]
    return pa.Table.from_arrays([pa.array([c], ty) for c, ty in zip(row, _TYPES, strict=True)], _NAMES)


def _levels(dicts: DataFrame, blocks: int) -> list[DataFrame]:
    """The dictionaries, and the nodes above them up to ``FAN`` or fewer."""
    levels = [dicts]
    while blocks > FAN:
        up = levels[-1].withColumn("up", F.expr(f"block div {FAN}").cast("int"))
        levels.append(settled(up.groupBy("part", "kind", "up").applyInArrow(_summed_rows, _DICT)))
        blocks = -(-blocks // FAN)
    return levels


def _down(levels: list[DataFrame], answers: DataFrame) -> DataFrame:
    """Answers to the top nodes brought down to the dictionaries."""
    for below in levels[-2::-1]:
        asked = below.withColumn("up", F.expr(f"block div {FAN}").cast("int")).groupBy("part", "kind", "up")
        # Answers come from the same tables: other names keep their keys apart.
        known = answers.select(F.col("part").alias("of_part"), F.col("kind").alias("of_kind"), F.col("block").alias("of"), "keys", "counts")
        answers = asked.cogroup(known.groupBy("of_part", "of_kind", "of")).applyInArrow(_answer, _DICT)
    return answers


# --- scores -----------------------------------------------------------------

_SCORED = "doc_id long, row string, n_tokens long, n_known long, seen_log double, n_bytes long, score double, times long"


def _score(docs: pa.Table, answers: pa.Table) -> pa.Table:
    """Scores of a block's documents from its answered dictionary."""
    by = {}
    for kind in (GRAM, WORD):
        mine = answers.filter(pa.compute.equal(answers["kind"], kind))
        by[kind] = Table(*_totals(mine))
    texts = _lowered(docs["text"])
    tokens, known, logs, score = [], [], [], []
    for lot in _lots(texts):
        code, starts = grams(texts[lot])
        score.append(np.add.reduceat(by[GRAM].get(code), starts))
        for t in texts[lot]:
            c = by[WORD].get(np.append(word_hashes(t), np.uint64(0)))
            tokens.append(len(c))
            known.append(int((c > 0).sum()))
            logs.append(float(np.log10(c + 1).sum()))
    score = np.concatenate(score) if score else np.empty(0)
    return pa.table(
        {
            "doc_id": docs["doc_id"],
            "row": docs["row"],
            "n_tokens": pa.array(tokens, pa.int64()),
            "n_known": pa.array(known, pa.int64()),
            "seen_log": pa.array(logs, pa.float64()),
            "n_bytes": pa.array([len(t) for t in texts], pa.int64()),
            "score": pa.array(score, pa.float64()),
            "times": docs["times"],
        }
    )


def _rows(docs: DataFrame, train, most_bytes: int, most_rows: int) -> tuple[DataFrame, bool]:
    """``docs`` with ``train``, ``row`` and ``times``, and whether any row is
    there for several. A row that holds more than ``most_bytes`` in all its
    copies, or ``most_rows`` copies, is reduced to one; the copies combine
    before the shuffle. There are ``2 * HOT`` such rows at most."""
    at = docs.select(
        F.coalesce(train, F.lit(False)).alias("train"),
        F.col("text").cast("string").alias("text"),
        F.col("doc_id").cast("long").alias("doc_id"),
        row_key(F.col("doc_id"), F.col("text")).alias("row"),
    )
    one = F.lit(1).cast("long").alias("times")
    per = at.select("row", F.coalesce(F.octet_length("text"), F.lit(0)).alias("size")).groupBy("row").agg(F.sum("size").alias("size"), F.count(F.lit(1)).alias("m"))
    hot = settled(per.where((F.col("m") > 1) & ((F.col("size") > most_bytes) | (F.col("m") > most_rows))).select("row"))
    if hot.isEmpty():
        return at.withColumn("times", one), False
    cold = at.join(F.broadcast(hot), "row", "left_anti").withColumn("times", one)
    few = at.join(F.broadcast(hot), "row", "left_semi").groupBy(*at.columns).agg(F.count(F.lit(1)).alias("times"))
    return cold.unionByName(few), True


def scores(docs: DataFrame, train, block_bytes: int = 16 << 20, block_rows: int = 8192) -> DataFrame:
    """``doc_id, row, n_tokens, n_known, train_tokens, base_score, n_bytes,
    score`` per row of ``docs``; the models learn from the rows where the
    condition ``train`` holds.

    ``score``: the byte model's log10 probability of the whole text, lower-cased
    (A-Z), and its end. ``base_score``: the add-one unigram model's, over words
    and one end token. A null text is an empty one, which is one end token and
    one end symbol; repeated rows are scored and learned from each. Without
    training rows all counts are zero and every symbol has probability 1/256.
    No rows: no rows. ``block_bytes`` and ``block_rows`` bound what a block
    holds on average; a row's copies beyond that, or beyond one in ``HOT`` of
    all bytes or rows, count as one row in it."""
    spark = docs.sparkSession
    ship(spark)
    size, n_rows = docs.agg(F.sum(F.octet_length("text")), F.count(F.lit(1))).first()
    size = int(size or 0)
    blocks = max(1, -(-size // block_bytes), -(-n_rows // block_rows))
    parts = min(blocks, max(PARTS, min(MOST_PARTS, math.isqrt(blocks))))
    rows, hot = _rows(docs, train, max(block_bytes // 4, size // HOT), max(block_rows // 4, n_rows // HOT))
    rows = rows.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)).cast("int"))
    counted = arrow_rows(rows.select("block", "train", "text", "times").repartitionById(blocks, F.col("block")), _count(parts), _DICT)
    levels = _levels(settled(counted), blocks)
    top = levels[-1]
    words, gram = top.where(f"kind = {WORD}"), top.where(f"kind = {GRAM}")
    sizes = top.groupBy("part", "kind").applyInArrow(_vocabulary, "kind int, tokens long, types long, grams long")
    found = {r["kind"]: r for r in sizes.groupBy("kind").agg(F.sum("tokens").alias("tokens"), F.sum("types").alias("types"), F.sum("grams").alias("grams")).collect()}
    tokens, types = (found[WORD]["tokens"], found[WORD]["types"]) if WORD in found else (0, 0)
    subtree_parts = max(parts, -(-found[GRAM]["grams"] // SUBTREE)) if GRAM in found else 1

    subtrees = settled(gram.groupBy("part").applyInArrow(_to_subtrees(subtree_parts), _DICT))
    table = np.zeros(1 << 16)
    counts = arrow_rows(subtrees.select("keys", "counts"), _pairs, "pair int, n double")
    for r in counts.groupBy("pair").agg(F.sum("n").alias("n")).collect():  # 65,536 rows at most
        table[r["pair"]] = r["n"]
    lengths = subtrees.groupBy("part").applyInArrow(_model(table.reshape(256, 256)), _DICT)

    answers = gram.groupBy("part").cogroup(lengths.groupBy("part")).applyInArrow(_answer, _DICT)
    answers = _down(levels, answers.union(words.groupBy("part").applyInArrow(_word_totals, _DICT)))
    out = rows.drop("train").groupBy("block").cogroup(answers.groupBy("block")).applyInArrow(_score, _SCORED)
    if hot:
        out = out.withColumn("copy", F.explode(F.sequence(F.lit(1).cast("long"), "times")))
    base = F.col("seen_log") - F.col("n_tokens") * F.lit(float(np.log10(tokens + types + 1)))
    return out.select("doc_id", "row", "n_tokens", "n_known", F.lit(int(tokens)).cast("long").alias("train_tokens"), base.alias("base_score"), "n_bytes", "score")


def held_out_scores(docs: DataFrame, parts: int = 7, held: int = 2, **how) -> DataFrame:
    """``scores`` with models of the rows whose fold (crc32 of the id modulo
    ``parts``) is not ``held``; adds ``held_out``."""
    return scores(docs, fold(F.col("doc_id"), parts) != held, **how).withColumn("held_out", fold(F.col("doc_id"), parts) == held)
