"""Language-model scores: prediction by partial matching, and a word baseline.

Model: a trie of byte contexts up to ``order``, learned from the training rows.
A symbol (byte or end of text) is coded in the longest known context; where it
is new there, an escape (method D: half of the distinct symbols over the count)
leads to the next shorter context, in which the symbols already ruled out are
excluded.  Children of a context are children of its suffixes too, so what is
excluded depends only on the context above: its code lengths come from counts
of that context and the next shorter one.  Scores are log10 of the probability
of the whole text (A-Z lower-cased) and its end.

The trie grows with the corpus and is never in one place.  Texts are dealt into
blocks of about ``block_bytes``.  A block's distinct grams (context and symbol)
and words go, packed, to the shard of their two latest context bytes (words: of
their hash); a shard sums the counts of all blocks, computes the code length of
each gram that a block has, and sends those back to the blocks, which sum them
up per document.  Contexts of up to one byte, at most 257 x 257 counts, are
known everywhere.

Words are known by a 64-bit hash.  Null and empty texts are the end alone.  Null
ids are held out.  Rows that repeat an id are scored, and learned, each on its
own.  Empty tables give no rows; without training rows the code is uniform.
Extra columns are ignored.
"""

from __future__ import annotations

import math
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import cut
from quarry.llm.substring import POWERS, mix64

ORDER = 5
BLOCK_BYTES = 16 << 20
END = 256
_BITS = np.uint64(9)
_SLICE = 1 << 21
ALPHA = 0.1


def _symbols(texts: list[bytes], order: int) -> tuple[np.ndarray, np.ndarray]:
    """All texts, each after ``order`` ends and before one; and where each starts."""
    pad = np.full(order, END, np.uint16)
    parts, starts, at = [], [], 0
    for t in texts:
        parts += [pad, np.frombuffer(t, np.uint8), pad[:1] if order else np.array([END], np.uint16)]
        starts.append(at)
        at += order + len(t) + 1
    return np.concatenate(parts).astype(np.uint16) if parts else pad[:0], np.array(starts, np.int64)


def _grams(flat: np.ndarray, starts: np.ndarray, order: int) -> Iterator[tuple[int, np.ndarray, np.ndarray]]:
    """Slices (first place, grams, which places are coded): latest context symbol highest, coded symbol lowest."""
    coded = np.ones(len(flat), bool)
    for j in range(order):
        coded[starts + j] = False
    for a in range(0, len(flat), _SLICE):
        b = min(len(flat), a + _SLICE)
        x = np.concatenate((np.full(max(0, order - a), END, np.uint16), flat[max(0, a - order):b])).astype(np.uint64)
        n = b - a
        g = np.zeros(n, np.uint64)
        for j in range(1, order + 1):
            g = (g << _BITS) | x[order - j:order - j + n]
        yield a, (g << _BITS) | x[order:order + n], coded[a:b]


def _word_hashes(texts: list[bytes]) -> tuple[np.ndarray, np.ndarray]:
    """Hash of each word of all texts, and each text's number of words."""
    joined = b"\n".join(texts) + b"\n"
    raw = np.frombuffer(joined, np.uint8)
    space = (raw == 32) | ((raw >= 9) & (raw <= 13))
    edge = np.flatnonzero(np.diff(space.astype(np.int8), prepend=np.int8(1)))
    first, last = edge[::2], edge[1::2]
    POWERS.upto(len(raw) + 1)
    sums = np.zeros(len(raw) + 1, np.uint64)
    np.cumsum(POWERS.value[raw] * POWERS.up[:len(raw)], out=sums[1:])
    ends = np.cumsum([len(t) + 1 for t in texts])
    upto = np.searchsorted(first, ends)
    return mix64((sums[last] - sums[first]) * POWERS.down[first]), np.diff(upto, prepend=0)


def _runs(texts: list[bytes], most: int = 1 << 20) -> Iterator[tuple[int, int]]:
    """Ranges of texts of about so many bytes."""
    a, size = 0, 0
    for i, t in enumerate(texts):
        size += len(t)
        if size >= most:
            yield a, i + 1
            a, size = i + 1, 0
    if a < len(texts):
        yield a, len(texts)


def _summed(keys: list[np.ndarray], counts: list[np.ndarray]) -> tuple[np.ndarray, np.ndarray]:
    """Distinct keys in order, and their summed counts."""
    if not keys:
        return np.zeros(0, np.uint64), np.zeros(0, np.int64)
    every, inverse = np.unique(np.concatenate(keys), return_inverse=True)
    return every, np.bincount(inverse, np.concatenate(counts), len(every)).astype(np.int64)


def block_grams(texts: list[bytes], train: np.ndarray, order: int) -> tuple[np.ndarray, np.ndarray]:
    """Distinct grams of a block with their counts in training texts."""
    keys, counts = [], []
    for learn in (False, True):
        some = [t for t, x in zip(texts, train) if x == learn]
        flat, starts = _symbols(some, order)
        for _, g, coded in _grams(flat, starts, order):
            k, n = np.unique(g[coded], return_counts=True)
            keys.append(k)
            counts.append(n if learn else np.zeros(len(k), np.int64))
    return _summed(keys, counts)


def block_words(texts: list[bytes], train: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
    """Distinct word hashes of a block with their counts in training texts."""
    keys, counts = [], []
    for learn in (False, True):
        some = [t for t, x in zip(texts, train) if x == learn]
        for a, b in _runs(some):
            k, n = np.unique(_word_hashes(some[a:b])[0], return_counts=True)
            keys.append(k)
            counts.append(n if learn else np.zeros(len(k), np.int64))
    return _summed(keys, counts)


def shard_of(keys: np.ndarray, kind: int, order: int, shards: int) -> np.ndarray:
    """Grams: by their two latest context symbols; words: by hash."""
    base = keys >> (_BITS * np.uint64(max(order - 1, 0))) if kind == 0 else keys
    return (mix64(base * np.uint64(0x9E3779B97F4A7C15)) % np.uint64(shards)).astype(np.int64)


class _Level:
    """Counts of grams with contexts of one length, and of the contexts."""

    def __init__(self, grams: np.ndarray, counts: np.ndarray):
        keep = counts > 0
        self.grams, inverse = np.unique(grams[keep], return_inverse=True)
        self.n = np.bincount(inverse, counts[keep], len(self.grams))
        self.contexts, at = np.unique(self.grams >> _BITS, return_inverse=True)
        self.at = at
        self.total = np.bincount(at, self.n, len(self.contexts))
        self.kinds = np.bincount(at, minlength=len(self.contexts)).astype(float)

    def find(self, known: np.ndarray, wanted: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """Place of each wanted key, and whether it is there."""
        if not len(known):
            return np.zeros(len(wanted), np.int64), np.zeros(len(wanted), bool)
        at = np.minimum(np.searchsorted(known, wanted), len(known) - 1)
        return at, known[at] == wanted

    def count(self, grams: np.ndarray) -> np.ndarray:
        at, there = self.find(self.grams, grams)
        return np.where(there, self.n[at], 0.0) if len(self.n) else np.zeros(len(grams))


def code(keys: np.ndarray, counts: np.ndarray, low: np.ndarray, order: int) -> np.ndarray:
    """log10 probability of each gram, from all training counts of its shard and ``low``.

    ``low``: counts of all pairs (context symbol, symbol), 257 x 257.
    """
    symbol = keys & np.uint64(511)
    grams = [(((keys >> _BITS) >> (_BITS * np.uint64(order - k))) << _BITS) | symbol for k in range(order + 1)]
    pair = np.flatnonzero(low.ravel()).astype(np.uint64)
    levels = [_Level(pair % np.uint64(257), low.ravel()[pair.astype(np.int64)]),
              _Level(((pair // np.uint64(257)) << _BITS) | pair % np.uint64(257), low.ravel()[pair.astype(np.int64)])]
    levels = levels[:order + 1] + [_Level(grams[k], counts) for k in range(2, order + 1)]
    out, open_ = np.zeros(len(keys)), np.ones(len(keys), bool)
    above = None  # for each key: whether the context above is known, its place, and its level
    for k in range(order, -1, -1):
        lv = levels[k]
        at, known = lv.find(lv.contexts, grams[k] >> _BITS)
        total = np.where(known, lv.total[at] if len(lv.total) else 0, 0.0)
        kinds = np.where(known, lv.kinds[at] if len(lv.kinds) else 0, 0.0)
        if above is not None:
            was, up, lvu = above
            # What the context above knows, counted here, is excluded.
            ruled = np.bincount(lvu.at, lv.count(_shorter(lvu.grams)), len(lvu.contexts))
            total = total - np.where(was, ruled[up] if len(ruled) else 0, 0.0)
            kinds = kinds - np.where(was, lvu.kinds[up] if len(lvu.kinds) else 0, 0.0)
        n = lv.count(grams[k])
        live = open_ & known & (total > 0)
        hit = live & (n > 0)
        out[hit] += np.log10((2 * n[hit] - 1) / (2 * total[hit]))
        miss = live & (n == 0)
        out[miss] += np.log10(kinds[miss] / (2 * total[miss]))
        open_ &= ~hit
        above = (known, at, lv)
    left = 257 - (levels[0].kinds[0] if len(levels[0].kinds) else 0)
    out[open_] -= math.log10(max(left, 1))
    return out


def _shorter(grams: np.ndarray) -> np.ndarray:
    """Grams with the oldest context symbol dropped."""
    return ((grams >> _BITS >> _BITS) << _BITS) | (grams & np.uint64(511))


def planes(x: np.ndarray) -> bytes:
    """Numbers as byte planes, which the shuffle's codec packs well where high bytes are alike."""
    return np.ascontiguousarray(x.view(np.uint8).reshape(len(x), x.itemsize).T).tobytes()


def from_planes(raw: pa.Buffer, dtype) -> np.ndarray:
    size = np.dtype(dtype).itemsize
    return np.ascontiguousarray(np.frombuffer(raw, np.uint8).reshape(size, -1).T).view(dtype).ravel()


def _bytes(column: pa.ChunkedArray) -> list[bytes]:
    return [(t or "").encode("utf-8", "surrogatepass").lower() for t in column.to_pylist()]


def _pair_counts(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """Counts of (context symbol, symbol) in training texts."""
    low = np.zeros(257 * 257, np.int64)
    for b in batches:
        for i in range(0, b.num_rows, 1024):
            flat, starts = _symbols(_bytes(b.column(0).slice(i, 1024)), 1)
            for _, g, coded in _grams(flat, starts, 1):
                some = g[coded]
                low += np.bincount(((some >> _BITS) * np.uint64(257) + (some & np.uint64(511))).astype(np.int64), minlength=257 * 257)
    at = np.flatnonzero(low)
    yield pa.RecordBatch.from_arrays([pa.array(at), pa.array(low[at])], ["pair", "n"])


def score(df: DataFrame, train: Column, doc_id: str = "doc_id", text: str = "text", order: int = ORDER,
          block_bytes: int = BLOCK_BYTES) -> DataFrame:
    """``doc_id, held_out, n_tokens, n_known, train_tokens, base_score, score`` of every row.

    ``train``: which rows the models learn from.  ``score``: log10 probability
    by partial matching; ``base_score``: by smoothed word frequencies.
    """
    if not 1 <= order <= 6:
        raise ValueError("the order must be from 1 to 6")
    body = F.coalesce(F.col(text).cast("string"), F.lit(""))
    docs = df.select(F.col(doc_id).alias("doc_id"), F.coalesce(train, F.lit(False)).alias("train"), body.alias("text"))
    facts = docs.agg(F.sum(F.octet_length("text")).alias("size"), F.count_if("train").alias("texts")).first()
    blocks = max(1, math.ceil((facts["size"] or 0) / block_bytes))
    shards = math.ceil(8 * math.sqrt(blocks))
    pairs = docs.where("train").select("text").mapInArrow(_pair_counts, "pair long, n long").groupBy("pair").agg(F.sum("n").alias("n"))
    low = np.zeros(257 * 257)
    for r in pairs.collect():  # at most 257 x 257 rows
        low[r.pair] = r.n
    low = low.reshape(257, 257)
    dealt = docs.withColumn("block", F.pmod(F.xxhash64("doc_id", "text"), F.lit(blocks)))

    def pack(t: pa.Table) -> pa.Table:
        texts, learn = _bytes(t["text"]), np.array(t["train"].to_pylist(), bool)
        rows = []
        for kind, (keys, counts) in ((0, block_grams(texts, learn, order)), (1, block_words(texts, learn))):
            shard = shard_of(keys, kind, order, shards)
            for s in np.unique(shard).tolist():
                on = shard == s
                rows.append((t["block"][0].as_py(), kind * shards + s, planes(np.diff(keys[on], prepend=np.uint64(0))), planes(counts[on].astype(np.uint32))))
        cols = list(zip(*rows)) or [[], [], [], []]
        return pa.table({"block": pa.array(cols[0], pa.int64()), "shard": pa.array(cols[1], pa.int64()),
                         "keys": pa.array(cols[2], pa.binary()), "counts": pa.array(cols[3], pa.binary())})

    def solve(t: pa.Table) -> pa.Table:
        kind = t["shard"][0].as_py() // shards
        keys = [np.cumsum(from_planes(x.as_buffer(), np.uint64), dtype=np.uint64) for x in t["keys"]]
        counts = [from_planes(x.as_buffer(), np.uint32) for x in t["counts"]]
        every, n = _summed(keys, counts)
        value = code(every, n, low, order).astype(np.float32) if kind == 0 else n
        back = [planes(value[np.searchsorted(every, k)]) for k in keys]
        words = kind == 1
        return pa.table({"block": t["block"], "shard": t["shard"], "values": pa.array(back, pa.binary()),
                         "kinds": pa.array([int((n > 0).sum()) if words and i == 0 else 0 for i in range(len(keys))], pa.int64()),
                         "total": pa.array([int(n.sum()) if words and i == 0 else 0 for i in range(len(keys))], pa.int64())})

    packed = dealt.groupBy("block").applyInArrow(pack, "block long, shard long, keys binary, counts binary")
    values = cut(packed.groupBy("shard").applyInArrow(
        solve, "block long, shard long, values binary, kinds long, total long"))

    def sum_up(left: pa.Table, right: pa.Table) -> pa.Table:
        texts, learn = _bytes(left["text"]), np.array(left["train"].to_pylist(), bool)
        got = dict(zip(right["shard"].to_pylist(), right["values"]))

        def table(keys: np.ndarray, kind: int, dtype) -> np.ndarray:
            out, shard = np.empty(len(keys), dtype), shard_of(keys, kind, order, shards)
            for s in np.unique(shard).tolist():
                out[shard == s] = from_planes(got[kind * shards + s].as_buffer(), dtype)
            return out

        total, base = np.zeros(len(texts)), np.zeros(len(texts))
        n_words, n_known = np.zeros(len(texts), np.int64), np.zeros(len(texts), np.int64)
        if texts:
            keys, _ = block_grams(texts, learn, order)
            cost = table(keys, 0, np.float32)
            flat, starts = _symbols(texts, order)
            for a, g, coded in _grams(flat, starts, order):
                each = np.zeros(len(g))
                each[coded] = cost[np.searchsorted(keys, g[coded])]
                first = np.searchsorted(starts, a, "right") - 1
                inside = starts[first + 1:np.searchsorted(starts, a + len(g))] - a
                sums = np.add.reduceat(each, np.concatenate(([0], inside)))
                total[first:first + len(sums)] += sums
            words, _ = block_words(texts, learn)
            count = table(words, 1, np.int64)
            gain = np.log10(count + ALPHA)
            for a, b in _runs(texts):
                hashes, n = _word_hashes(texts[a:b])
                at, doc = np.searchsorted(words, hashes), np.repeat(np.arange(a, b), n)
                n_words[a:b] = n
                base += np.bincount(doc, gain[at], len(texts)) if len(doc) else 0
                n_known += np.bincount(doc, count[at] > 0, len(texts)).astype(np.int64) if len(doc) else 0
        return pa.table({"doc_id": left["doc_id"], "train": left["train"], "words": n_words, "known": n_known, "gain": base, "score": total})

    id_kind = docs.schema["doc_id"].dataType.simpleString()
    summed = dealt.groupBy("block").cogroup(values.groupBy("block")).applyInArrow(
        sum_up, f"doc_id {id_kind}, train boolean, words long, known long, gain double, score double")
    facts2 = values.agg(F.sum("kinds").alias("kinds"), F.sum("total").alias("total")).first()
    ends = facts["texts"]
    n_train, kinds = (facts2["total"] or 0) + ends, (facts2["kinds"] or 0) + (1 if ends else 0)
    n_tokens = F.col("words") + 1
    norm = math.log10(n_train + ALPHA * (kinds + 1))
    return summed.select(
        "doc_id", (~F.col("train")).alias("held_out"), n_tokens.alias("n_tokens"),
        (F.col("known") + F.lit(1 if ends else 0)).alias("n_known"), F.lit(n_train).cast("long").alias("train_tokens"),
        (F.col("gain") + F.lit(math.log10(ends + ALPHA)) - n_tokens * F.lit(norm)).alias("base_score"), "score")
