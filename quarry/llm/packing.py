"""Best-fit packing of tokenized documents into fixed-length sequences.

Vector best fit: a bin has residual capacities of tokens, documents and
attention cost (sum of squared piece lengths).  Pieces go, longest first, to
the open bin that holds them under every capacity and is best by the weighted
residual norm (the least left) or by the weighted dot product (the best
aligned); a new bin opens if none holds the piece.

Tokenizing and packing run in one pass: a task packs its own documents, a
group of at most ``group_tokens`` tokens at a time, so no text and no token is
shuffled and memory is bounded by the group.  A lost task gives the same bins
again.  The pieces are written once in the shared folder.  What every group
leaves in bins with room is then packed once more: only place and length of
their pieces are shuffled, many bins to a task, and their sequences are numbered
anew (below zero).  So the number of sequences hardly depends on how the input
is dealt.

Null and empty texts are the end token alone.  Texts are tokenized whole,
however long.  Rows that repeat an id are packed each on its own.  Empty tables
give no sequence.  Other columns named in ``keep`` pass through; those named
like an output column or starting with ``pack_`` raise ``ValueError``.
"""

from __future__ import annotations

from array import array
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import column, cut, written
from quarry.plans import sizing

SEQUENCE_TOKENS = 2048
END_ID = 0
GROUP_TOKENS = 1 << 21
#: A bin with more than this part of its tokens free is packed once more, so many bins to a task.
LOOSE, LOOSE_BINS = 1 / 64, 8192
CACHED_WORDS = 200_000
OWN = ("piece", "start", "length", "ids", "sequence_id", "offset")
_LOADED: dict[str, "WordTokenizer"] = {}


def vocabulary_path(name: str = "word_bpe_49k.json") -> str:
    import public_tokenizers

    return public_tokenizers.path(name)


def _byte_letters() -> list[str]:
    """The letter that byte-level vocabularies write for each byte."""
    plain = [*range(33, 127), *range(161, 173), *range(174, 256)]
    other = iter(range(256, 512))
    return [chr(b) if b in plain else chr(next(other)) for b in range(256)]


class _Known(dict):
    """Ids of words; words not known are encoded, and remembered while there is room."""

    def __init__(self, encode, room: int):
        super().__init__({"": b""})
        self.encode, self.room = encode, room

    def __missing__(self, word: str) -> bytes:
        got = self.encode(word)
        if len(self) < self.room:
            self[word] = got
        return got


class WordTokenizer:
    """Unsigned 32-bit token ids of texts, for ``word_bpe_49k.json``.

    Its tokens never span a space or line feed, so a text's ids are those of its
    parts between them.  Ids of frequent parts are remembered (texts are never
    cut).  Parts of Latin letters, digits and marks are lower-cased and split
    here and go to the tokenizer's model piece by piece; all others go through
    the whole tokenizer.  The tests hold both against the tokenizer's own ids.
    """

    #: Characters that normalization leaves alone, but for lower case.
    SIMPLE = "[!-~\u00a1-\u017f]+"
    #: Fixed value: the vocabulary's own split pattern.
    SPLIT = r"'s|'t|'re|'ve|'m|'ll|'d|[\p{L}]+|[\p{N}]|[^\s\p{L}\p{N}]+"

    def __init__(self, path: str):
        import regex
        from tokenizers import Tokenizer

        self.tokenizer = Tokenizer.from_file(path)
        self.tokenize = self.tokenizer.model.tokenize  # each access to ``model`` makes a new wrapper
        self.simple = regex.compile(self.SIMPLE).fullmatch
        self.split = regex.compile(self.SPLIT).findall
        self.letters = _byte_letters()
        self.words = _Known(self._word, CACHED_WORDS)

    @classmethod
    def of(cls, path: str) -> "WordTokenizer":
        """The worker's one tokenizer for this file."""
        if path not in _LOADED:
            import os

            os.environ["TOKENIZERS_PARALLELISM"] = "false"
            _LOADED.clear()
            _LOADED[path] = cls(path)
        return _LOADED[path]

    def _piece(self, piece: str) -> bytes:
        if not piece.isascii():
            piece = "".join([self.letters[b] for b in piece.encode()])
        return array("I", [t.id for t in self.tokenize(piece)]).tobytes()

    def _word(self, word: str) -> bytes:
        if word.isascii() or max(word) <= "\u017f":
            low = word.lower()
            if low.isalpha():
                return self._piece(low) if low == word else self.words[low]
            if low[:-1].isalpha() and low[-1] in ".,;:!?)":
                return self.words[low[:-1]] + self.words[low[-1]]
            if "<|" not in word and self.simple(word):
                pieces = self.split(low)
                return self._piece(word) if pieces == [word] else b"".join(map(self.words.__getitem__, pieces))
        return array("I", self.tokenizer.encode(word, add_special_tokens=False).ids).tobytes()

    def encode(self, texts: Sequence[str | None]) -> list[bytes]:
        """Ids of each text, little-endian (as on all platforms Spark runs on in practice)."""
        get = self.words.__getitem__
        return [b"".join(map(get, (t or "").replace("\n", " ").split(" "))) for t in texts]


def best_fit(items: np.ndarray, capacity: np.ndarray, weights: np.ndarray, score: str = "norm") -> tuple[np.ndarray, int]:
    """Bin of each item (rows of ``items``: one column per capacity), and the number of bins."""
    size, need = items / capacity, np.full(len(items), -1)
    order = np.argsort(-size.max(axis=1), kind="stable")
    left, ids, n_open, n_bins = np.empty((64, items.shape[1])), np.empty(64, np.int64), 0, 0
    least = np.minimum.accumulate(size[order][::-1], axis=0)[::-1]  # the least that any later item needs
    for rank, i in enumerate(order.tolist()):
        v = size[i]
        fits = np.flatnonzero((left[:n_open] >= v - 1e-12).all(axis=1))
        if len(fits):
            r = left[fits]
            value = (((r - v) ** 2) @ weights) if score == "norm" else -((r * v) @ weights)
            at = int(fits[np.argmin(value)])
        else:
            if n_open == len(left):
                left, ids = np.concatenate((left, np.empty_like(left))), np.concatenate((ids, np.empty_like(ids)))
            at, left[n_open], ids[n_open] = n_open, 1.0, n_bins
            n_open, n_bins = n_open + 1, n_bins + 1
        left[at] -= v
        need[i] = ids[at]
        if rank + 1 < len(order) and (left[at] < least[rank + 1] - 1e-12).any():  # no later item fits
            n_open -= 1
            left[at], ids[at] = left[n_open], ids[n_open]
    return need, n_bins


def places(length: np.ndarray, where: np.ndarray) -> np.ndarray:
    """Offset of each piece in its bin, in the order given."""
    order = np.argsort(where, kind="stable")
    before = np.cumsum(length[order]) - length[order]
    first = np.concatenate(([True], where[order][1:] != where[order][:-1]))
    offset = np.empty(len(length), np.int64)
    offset[order] = before - np.maximum.accumulate(np.where(first, before, 0))
    return offset


def vectors(length: np.ndarray) -> np.ndarray:
    """What a piece needs of each capacity."""
    return np.stack([length, np.ones(len(length)), length.astype(float) ** 2], axis=1)


def pack(df: DataFrame, doc_id: str = "doc_id", text: str = "text", path: str | None = None,
         tokens: int = SEQUENCE_TOKENS, documents: int | None = None, attention: float | None = None,
         weights: Sequence[float] = (1.0, 0.01, 0.01), score: str = "norm", end_id: int = END_ID,
         group_tokens: int = GROUP_TOKENS, keep: Sequence[str] = ()) -> DataFrame:
    """One row per piece: ``doc_id, piece, start, length, ids, sequence_id, offset``.

    ``ids``: little-endian unsigned 32-bit ids.  A document's ids end with
    ``end_id``; only those of more than ``tokens`` are cut.  ``documents`` and
    ``attention`` bound the pieces of a sequence and the sum of their squared
    lengths (by default as much as ``tokens`` allows).  The sequence a piece is
    in is ``sequence_id``; pieces lie from ``offset`` on without gaps.
    """
    path = path or vocabulary_path()
    capacity = np.array([tokens, documents or tokens, attention or float(tokens) ** 2])
    if capacity[2] < float(tokens) ** 2 and capacity[2] < tokens:
        raise ValueError("attention capacity must hold at least one-token pieces")
    longest = int(min(tokens, np.sqrt(capacity[2])))
    weigh, end = np.array(weights, float), np.array([end_id], "<u4").tobytes()
    out = [doc_id, *keep]
    clash = [c for c in out if c.lower() in OWN or c.lower().startswith("pack_")]
    if clash:
        raise ValueError(f"columns {clash} have names the operator needs")

    names = ["own"]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        from pyspark import TaskContext

        tokenizer = WordTokenizer.of(path)
        next_id = TaskContext.get().partitionId() << 32

        def flush(rows: list, pieces: list) -> Iterator[pa.RecordBatch]:
            nonlocal next_id
            length = np.array([len(p[3]) // 4 for p in pieces])
            where, n = best_fit(vectors(length), capacity, weigh, score)
            offset = places(length, where)
            table = pa.Table.from_batches(rows).take(pa.array([p[0] for p in pieces]))
            for i in range(0, len(pieces), 4096):
                some = slice(i, i + 4096)
                got = table.slice(i, 4096).combine_chunks()
                yield pa.RecordBatch.from_arrays([
                    *[c.chunk(0) if c.num_chunks else pa.array([], c.type) for c in got.columns],
                    pa.array([p[1] for p in pieces[some]], pa.int32()), pa.array([p[2] for p in pieces[some]], pa.int64()),
                    pa.array(length[some], pa.int64()), pa.array([p[3] for p in pieces[some]], pa.binary()),
                    pa.array(where[some] + next_id, pa.int64()), pa.array(offset[some])],
                    [*names, "piece", "start", "length", "ids", "sequence_id", "offset"])
            next_id += n

        rows, pieces, held, seen = [], [], 0, 0
        for whole in batches:
            for i in range(0, whole.num_rows, 256):
                batch = whole.slice(i, 256)
                texts = batch.column(batch.num_columns - 1).to_pylist()
                rows.append(pa.RecordBatch.from_arrays(batch.columns[:-1], names))
                for at, raw in enumerate(tokenizer.encode(texts)):
                    raw += end
                    for k, s in enumerate(range(0, len(raw), 4 * longest)):
                        pieces.append((seen + at, k, s // 4, raw[s:s + 4 * longest]))
                    held += len(raw) // 4
                seen += batch.num_rows
                if held >= group_tokens:
                    yield from flush(rows, pieces)
                    rows, pieces, held, seen = [], [], 0, 0
        if pieces:
            yield from flush(rows, pieces)

    read = df.select(F.struct(*[column(c) for c in out]).alias("own"), column(text).cast("string").alias("pack_text"))
    kinds = {"piece": T.IntegerType(), "ids": T.BinaryType()}
    schema = T.StructType([read.schema["own"], *(T.StructField(c, kinds.get(c, T.LongType())) for c in OWN)])
    made = _packed_again(written(read.mapInArrow(run, schema)), capacity, weigh, score)
    return made.select(*[F.col("own")[c].alias(c) for c in out], *OWN)


def _packed_again(pieces: DataFrame, capacity: np.ndarray, weights: np.ndarray, score: str) -> DataFrame:
    """``pieces`` with those in bins with room packed once more across tasks."""
    room = F.lit(float(capacity[0] * (1 - LOOSE)))
    loose = cut(pieces.groupBy("sequence_id").agg(F.sum("length").alias("pack_used")).where(F.col("pack_used") < room).select("sequence_id"))
    groups = -(-loose.count() // LOOSE_BINS)
    if not groups:
        return pieces
    items = pieces.select("sequence_id", "offset", "length").join(sizing.broadcast_if_small(loose), "sequence_id")
    items = items.withColumn("pack_group", F.pmod(F.xxhash64("sequence_id"), F.lit(groups)))

    def again(t: pa.Table) -> pa.Table:
        t = t.sort_by([("sequence_id", "ascending"), ("offset", "ascending")])
        length, before = t.column("length").to_numpy(), t.column("sequence_id").to_numpy()
        where, n = best_fit(vectors(length), capacity, weights, score)
        if n >= len(np.unique(before)):  # nothing won: the bins stay as they are
            where, t, length = where[:0], t.slice(0, 0), length[:0]
        return pa.table([t.column("sequence_id"), t.column("offset"), pa.array(-1 - where * groups - t.column("pack_group").to_numpy(), pa.int64()),
                         pa.array(places(length, where) if len(length) else length, pa.int64())], names=["sequence_id", "offset", "pack_to", "pack_at"])

    moved = items.groupBy("pack_group").applyInArrow(again, "sequence_id long, offset long, pack_to long, pack_at long")
    out = pieces.join(sizing.broadcast_if_small(cut(moved)), ["sequence_id", "offset"], "left")
    new = {"sequence_id": F.coalesce("pack_to", "sequence_id"), "offset": F.coalesce("pack_at", "offset")}
    return out.withColumns(new).select(*[column(c) for c in pieces.columns])
