"""Text encoding into vectors.

* ``encode``: a pluggable encoder run in Python workers with ``mapInPandas``
  (Arrow batches, encoder loaded once per worker, sub-batches of
  ``batch_size``).  A failing sub-batch is retried row by row; rows that still
  fail are kept with ``status='error'`` and a null (or zero) vector instead of
  zeroing their neighbours.
* ``hash_encode``: the feature-hashing test encoder over Spark's tokens, summed
  over Arrow batches; reproducible in SQL.
* ``HashingEncoder``: the same encoder in numpy, usable with ``encode``.
* ``masked_mean``: mean pooling over real tokens only, so a text's vector does
  not depend on its batch mates (for model encoders).

An encoder factory is any picklable zero-argument callable returning
``encoder(list[str]) -> ndarray (n, dim)``.
"""

from __future__ import annotations

import hashlib
from collections.abc import Callable
from dataclasses import dataclass
from functools import lru_cache

import numpy as np
import pandas as pd
import pyarrow as pa
import regex
from pyspark.sql import DataFrame
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.functions import arrow_udf

from quarry.functions.text import TOKEN_PATTERN, clean_text, split_tokens, token_text
from quarry.functions.vectors import l2_normalize

_TOKEN_RE = regex.compile(TOKEN_PATTERN)
_WORKER_ENCODERS: dict = {}


@lru_cache(maxsize=1 << 18)
def _bucket_sign(token: str, dim: int) -> tuple[int, float]:
    h = int(hashlib.md5(token.encode("utf-8")).hexdigest()[:8], 16)
    return h % dim, 1.0 - 2.0 * ((h // dim) % 2)


class HashingEncoder:
    """Signed feature hashing of tokens (md5, first 32 bits): bucket = h mod dim,
    sign from the next bit.  Deterministic stand-in for a model."""

    def __init__(self, dim: int = 128):
        self.dim = dim

    def __call__(self, texts: list[str]) -> np.ndarray:
        out = np.zeros((len(texts), self.dim), dtype=np.float64)
        for r, text in enumerate(texts):
            for tok in _TOKEN_RE.findall(text.lower()):
                b, s = _bucket_sign(tok, self.dim)
                out[r, b] += s
        return out


class HashingEncoderFactory:
    def __init__(self, dim: int = 128):
        self.dim = dim

    def __call__(self):
        return HashingEncoder(self.dim)

    def __eq__(self, other):
        return type(other) is type(self) and other.dim == self.dim

    def __hash__(self):
        return hash(("hashing", self.dim))


def masked_mean(hidden: np.ndarray, mask: np.ndarray) -> np.ndarray:
    """Mean over real (mask = 1) positions of (batch, tokens, dim) states."""
    m = mask[..., None].astype(hidden.dtype)
    counts = np.maximum(m.sum(axis=1), 1.0)
    return (hidden * m).sum(axis=1) / counts


def ragged_mean(states: np.ndarray, ends: np.ndarray) -> np.ndarray:
    """Mean of each text's own token states; ``states`` has the tokens of all texts in a row, text i up to ``ends[i]``.

    No padding takes part, so a text's vector does not depend on its batch
    mates.  A text without tokens has a zero vector.
    """
    starts = np.r_[0, ends[:-1]]
    sums = np.zeros((len(ends), states.shape[1]))
    some = np.flatnonzero(ends > starts)
    if len(some):
        sums[some] = np.add.reduceat(states, starts[some], axis=0)
    return sums / np.maximum(ends - starts, 1)[:, None]


class PooledHashingEncoder(HashingEncoder):
    """Token states (signed one-hot by hash) pooled per text, as a model's last layer is."""

    def __call__(self, texts: list[str]) -> np.ndarray:
        tokens = [_TOKEN_RE.findall(text.lower()) for text in texts]
        coded = [_bucket_sign(token, self.dim) for own in tokens for token in own]
        states = np.zeros((len(coded), self.dim))
        if coded:
            states[np.arange(len(coded)), [b for b, _ in coded]] = [sign for _, sign in coded]
        return ragged_mean(states, np.cumsum([len(own) for own in tokens]))


class PooledHashingEncoderFactory(HashingEncoderFactory):
    def __call__(self):
        return PooledHashingEncoder(self.dim)

    def __hash__(self):
        return hash(("pooled", self.dim))


def _unit(rows: np.ndarray) -> np.ndarray:
    norms = np.linalg.norm(rows, axis=1, keepdims=True)
    return np.divide(rows, norms, out=np.zeros_like(rows), where=norms > 0)


def _worker_encoder(factory, key: str):
    """The worker's encoder for ``key``; a worker keeps one, so a new key frees the last."""
    if key not in _WORKER_ENCODERS:
        _WORKER_ENCODERS.clear()
        _WORKER_ENCODERS[key] = factory()
    return _WORKER_ENCODERS[key]


def factory_key(factory) -> str:
    """``factory.cache_key`` if it has one, else a digest of the pickled factory."""
    from pyspark import cloudpickle

    return getattr(factory, "cache_key", None) or hashlib.sha256(cloudpickle.dumps(factory)).hexdigest()


def encode(df: DataFrame, *, id_col: str = "doc_id", text_col: str = "contents",
           encoder_factory=None, batch_size: int = 16, normalize: bool = True,
           zero_fill: bool = False, dim: int | None = None,
           out_col: str = "embedding", element_type: str = "double") -> DataFrame:
    """(id, embedding, status, error) for every input row."""
    factory = encoder_factory or HashingEncoderFactory()
    elem = T.DoubleType() if element_type == "double" else T.FloatType()
    np_type = np.float64 if element_type == "double" else np.float32
    schema = T.StructType([df.schema[id_col],
                           T.StructField(out_col, T.ArrayType(elem)),
                           T.StructField("status", T.StringType()),
                           T.StructField("error", T.StringType())])

    key = factory_key(factory)

    def run(batches):
        encoder = _worker_encoder(factory, key)
        for pdf in batches:
            texts = pdf["_text"].tolist()
            vecs: list = [None] * len(texts)
            status = ["ok"] * len(texts)
            errors: list = [None] * len(texts)
            for start in range(0, len(texts), batch_size):
                chunk = texts[start:start + batch_size]
                try:
                    out = np.asarray(encoder(chunk), dtype=np.float64)
                    rows = list(_unit(out) if normalize else out)
                except Exception:  # isolate the failing rows
                    rows = []
                    for j, t in enumerate(chunk):
                        try:
                            one = np.asarray(encoder([t]), dtype=np.float64)
                            rows.append((_unit(one) if normalize else one)[0])
                        except Exception as exc:  # noqa: BLE001 - quarantined per row
                            rows.append(None)
                            status[start + j] = "error"
                            errors[start + j] = f"{type(exc).__name__}: {exc}"
                for j, v in enumerate(rows):
                    if v is None:
                        if zero_fill and dim:
                            vecs[start + j] = np.zeros(dim, dtype=np_type)
                    else:
                        vecs[start + j] = v.astype(np_type)
            yield pd.DataFrame({id_col: pdf[id_col], out_col: vecs,
                                "status": status, "error": errors})

    src = df.select(F.col(id_col), clean_text(text_col).alias("_text"))
    return src.mapInPandas(run, schema)


@dataclass(frozen=True)
class EncoderPair:
    """A document encoder and a query encoder whose vectors meet in one space, as two-tower models have them."""

    document: Callable
    query: Callable

    def documents(self, df: DataFrame, id_col: str = "doc_id", text_col: str = "contents", **how) -> DataFrame:
        return encode(df, id_col=id_col, text_col=text_col, encoder_factory=self.document, **how)

    def queries(self, df: DataFrame, qid_col: str = "qid", text_col: str = "question", **how) -> DataFrame:
        return encode(df, id_col=qid_col, text_col=text_col, encoder_factory=self.query, **how)


def hash_encode(df: DataFrame, id_col: str = "doc_id", text_col: str = "contents",
                dim: int = 128, normalize: bool = True, out_col: str = "embedding") -> DataFrame:
    """(id, embedding array<double>) by signed feature hashing.

    Texts of one id are put together (a line feed is in no token), tokenized by
    Spark and summed up batch by batch, every distinct token of a batch hashed
    once.  Texts without tokens get a zero vector.  Input partitioned by the id
    is not shuffled.
    """
    return hash_encode_dims(df, {dim: out_col}, id_col, text_col, normalize)


def hash_encode_dims(df: DataFrame, out_cols: dict[int, str], id_col: str = "doc_id", text_col: str = "contents",
                     normalize: bool = True) -> DataFrame:
    """(id, a vector column for every dim of ``out_cols``): ``hash_encode`` at several widths, every text tokenized and hashed once."""
    texts = df.groupBy(id_col).agg(F.concat_ws("\n", F.collect_list(clean_text(text_col))).alias("_text"))
    summed = texts.select(id_col, _hash_sums(tuple(out_cols))(token_text("_text")).alias("_sums"))
    out = summed.select(id_col, *[F.col(f"_sums.d{dim}").alias(c) for dim, c in out_cols.items()])
    return out.withColumns({c: l2_normalize(c) for c in out_cols.values()}) if normalize else out


def _hashes(tokens: pa.Array) -> np.ndarray:
    """The hash of ``_bucket_sign`` for every token, read where Arrow holds the bytes."""
    held = tokens.cast(pa.large_binary())
    if not len(held):
        return np.zeros(0, np.int64)
    ends = np.frombuffer(held.buffers()[1], np.int64)[held.offset:held.offset + len(held) + 1].tolist()
    data, md5 = memoryview(held.buffers()[2] or b""), hashlib.md5
    first = b"".join([md5(data[a:b]).digest()[:4] for a, b in zip(ends, ends[1:])])
    return np.frombuffer(first, ">u4").astype(np.int64)


def _hash_sums(dims: tuple[int, ...]):
    """Column function: for every dim the signed sums per bucket of a row's tokens (``token_text``)."""
    @arrow_udf(T.StructType([T.StructField(f"d{dim}", T.ArrayType(T.DoubleType())) for dim in dims]))
    def sums(rows: pa.Array) -> pa.Array:
        values, length = split_tokens(rows)
        coded = values.dictionary_encode()
        hashed, codes = _hashes(coded.dictionary), coded.indices.to_numpy(zero_copy_only=False)
        row, made = np.repeat(np.arange(len(rows)), length), []
        for dim in dims:
            bucket, sign = hashed % dim, 1.0 - 2.0 * (hashed // dim % 2)
            summed = np.bincount(row * dim + bucket[codes], sign[codes], len(rows) * dim)
            made.append(pa.ListArray.from_arrays(pa.array(np.arange(len(rows) + 1, dtype=np.int32) * dim), pa.array(summed)))
        return pa.StructArray.from_arrays(made, [f"d{dim}" for dim in dims])
    return sums
