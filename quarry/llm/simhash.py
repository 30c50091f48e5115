"""SimHash near-duplicates by covering locality-sensitive hashing.

Fingerprints: 64 bits, bit set if set in over half of the XXH64 hashes (seed
42) of the text's word shingles.  Links: pairs within ``radius`` bits.

Masks (covering LSH, Pagh): every bit position gets a nonzero vector of
GF(2)^(radius+1); for each nonzero v the mask keeps the positions whose vector
is not orthogonal to v.  The at most ``radius`` positions in which a pair
differs span less than the whole space, so some v is orthogonal to all of them
and the pair agrees on that mask: every pair meets in some table, none is
missed.

Only distinct fingerprints enter the tables.  In a bucket, links are searched
from one fingerprint to those not reached yet, so a dense bucket of n costs
about n steps and emits n - 1 links, never all pairs.  A bucket above
``max_bucket`` is not held in memory: its members link through the points
within radius // 2 of them (two fingerprints within the radius share such a
point, and those that share one are within the radius), an exact way that
spreads over all tasks.
"""

from __future__ import annotations

import re
from collections.abc import Iterator, Sequence

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame
from pyspark.sql import functions as F

from quarry.llm.common import connected_components, cut, join_heavy

SHINGLE = 4
RADIUS = 4
SEED = 42
MAX_BUCKET = 32_768
_CHUNK = 1 << 16


def masks(radius: int = RADIUS, bits: int = 64) -> list[int]:
    """The 2^(radius+1) - 1 masks, as signed 64-bit integers."""
    dims = radius + 1
    out = []
    for v in range(1, 1 << dims):
        m = 0
        for i in range(bits):
            if bin((i % ((1 << dims) - 1) + 1) & v).count("1") % 2:
                m |= 1 << i
        out.append(m - (1 << 64) if m >> 63 else m)
    return out


def text_fingerprint(text: str | None, shingle: int = SHINGLE) -> int:
    """Fingerprint of one text (A-Z lower-cased); 0 without words."""
    import xxhash

    got = (text or "").encode("utf-8", "surrogatepass").lower().split()
    if not got:
        return 0
    joined = b" ".join(got)
    at = np.concatenate(([-1], np.flatnonzero(np.frombuffer(joined, np.uint8) == 32), [len(joined)]))
    k = min(shingle, len(got))
    starts, ends = (at[: len(got) - k + 1] + 1).tolist(), at[k:].tolist()
    digest = xxhash.xxh64_intdigest
    total, n = np.zeros(64, np.int64), len(starts)
    for i in range(0, n, _CHUNK):
        part = [digest(joined[a:b], SEED) for a, b in zip(starts[i:i + _CHUNK], ends[i:i + _CHUNK])]
        raw = np.array(part, dtype=">u8").view(np.uint8).reshape(-1, 8)
        total += np.unpackbits(raw, axis=1).sum(axis=0, dtype=np.int64)
    return int.from_bytes(np.packbits(total * 2 > n).tobytes(), "big", signed=True)


def fingerprints(df: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                 keep: Sequence[str] = ()) -> DataFrame:
    """``doc_id, fp`` (signed 64-bit) for every row, then the columns ``keep`` (of type long)."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            fp = [text_fingerprint(t.as_py(), shingle) for t in b.column(1)]
            yield pa.RecordBatch.from_arrays([b.column(0), pa.array(fp, pa.int64()), *b.columns[2:]], ["doc_id", "fp", *keep])

    source = df.select(F.col(doc_id).cast("long").alias("doc_id"), F.col(text).cast("string").alias("text"), *keep)
    return source.mapInArrow(run, ", ".join(f"{c} long" for c in ("doc_id", "fp", *keep)))


def bucket_links(fp: np.ndarray, radius: int = RADIUS) -> tuple[np.ndarray, np.ndarray]:
    """A spanning forest of the links among distinct fingerprints (uint64)."""
    left, a, b = np.arange(len(fp)), [], []
    while len(left) > 1:
        todo, left = [left[0]], left[1:]
        while todo and len(left):
            x = todo.pop()
            near = np.bitwise_count(fp[left] ^ fp[x]) <= radius
            if near.any():
                got, left = left[near], left[~near]
                a.append(np.full(len(got), x))
                b.append(got)
                todo.extend(got.tolist())
    if not a:
        return np.empty(0, np.int64), np.empty(0, np.int64)
    return np.concatenate(a), np.concatenate(b)


def _link_buckets(radius: int, max_bucket: int):
    """Over rows sorted by bucket: links (a, b), and (a, null) for members of too large buckets."""
    def links(key: np.ndarray, fp: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        bounds = np.concatenate(([0], np.flatnonzero(key[1:] != key[:-1]) + 1, [len(key)]))
        size = np.diff(bounds)
        pair = bounds[:-1][size == 2]
        near = np.bitwise_count(fp[pair] ^ fp[pair + 1]) <= radius
        a, b = [pair[near]], [pair[near] + 1]
        for s, n in zip(bounds[:-1][size > 2].tolist(), size[size > 2].tolist()):
            x, y = bucket_links(fp[s:s + n], radius)
            a.append(x + s)
            b.append(y + s)
        return fp[np.concatenate(a)], fp[np.concatenate(b)]

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        def out(a, b):
            return pa.RecordBatch.from_arrays([pa.array(a.view(np.int64)), pa.array(b.view(np.int64), pa.int64())], ["a", "b"])

        def marked(x):
            return pa.RecordBatch.from_arrays([pa.array(x.view(np.int64)), pa.nulls(len(x), pa.int64())], ["a", "b"])

        key, fp, spilled = np.empty(0, np.int64), np.empty(0, np.uint64), None
        for batch in batches:
            k, f = batch.column(0).to_numpy(zero_copy_only=False), batch.column(1).to_numpy(zero_copy_only=False).view(np.uint64)
            if spilled is not None:  # the rest of a bucket already given up
                n = int(np.searchsorted(k != spilled, True)) if len(k) and k[0] == spilled else 0
                n = len(k) if len(k) and (k == spilled).all() else n
                if n:
                    yield marked(f[:n])
                    k, f = k[n:], f[n:]
                if not len(k):
                    continue
                spilled = None
            key, fp = np.concatenate((key, k)), np.concatenate((fp, f))
            if not len(key):
                continue
            last = int(np.flatnonzero(key != key[-1])[-1]) + 1 if (key != key[-1]).any() else 0
            if last:
                yield out(*links(key[:last], fp[:last]))
                key, fp = key[last:], fp[last:]
            if len(key) > max_bucket:
                yield marked(fp)
                key, fp, spilled = key[:0], fp[:0], key[0]
        if len(key):
            yield out(*links(key, fp))

    return run


def hub_links(hot: DataFrame, radius: int = RADIUS) -> DataFrame:
    """All links among the fingerprints of ``hot(fp)``, each to the least member at a shared point."""
    if radius % 2:
        raise ValueError("the radius must be even")
    bit = "CASE WHEN {0} = 0 THEN 0L ELSE shiftleft(1L, {0} - 1) END"
    flip = F.expr(f"transform(sequence(0, 64), i -> {bit.format('i')})")
    points = hot.select("fp", F.col("fp").alias("point"))
    for _ in range(radius // 2):
        points = points.select("fp", "point", F.explode(flip).alias("flip")).select(
            "fp", F.expr("point ^ flip").alias("point")).distinct()
    least = points.groupBy("point").agg(F.min("fp").alias("a"))
    return points.join(least, "point").where("a <> fp").select("a", F.col("fp").alias("b")).distinct()


def links(fps: DataFrame, radius: int = RADIUS, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """Links ``a, b`` that connect all of ``fps(fp)`` (distinct) within the radius."""
    mask = F.array(*[F.lit(m).cast("long") for m in masks(radius)])
    keyed = fps.select("fp", F.posexplode(mask).alias("t", "m")).select(
        F.xxhash64(F.col("fp").bitwiseAND(F.col("m")), F.col("t")).alias("key"), "fp")
    sorted_ = keyed.repartition("key").sortWithinPartitions("key", "fp")
    found = cut(sorted_.mapInArrow(_link_buckets(radius, max_bucket), "a long, b long").distinct())
    pairs = found.where("b IS NOT NULL")
    hot = found.where("b IS NULL").select(F.col("a").alias("fp"))
    return pairs if hot.isEmpty() else pairs.unionByName(hub_links(hot, radius))


def near_duplicates(df: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
                    radius: int = RADIUS, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """``doc_id, fp, component_id`` for every row (duplicates of a row included).

    Null and empty texts have fingerprint 0, linked like any other.  Null ids
    are kept, take part in links, and are nobody's component id unless no other
    id is in the component (then it is null).  Extra columns are ignored.
    """
    docs = cut(fingerprints(df, doc_id, text, shingle))
    fps = cut(docs.groupBy("fp").agg(F.min("doc_id").alias("least"), F.count(F.lit(1)).alias("rows")))
    roots = connected_components(links(fps.select("fp"), radius, max_bucket))
    linked = fps.join(roots, fps["fp"] == roots["node"], "left").select(
        "fp", "rows", "least", F.coalesce("root", "fp").alias("root"))
    least = linked.groupBy("root").agg(F.min("least").alias("component_id"))
    named = linked.join(least, "root").select("fp", "rows", "component_id")
    return join_heavy(docs, cut(named), "fp", "rows").select("doc_id", "fp", "component_id")


def row_hashes(df: DataFrame, doc_id: str, text: str) -> list[Column]:
    """Two hashes of a row (id and text first; without columns of a kind that has no hash)."""
    rest = [f"`{f.name}`" for f in df.schema.fields if f.name not in (doc_id, text)
            and not re.search(r"\b(map|variant)\b", f.dataType.simpleString())]
    values = [x for c in (doc_id, text, *rest) for x in (F.col(c).isNull(), F.col(c))]
    return [F.xxhash64(F.lit(i), *values) for i in range(2)]


def keep_one(df: DataFrame, doc_id: str = "doc_id", text: str = "text", shingle: int = SHINGLE,
             radius: int = RADIUS, max_bucket: int = MAX_BUCKET) -> DataFrame:
    """One row of each component, with all its columns: the first by id (null last), then by row hash.

    Rows are told apart by their hash, not by their id: rows without an id stay
    unless their component has another row, texts under one id are decided each
    for itself, and of rows equal in all columns one stays.  Names starting
    with ``sim_`` are reserved.
    """
    hashes = row_hashes(df, doc_id, text)
    hashed = df.withColumns({"sim_a": hashes[0], "sim_b": hashes[1]})
    key = F.struct("sim_a", "sim_b").alias("sim_key")
    docs = fingerprints(hashed, doc_id, text, shingle, ["sim_a", "sim_b"])
    entries = cut(docs.groupBy("sim_a", "sim_b", "doc_id", "fp").agg(F.count(F.lit(1)).alias("sim_rows")))
    first = F.min(F.struct(F.col("doc_id").isNull().alias("no_id"), "doc_id", "sim_a", "sim_b"))
    fps = cut(entries.groupBy("fp").agg(first.alias("first")))
    roots = connected_components(links(fps.select("fp"), radius, max_bucket))
    kept = fps.join(roots, fps["fp"] == roots["node"], "left").groupBy(F.coalesce("root", "fp").alias("root")).agg(
        F.min("first").alias("first")).select("first.sim_a", "first.sim_b", F.lit(True).alias("sim_kept"))
    named = cut(entries.join(kept, ["sim_a", "sim_b"], "left").select(
        key, "sim_rows", F.col("sim_rows").alias("sim_copies"), F.coalesce("sim_kept", F.lit(False)).alias("sim_kept")))
    got = join_heavy(hashed.withColumn("sim_key", key), named, "sim_key", "sim_rows").where("sim_kept")
    once = got.where("sim_copies = 1").select(*[F.col(f"`{c}`") for c in df.columns])
    if named.where("sim_kept AND sim_copies > 1").isEmpty():
        return once
    again = got.where("sim_copies > 1").groupBy("sim_key").agg(
        F.first(F.struct(*[F.col(f"`{c}`") for c in df.columns])).alias("sim_row")).select("sim_row.*")
    return once.unionByName(again)
