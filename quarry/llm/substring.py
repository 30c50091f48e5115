"""Substring deduplication on a de Bruijn graph of word windows.

A word of a document goes if a window of ``span`` words that covers it also
starts in a document with a smaller id.

1. Copies of a whole text share one entry (its least id): a copy's windows all
   occur there.
2. Anchors: the least hash among the ``gram``-word runs inside a window.  Equal
   windows have equal anchors, so only windows whose anchor occurs in two
   different texts can repeat; the rest of the corpus never leaves its task
   (about one anchor per 20 words does).
3. Windows in a row with one anchor are a path that is compacted where it is
   found: one edge of the graph, with its own hash, the edges before and after
   it in its text, and the hashes of its windows.  Grouping equal edges gives
   the first source (document, place) and whether all occurrences share one
   predecessor and one successor.
4. A join brings that back to the places.  Edges in a row, where no path
   branches and whose source places advance with them, compact into one span of
   the document and one of its source.
5. Edges with one anchor but different words overlap in part.  For these, of
   each edge's first document only, the windows themselves are grouped, joined
   and compacted in the same way; other occurrences went whole in step 4.
6. The union of a document's spans is cut from its words.

Edges and windows are known by two independent rolling hashes of their bytes (64
bits, and modulo 2^31 - 1).  In the end the words themselves decide: the words
of every span and those at its source coordinates are read again, and a span is
taken only if their digests are equal (a source that many spans share is read
once).

Ids: null counts as larger than any id; equal ids never cut each other.  Null
and empty texts have no words.  Empty tables give empty results.  Extra columns
pass through ``dedup``; names starting with ``sub_`` are reserved.
"""

from __future__ import annotations

import hashlib
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T

from quarry.llm.common import column, cut, join_heavy, written

SPAN = 50
GRAM = 10
NO_ID = 2 ** 63 - 1
_CHUNK = 1 << 16
_P = (1 << 31) - 1
_UNPACK = None
_B, _B2 = 0x9E3779B97F4A7C15, 1_732_050_807


class _Powers:
    """Powers of the two bases and of their inverses, grown when needed."""

    def __init__(self) -> None:
        rng = np.random.default_rng(20)
        self.value = rng.integers(1, 2 ** 63, 256, dtype=np.uint64)
        self.value2 = rng.integers(1, _P, 256).astype(np.uint64)
        self.n = 0

    def upto(self, n: int) -> None:
        if n <= self.n:
            return
        n = max(n, 2 * self.n, 1 << 12)

        def row(base: int) -> np.ndarray:
            out = np.full(n, base, np.uint64)
            out[0] = 1
            return np.cumprod(out, dtype=np.uint64)

        def row2(base: int) -> np.ndarray:
            out = np.ones(1, np.uint64)
            while len(out) < n:
                out = np.concatenate((out, out * np.uint64(pow(base, len(out), _P)) % np.uint64(_P)))
            return out[:n]

        self.up, self.down = row(_B), row(pow(_B, -1, 1 << 64))
        self.up2, self.down2 = row2(_B2), row2(pow(_B2, -1, _P))
        self.n = n


POWERS = _Powers()


def mix64(x: np.ndarray) -> np.ndarray:
    x = x ^ (x >> np.uint64(31))
    x = x * np.uint64(0xBF58476D1CE4E5B9)
    return x ^ (x >> np.uint64(29))


def _packed(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The column ``sub_text`` compressed, as ``sub_packed``."""
    import zstandard

    pack = zstandard.ZstdCompressor(level=1).compress
    for b in batches:
        rest = [c for c in b.schema.names if c != "sub_text"]
        raw = [pack(t.as_buffer()) for t in b.column("sub_text")]
        yield pa.RecordBatch.from_arrays([*(b.column(c) for c in rest), pa.array(raw, pa.binary())], [*rest, "sub_packed"])


def unpacked(raw: bytes) -> bytes:
    global _UNPACK
    if _UNPACK is None:
        import zstandard

        _UNPACK = zstandard.ZstdDecompressor().decompress
    return _UNPACK(raw)


def window_hashes(text: bytes, span: int, gram: int, second: bool) -> Iterator[tuple]:
    """For chunks of a text's windows: (first place, anchors, function that hashes runs of windows)."""
    got = text.split()
    for first in range(0, len(got) - span + 1, _CHUNK):
        part = got[first:first + _CHUNK + span - 1]
        joined = np.frombuffer(b" ".join(part), np.uint8)
        ends = np.cumsum([len(w) + 1 for w in part]) - 1
        starts = np.concatenate(([0], ends[:-1] + 1))
        POWERS.upto(len(joined) + 1)
        sums = np.zeros(len(joined) + 1, np.uint64)
        np.cumsum(POWERS.value[joined] * POWERS.up[:len(joined)], out=sums[1:])

        def runs(n: int) -> np.ndarray:
            s, e = starts[:len(part) - n + 1], ends[n - 1:]
            return mix64((sums[e] - sums[s]) * POWERS.down[s])

        low, width, have = runs(gram), span - gram + 1, 1
        while have * 2 <= width:
            low, have = np.minimum(low[:-have], low[have:]), have * 2
        if have < width:
            low = np.minimum(low[:len(low) - (width - have)], low[width - have:])
        if not second:
            yield first, low, None
            continue
        p = np.uint64(_P)
        sums2 = np.zeros(len(joined) + 1, np.uint64)
        np.cumsum(POWERS.value2[joined] * POWERS.up2[:len(joined)] % p, out=sums2[1:])

        def both(a: np.ndarray, b: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
            """Both hashes of the words from window a's first to window b's last."""
            s, e = starts[a], ends[b + span - 1]
            return mix64((sums[e] - sums[s]) * POWERS.down[s]).view(np.int64), ((sums2[e] - sums2[s]) % p * POWERS.down2[s] % p).astype(np.int64)

        yield first, low, both


def _anchors(span: int, gram: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 512):
                part = b.slice(i, 512)
                found, keys = [], []
                for text, key in zip(part.column(0), part.column(1).to_pylist()):
                    for _, low, _ in window_hashes(text.as_buffer().to_pybytes(), span, gram, False):
                        a = np.unique(low[np.concatenate(([True], low[1:] != low[:-1]))])
                        found.append(a)
                        keys.append(np.full(len(a), key, np.int64))
                if found:
                    yield pa.RecordBatch.from_arrays(
                        [pa.array(np.concatenate(found).view(np.int64)), pa.array(np.concatenate(keys))], ["anchor", "key"])

    return run


_EDGE = "doc long, key long, pos long, n long, anchor long, h long, h2 long, before long, after long, windows binary"


def _edges(span: int, gram: int):
    """Runs of windows with one repeated anchor: place, hashes, the runs around, and the windows' hashes."""
    names = [x.split()[0] for x in _EDGE.split(", ")]

    def of(doc: int, key: int, text: bytes, anchors: np.ndarray) -> pa.RecordBatch | None:
        pos, n, anchor, h, h2, packed = [], [], [], [], [], []
        for first, low, both in window_hashes(text, span, gram, True):
            starts = np.flatnonzero(np.concatenate(([True], low[1:] != low[:-1])))
            last = np.concatenate((starts[1:], [len(low)])) - 1
            on = np.isin(low[starts], anchors)
            starts, last = starts[on], last[on]
            if not len(starts):
                continue
            one, two = both(starts, last)
            size = last - starts + 1
            each = np.arange(size.sum()) + np.repeat(starts - np.concatenate(([0], np.cumsum(size)[:-1])), size)
            w = np.rec.fromarrays(both(each, each), names="h,h2")
            cuts = np.concatenate(([0], np.cumsum(size)))
            packed += [w[a:b].tobytes() for a, b in zip(cuts[:-1], cuts[1:])]
            for out, x in ((pos, first + starts), (n, size), (anchor, low[starts].view(np.int64)), (h, one), (h2, two)):
                out.append(x)
        if not pos:
            return None
        pos, n, anchor, h, h2 = (np.concatenate(x) for x in (pos, n, anchor, h, h2))
        meets = np.concatenate(([False], pos[1:] == pos[:-1] + n[:-1], [False]))
        before, after = np.concatenate(([0], h[:-1])), np.concatenate((h[1:], [0]))
        same = lambda x: pa.array(np.full(len(pos), x, np.int64))
        return pa.RecordBatch.from_arrays([
            same(doc), same(key), pa.array(pos), pa.array(n), pa.array(anchor), pa.array(h), pa.array(h2),
            pa.array(before, mask=~meets[:-1]), pa.array(after, mask=~meets[1:]), pa.array(packed, pa.binary())], names)

    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            held, rows = [], 0
            for doc, key, text, anchors in zip(b.column(0).to_pylist(), b.column(1).to_pylist(), b.column(2), b.column(3)):
                text = unpacked(text.as_py())
                known = anchors.values.to_numpy(zero_copy_only=False).view(np.uint64)
                x = of(doc, key, text, known)
                if x is not None:
                    held.append(x)
                    rows += x.num_rows
                if rows > 20_000:
                    yield from pa.Table.from_batches(held).combine_chunks().to_batches()
                    held, rows = [], 0
            if held:
                yield from pa.Table.from_batches(held).combine_chunks().to_batches()

    return run


def _unpack(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """The windows of edges, as edges of one window."""
    for b in batches:
        for i in range(0, b.num_rows, 4096):
            part = b.slice(i, 4096)
            w = np.frombuffer(b"".join(part.column("windows").to_pylist()), [("h", np.int64), ("h2", np.int64)])
            n = part.column("n").to_numpy()
            at = np.repeat(np.arange(len(n)), n)
            inside = np.arange(len(at)) - np.repeat(np.cumsum(n) - n, n)
            yield pa.RecordBatch.from_arrays([
                part.column("doc").take(pa.array(at)), part.column("key").take(pa.array(at)),
                pa.array(part.column("pos").to_numpy()[at] + inside), pa.array(np.ascontiguousarray(w["h"])),
                pa.array(np.ascontiguousarray(w["h2"]))], ["doc", "key", "pos", "h", "h2"])


def repeated_spans(texts: DataFrame, df: DataFrame, entries: DataFrame, span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """Compacted spans ``doc, key, start, words, source, source_key, source_start``.

    ``texts(text, key)``: all rows, key a hash of the text; ``df(doc, key,
    packed)``: the same rows with compressed texts; ``entries(doc, key)``: one
    row per distinct text, with the least id that has it.
    """
    anchors = written(texts.select("text", "key").mapInArrow(_anchors(span, gram), "anchor long, key long"))
    shared = anchors.groupBy("anchor").agg(F.count(F.lit(1)).alias("rows"), F.min("key").alias("a"), F.max("key").alias("b"))
    shared = cut(shared.where("a < b").select("anchor", "rows"))
    lists = join_heavy(anchors, shared, "anchor", "rows").groupBy("key").agg(F.collect_set("anchor").alias("anchors"))
    edges = written(df.join(entries.join(lists, "key"), ["doc", "key"]).select("doc", "key", "packed", "anchors").mapInArrow(
        _edges(span, gram), _EDGE))
    nodes = cut(_nodes(edges, "anchor"))
    whole = _paths(edges.drop("windows", "anchor"), nodes, span)
    # Anchors under which edges differ: the windows of the edges' first documents.
    mixed = nodes.groupBy("anchor").agg(F.count(F.lit(1)).alias("c")).where("c > 1").select("anchor")
    firsts = nodes.join(mixed, "anchor").select("h", "h2", F.col("source").alias("doc"))
    windows = edges.join(firsts, ["h", "h2", "doc"]).select("doc", "key", "pos", "n", "windows").mapInArrow(
        _unpack, "doc long, key long, pos long, h long, h2 long")
    windows = windows.select("*", F.lit(1).cast("long").alias("n"))
    same = windows.groupBy("h", "h2").agg(F.min(F.struct("doc", "key", "pos")).alias("first"), F.max("doc").alias("last"))
    same = same.where("first.doc < last").select(
        "h", "h2", F.col("first.doc").alias("source"), F.col("first.key").alias("source_key"),
        F.col("first.pos").alias("source_start"), "last", F.lit(False).alias("joins"), F.lit(False).alias("forks"))
    return whole.unionByName(_paths(windows, same, span))


def _nodes(edges: DataFrame, *more: str) -> DataFrame:
    """Distinct edges: the first source, the last document, and whether paths join before or fork after."""
    def branches(side: str):
        return ~F.coalesce((F.min(side) == F.max(side)) & (F.count(side) == F.count(F.lit(1))), F.lit(False))

    got = edges.groupBy("h", "h2").agg(
        F.min(F.struct("doc", "key", "pos")).alias("first"), F.max("doc").alias("last"),
        branches("before").alias("joins"), branches("after").alias("forks"), *[F.min(c).alias(c) for c in more])
    return got.select("h", "h2", F.col("first.doc").alias("source"), F.col("first.key").alias("source_key"),
                      F.col("first.pos").alias("source_start"), "last", "joins", "forks", *more)


def _paths(edges: DataFrame, nodes: DataFrame, span: int) -> DataFrame:
    """Spans of edges that an earlier document has, compacted where no path branches."""
    repeated = nodes.where("source < last").select("h", "h2", "source", "source_key", "source_start", "joins", "forks")
    places = edges.select("doc", "key", "pos", "n", "h", "h2").join(repeated, ["h", "h2"]).where("doc > source").drop("h", "h2")
    row = Window.partitionBy("doc", "key").orderBy("pos")
    back = lambda c: F.lag(c).over(row)
    follows = ((back("pos") + back("n") == F.col("pos")) & (back("source") == F.col("source")) & (back("source_key") == F.col("source_key"))
               & (back("source_start") + back("n") == F.col("source_start")) & ~F.col("joins") & ~back("forks"))
    marked = places.withColumn("new", F.when(F.coalesce(follows, F.lit(False)), 0).otherwise(1))
    return marked.withColumn("path", F.sum("new").over(row)).groupBy("doc", "key", "path").agg(
        F.min("pos").alias("start"), (F.max(F.col("pos") + F.col("n")) - F.min("pos") + (span - 1)).alias("words"),
        F.min("source").alias("source"), F.min("source_key").alias("source_key"),
        F.min("source_start").alias("source_start")).drop("path")


def _digests(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
    """``doc, key, start, words, digest`` of the ranges wanted of each text."""
    names = ["doc", "key", "start", "words", "digest"]
    for b in batches:
        for i in range(0, b.num_rows, 256):
            part = b.slice(i, 256)
            at, starts, lengths, digests = [], [], [], []
            for j, (raw, ranges) in enumerate(zip(part.column("packed"), part.column("ranges"))):
                own = unpacked(raw.as_py()).split()
                for r in ranges.as_py():
                    at.append(j)
                    starts.append(r["start"])
                    lengths.append(r["words"])
                    digests.append(hashlib.sha256(b" ".join(own[r["start"]:r["start"] + r["words"]])).digest())
            rows = pa.array(at, pa.int64())
            yield pa.RecordBatch.from_arrays([part.column("doc").take(rows), part.column("key").take(rows), pa.array(starts, pa.int64()),
                                              pa.array(lengths, pa.int64()), pa.array(digests, pa.binary())], names)


def verified(spans: DataFrame, df: DataFrame) -> DataFrame:
    """The spans whose words equal those at their source coordinates; ``df(doc, key, packed)`` holds the texts."""
    spans = written(spans)
    source = F.struct("source", "source_key", "source_start", "words").alias("range")
    used = spans.groupBy(source).agg(F.count(F.lit(1)).alias("uses"))
    place = ["doc", "key", "start", "words"]
    wanted = spans.select(*place).unionByName(used.select(
        F.col("range.source").alias("doc"), F.col("range.source_key").alias("key"), F.col("range.source_start").alias("start"), "range.words"))
    wanted = wanted.groupBy("doc", "key").agg(F.collect_set(F.struct("start", "words")).alias("ranges"))
    texts = df.join(wanted, ["doc", "key"]).select("doc", "key", "packed", "ranges")
    digests = texts.mapInArrow(_digests, "doc long, key long, start long, words long, digest binary")
    digests = written(digests).dropDuplicates(place)  # rows that repeat an id and text
    at = digests.select(F.struct(F.col("doc").alias("source"), F.col("key").alias("source_key"), F.col("start").alias("source_start"),
                                 "words").alias("range"), F.col("digest").alias("source_digest"))
    own = spans.join(digests, place).withColumn("range", source)
    return join_heavy(own, at.join(used, "range"), "range", "uses").where("digest = source_digest").select(*spans.columns)


def _keep(span: int):
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 512):
                part = b.slice(i, 512)
                n_words, n_removed, kept = [], [], []
                for raw, copy, spans in zip(part.column("sub_packed"), part.column("sub_copy").to_pylist(), part.column("sub_spans").to_pylist()):
                    got = unpacked(raw.as_py()).split()
                    n_words.append(len(got))
                    if copy and len(got) >= span:
                        n_removed.append(len(got))
                        kept.append("")
                        continue
                    if spans:
                        gone = np.zeros(len(got) + 1, np.int64)
                        for s in spans:
                            gone[s["start"]] += 1
                            gone[s["start"] + s["words"]] -= 1
                        stay = np.flatnonzero(np.cumsum(gone[:-1]) == 0).tolist()
                        got = [got[j] for j in stay]
                    n_removed.append(n_words[-1] - len(got))
                    kept.append(b" ".join(got).decode("utf-8", "surrogatepass"))
                rest = [part.column(c) for c in part.schema.names if not c.startswith("sub_")]
                names = [c for c in part.schema.names if not c.startswith("sub_")]
                yield pa.RecordBatch.from_arrays(
                    [*rest, pa.array(n_words, pa.int64()), pa.array(n_removed, pa.int64()), pa.array(kept, pa.string())],
                    [*names, "sub_words", "sub_removed", "sub_kept"])

    return run


def dedup(df: DataFrame, doc_id: str = "doc_id", text: str = "text", span: int = SPAN, gram: int = GRAM) -> DataFrame:
    """All rows (without the text column) plus ``sub_words, sub_removed, sub_kept`` (the text left)."""
    clash = [c for c in df.columns if c.lower().startswith("sub_")]
    if clash:
        raise ValueError(f"columns {clash} have names the operator needs")
    doc = F.coalesce(column(doc_id).cast("long"), F.lit(NO_ID))
    body = F.coalesce(column(text).cast("string"), F.lit(""))
    rest = [c for c in df.columns if c != text]
    rows = df.select(F.struct(*[column(c) for c in rest]).alias("own"), doc.alias("sub_doc"), F.xxhash64(body).alias("sub_key"),
                     body.alias("sub_text"))
    rows = rows.withColumn("sub_digest", F.unhex(F.md5("sub_text")))
    # Texts are compressed where they are read, so that the two shuffles that need them move less.
    packed = T.StructType([*(f for f in rows.schema.fields if f.name != "sub_text"), T.StructField("sub_packed", T.BinaryType())])
    # Anchors move no text, so they read it as it is: one Python function in that stage, not two.
    ids, texts = rows, rows.select(F.col("sub_text").alias("text"), F.col("sub_key").alias("key"))
    rows = rows.mapInArrow(_packed, packed)
    hashed = rows.select(F.col("sub_doc").alias("doc"), F.col("sub_key").alias("key"), F.col("sub_packed").alias("packed"))
    ids = cut(ids.select(F.col("sub_doc").alias("doc"), F.col("sub_key").alias("key"), F.col("sub_digest").alias("digest")).distinct())
    least = cut(ids.groupBy("digest").agg(F.min(F.struct("doc", "key")).alias("e"), F.count(F.lit(1)).alias("rows")))
    spans = verified(repeated_spans(texts, hashed, least.select("e.doc", "e.key").distinct(), span, gram), hashed)
    copies = join_heavy(ids, least, "digest", "rows").select("doc", "key", (F.col("doc") > F.col("e.doc")).alias("sub_copy")).where("sub_copy")
    per_doc = spans.groupBy("doc", "key").agg(F.collect_list(F.struct("start", "words")).alias("sub_spans"))
    plan = copies.join(per_doc, ["doc", "key"], "full").withColumnsRenamed({"doc": "sub_doc", "key": "sub_key"})
    joined = rows.join(plan, ["sub_doc", "sub_key"], "left").drop("sub_doc", "sub_key", "sub_digest")
    joined = joined.withColumn("sub_copy", F.coalesce("sub_copy", F.lit(False)))
    found = [T.StructField("sub_words", T.LongType()), T.StructField("sub_removed", T.LongType()), T.StructField("sub_kept", T.StringType())]
    out = joined.mapInArrow(_keep(span), T.StructType([rows.schema["own"], *found]))
    return out.select(*[F.col("own")[c].alias(c) for c in rest], *[f.name for f in found])
