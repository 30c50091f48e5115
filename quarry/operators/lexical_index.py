"""A stored lexical index: posting lists by document block, opened by path, extended by appends.

Layout under a path:

* ``lists``     one row per (block, token): ids in order, term frequencies, document lengths, the
                list's length and its occurrences; partitioned by segment, bucketed by block
* ``docs``      id of every document, by segment
* ``df``        token, df per segment (an append adds its own counts, nothing is rewritten)
* ``manifest``  one small file per version: parameters, segments with their counts and fingerprint

A build shuffles each text once, to its block; Spark tokenizes it there, row by row, and one Arrow function
counts the block's tokens: no row per token or posting is made, sorted or shuffled.

A version is what its manifest lists.  A build or append writes its segment
first and renames the new manifest into place last, so a reader sees the old
version or the new one; what a failed append left behind is in no manifest.
idf, average length and document weights follow from the counts of the version
at hand: posting lists hold raw frequencies and stay as they are.

Search sends every query to every block and scores a block in one task
(``score_block``): no posting is shuffled and no row per (query, document) is
made.  Queries are packed, many to a row: their terms are numbers of (token,
weight) pairs and the row is compressed, since it is copied to every block.  A
task takes a bounded number of queries; more come in further rounds.  The
largest contribution a token can make in a block bounds what terms not yet read
can add.  Terms are taken by falling bound; once the rest cannot lift a new
document over the threshold, it is looked up only for documents that can still
reach it.  Many queries are taken in batches instead: the lists that
most of them read are spread out as rows of a matrix and multiplied at once, the
others added up query by query.  With many blocks a first pass over some of them gives every
query its threshold (its k-th best score there), and blocks whose bounds stay
below are skipped.  All of it is exact: a bound below the threshold by more than
``MARGIN`` cannot change the rounded order.
"""

from __future__ import annotations

import hashlib
import json
import uuid
from dataclasses import asdict

import numpy as np
import pyarrow as pa
import pyarrow.compute as pc
from pyspark.sql import Column, DataFrame, SparkSession, Window
from pyspark.sql import functions as F
from pyspark.sql import types as T
from pyspark.sql.pandas.types import to_arrow_type

from quarry.functions.text import split_tokens, token_text
from quarry.operators import bm25
from quarry.operators.topk import SCORE_PRECISION, top_k_by_score
from quarry.plans import sizing
from quarry.session import materialize
from quarry.sources import tables

BLOCK_DOCS = 16_384
#: Characters of a block's documents on average, at most: a block is built and searched in one task.
BLOCK_CHARS = 64_000_000
#: Block numbers of a segment start at its number times this.
SEGMENT = 1 << 32
#: Above the rounding of scores and the error of their sums.
MARGIN = 1e-5
#: Up to so many postings of a query in a block are added up at once; bounds pay off above.
DIRECT = 16_384
#: From so many queries on a block takes them together, so many at a time.
BATCH = 256
#: Of a batch, a token's list is spread out as a row of the matrix product if reading it query by query would touch
#: more than one in so many cells; the rows of a block take up to so many bytes.
CELLS, MATRIX_BYTES = 64, 128 * 1024 * 1024
#: With this many blocks and more, one in so many gives thresholds first, then one in a quarter of that, if this is many still.
FIRST_PASS, NEXT_PASS = 32, 4
#: Terms of the queries packed into one row, each query counted as 32 more, and queries that a block is asked at once: they
#: bound what a task holds of queries and of what it finds.
PACK_TERMS, ROUND_QUERIES = 1 << 20, 1 << 17


class LexicalIndex:
    """One version of the index under a path."""

    def __init__(self, spark: SparkSession, path: str, manifest: dict):
        self.spark, self.path, self.manifest = spark, path.rstrip("/"), manifest
        self.id_col = manifest["id_col"]
        self.params = bm25.Bm25Params(**manifest["params"])
        self.segments = manifest["segments"]
        self._register()

    # ------------------------------------------------------------------ opening
    @classmethod
    def open(cls, spark: SparkSession, path: str, version: int | None = None) -> "LexicalIndex":
        """The newest version under a path (or the given one)."""
        found = _versions(spark, path)
        if not found or (version is not None and version not in found):
            raise FileNotFoundError(f"no index version under {path}")
        text = spark.read.text(_manifest(path, version or max(found)), wholetext=True).first()["value"]
        return cls(spark, path, json.loads(text))

    @classmethod
    def build(cls, corpus: DataFrame, path: str, id_col: str = "doc_id", params: bm25.Bm25Params | None = None,
              postings: DataFrame | None = None, buckets: int | None = None) -> "LexicalIndex":
        """Version 1 from a corpus.  ``postings`` (token, id, tf, doc_len) of the same corpus save a tokenization."""
        spark = corpus.sparkSession
        manifest = {"version": 0, "id_col": id_col, "id_type": corpus.schema[id_col].dataType.simpleString(),
                    "params": asdict(params or bm25.Bm25Params()), "buckets": buckets or tables.choose_buckets(corpus), "segments": []}
        return cls(spark, path, manifest)._extended(corpus, postings)

    @classmethod
    def open_or_build(cls, corpus: DataFrame, path: str, id_col: str = "doc_id") -> "LexicalIndex":
        """Reopens the index if its fingerprint is that of ``corpus``; else builds it (path without an index)."""
        spark = corpus.sparkSession
        if not _versions(spark, path):
            return cls.build(corpus, path, id_col)
        index = cls.open(spark, path)
        if index.fingerprint() != _print(corpus, id_col):
            raise ValueError(f"the index under {path} was built from another corpus")
        return index

    def append(self, corpus: DataFrame) -> "LexicalIndex":
        """The next version, with the documents of ``corpus`` whose ids are not indexed yet."""
        old = self.documents().select(self.id_col)
        return self._extended(corpus.join(old, self.id_col, "left_anti"), None)

    def fingerprint(self) -> list[int]:
        """Number of documents and sum of their hashes, whatever their order and segments."""
        return [sum(s["n_docs"] for s in self.segments), sum(s["hash"] for s in self.segments)]

    def _register(self) -> None:
        self.lists_table = "quarry_lists_" + hashlib.sha256(self.path.encode()).hexdigest()[:16]
        kind = self.manifest["id_type"]
        self.spark.sql(
            f"CREATE TABLE IF NOT EXISTS {self.lists_table} (block BIGINT, token STRING, ids ARRAY<{kind}>, tf ARRAY<INT>, "
            f"len ARRAY<INT>, df BIGINT, n BIGINT, segment STRING) USING parquet OPTIONS (partitionOverwriteMode 'dynamic') PARTITIONED BY (segment) "
            f"CLUSTERED BY (block) SORTED BY (block, token) INTO {self.manifest['buckets']} BUCKETS LOCATION '{self.path}/lists'")
        if self.segments:
            self.spark.sql(f"MSCK REPAIR TABLE {self.lists_table}")

    # ------------------------------------------------------------------ writing
    def _extended(self, corpus: DataFrame, postings: DataFrame | None) -> "LexicalIndex":
        spark, number, name = self.spark, len(self.segments), uuid.uuid4().hex[:12]
        n, total_hash, n_chars = _measured(corpus, self.id_col)
        n_blocks = max(1, -(-n // BLOCK_DOCS), -(-n_chars // BLOCK_CHARS), min(spark.sparkContext.defaultParallelism, -(-n // 256)))
        blocks = _block_numbers(spark, number * SEGMENT, n_blocks, self.manifest["buckets"])
        block = F.element_at(blocks, (F.pmod(F.xxhash64(self.id_col), F.lit(n_blocks)) + 1).cast("int"))
        if postings is None:
            texts = corpus.select(block.alias("block"), F.col(self.id_col).alias("ids"), bm25.default_text(corpus).alias("text"))
            # Sorted as texts, so that the tokens of a block's documents are never held as rows.
            texts = texts.repartition(self.manifest["buckets"], "block").sortWithinPartitions("block")
            rows, listed = texts.select("block", "ids", token_text("text").alias("tokens")), token_lists
        else:
            rows = postings.withColumn("block", block).repartition(self.manifest["buckets"], "block")
            rows = rows.select("block", "token", F.col(self.id_col).alias("ids"), F.col("tf").cast("int").alias("tf"),
                               F.col("doc_len").cast("int").alias("len"))
            listed = block_lists
        kind = self.manifest["id_type"]
        lists = rows.groupBy("block").applyInArrow(
            _counted(listed), f"block BIGINT, token STRING, ids ARRAY<{kind}>, tf ARRAY<INT>, len ARRAY<INT>, df BIGINT, n BIGINT")
        lists.withColumn("segment", F.lit(name)).write.insertInto(self.lists_table, overwrite=True)
        corpus.select(self.id_col).write.parquet(f"{self.path}/docs/segment={name}")
        own = spark.table(self.lists_table).where(F.col("segment") == name)
        counts = f"{self.path}/df/segment={name}"
        own.groupBy("token").agg(F.sum("df").alias("df"), F.sum("n").alias("n")).write.parquet(counts)
        n_tokens = spark.read.schema("n BIGINT").parquet(counts).agg(F.coalesce(F.sum("n"), F.lit(0))).first()[0]
        segment = {"name": name, "n_docs": n, "n_tokens": int(n_tokens), "hash": total_hash, "n_blocks": n_blocks}
        manifest = {**self.manifest, "version": self.manifest["version"] + 1, "segments": [*self.segments, segment]}
        _commit(spark, self.path, manifest)
        return LexicalIndex(spark, self.path, manifest)

    # ------------------------------------------------------------------ contents
    def _of_version(self, df: DataFrame) -> DataFrame:
        return df.where(F.col("segment").isin([s["name"] for s in self.segments]))

    def lists(self) -> DataFrame:
        return self._of_version(self.spark.table(self.lists_table)).select("block", "token", "ids", "tf", "len", "segment")

    def documents(self) -> DataFrame:
        """The ids of all documents."""
        schema = f"`{self.id_col}` {self.manifest['id_type']}"
        paths = [f"{self.path}/docs/segment={s['name']}" for s in self.segments]
        return self.spark.read.schema(schema).parquet(*paths) if paths else self.spark.createDataFrame([], schema)

    def _idf(self) -> tuple[DataFrame, Column]:
        df = self.spark.read.schema("token STRING, df BIGINT").parquet(*[f"{self.path}/df/segment={s['name']}" for s in self.segments])
        if len(self.segments) > 1:
            df = df.groupBy("token").agg(F.sum("df").alias("df"))
        return bm25.idf_table(df, F.lit(sum(s["n_docs"] for s in self.segments)), self.params)

    def term_stats(self) -> DataFrame:
        """(token, df, idf) of this version."""
        return self._idf()[0]

    def corpus_stats(self) -> DataFrame:
        """One row: n_docs, n_tokens, avgdl, n_terms, avg_idf of this version."""
        n_docs, n_tokens = (F.lit(sum(s[c] for s in self.segments)).cast("long") for c in ("n_docs", "n_tokens"))
        stats, avg_idf = self._idf()
        return stats.agg(F.count(F.lit(1)).alias("n_terms")).select(
            n_docs.alias("n_docs"), n_tokens.alias("n_tokens"), F.when(n_docs > 0, n_tokens / n_docs).alias("avgdl"), "n_terms",
            avg_idf.alias("avg_idf"))

    def average_length(self) -> float:
        n = sum(s["n_docs"] for s in self.segments)
        return sum(s["n_tokens"] for s in self.segments) / n if n else 0.0

    # ------------------------------------------------------------------ search
    def weighted_terms(self, queries: DataFrame, qid_col: str = "qid", text_col: str = "question",
                       term_stats: DataFrame | None = None) -> DataFrame:
        """One row per query: its known tokens and their weights (occurrences in the query times idf)."""
        terms = sizing.broadcast_if_small(bm25.query_terms(queries, qid_col, text_col))
        terms = (term_stats or self.term_stats()).select("token", "idf").join(terms, "token")
        entry = F.struct("token", (F.col("qtf") * F.col("idf")).alias("weight"))
        packed = terms.groupBy(qid_col).agg(F.array_sort(F.collect_list(entry)).alias("e"))
        return materialize(packed.select(qid_col, F.col("e.token").alias("tokens"), F.col("e.weight").alias("weights")), "terms")

    def top_k(self, queries: DataFrame, k: int = 100, qid_col: str = "qid", text_col: str = "question",
              precision: int | None = SCORE_PRECISION, term_stats: DataFrame | None = None,
              first_pass: int = FIRST_PASS, direct: int = DIRECT) -> DataFrame:
        """(qid, doc_id, score, rank) of the k best documents that share a token with the query.

        ``first_pass`` and ``direct`` choose between equal ways; see the module's text.
        """
        asked = self.weighted_terms(queries, qid_col, text_col, term_stats)
        rounds = -(-asked.count() // ROUND_QUERIES)
        wanted = asked.select(F.explode("tokens").alias("token")).distinct()
        lists = self.lists().drop("segment")
        if sizing.fits(wanted):  # else lists that no query asks for are read as well: a shuffle of all lists would cost more
            lists = lists.join(F.broadcast(wanted), "token", "left_semi")
        order, how = (k, qid_col, self.id_col), (precision, direct, rounds)
        steps = [first_pass] if sum(s["n_blocks"] for s in self.segments) >= first_pass else []
        while steps and steps[-1] // NEXT_PASS >= NEXT_PASS:
            steps.append(steps[-1] // NEXT_PASS)
        blocks = F.concat(*[_block_numbers(self.spark, i * SEGMENT, s["n_blocks"], self.manifest["buckets"])
                            for i, s in enumerate(self.segments)])
        floors, found, before = None, None, 0
        for step in [*steps, 1]:
            mine = F.filter(blocks, lambda _, i: (i % step == 0) & (i % before != 0 if before else F.lit(True))) if steps else blocks
            made = self._scored(lists.where(F.array_contains(mine, F.col("block"))) if steps else lists, asked, floors, mine, *order, *how)
            ranked = top_k_by_score(made if found is None else found.unionByName(made), *order, precision=precision)
            if step > 1:
                ranked = materialize(ranked, "first_pass")
                floors = ranked.where(F.col("rank") == k).select(qid_col, F.col("score").alias("floor"))
                found, before = ranked.drop("rank"), step
        return ranked

    def _scored(self, lists: DataFrame, asked: DataFrame, floors: DataFrame | None, blocks: Column, k: int, qid_col: str, id_col: str,
                precision: int | None, direct: int, rounds: int) -> DataFrame:
        """The k best of each of the ``blocks``, whose ``lists`` these are, and not below the query's floor if it has one."""
        kind = asked.schema[qid_col]
        schema = T.StructType([kind, T.StructField(id_col, lists.schema["ids"].dataType.elementType),
                               T.StructField("score", T.DoubleType())])
        kernel = score_block(k, qid_col, id_col, to_arrow_type(kind.dataType), self.params, self.average_length(), precision, direct)
        asked = asked.withColumn("floor", F.lit(None).cast("double")) if floors is None else asked.join(floors, qid_col, "left")
        made = None
        for i in range(max(1, rounds)):
            part = asked if rounds <= 1 else asked.where(F.pmod(F.xxhash64(qid_col), F.lit(rounds)) == i)
            sent = part.mapInArrow(pack_queries(qid_col), "packed binary").withColumn("block", F.explode(blocks))
            found = lists.groupBy("block").cogroup(sent.groupBy("block")).applyInArrow(kernel, schema)
            made = found if made is None else made.unionByName(found)
        return made


def block_lists(rows: pa.Table) -> pa.Table:
    """Group function: the posting lists of one block, by token, each in id order."""
    (token, tokens), (place, _) = _ranked(rows.column("token")), _ranked(rows.column("ids"))
    order = np.lexsort((place, token))
    ends = pa.array(np.r_[0, np.cumsum(np.bincount(token, minlength=len(tokens)))].astype(np.int32))
    listed = [pa.ListArray.from_arrays(ends, rows.column(c).combine_chunks().take(pa.array(order))) for c in ("ids", "tf", "len")]
    block = pa.array(np.full(len(tokens), rows.column("block")[0].as_py(), np.int64))
    return pa.table([block, tokens, *listed], names=["block", "token", "ids", "tf", "len"])


def token_lists(rows: pa.Table) -> pa.Table:
    """Group function: the posting lists of one block from its documents' ``token_text``; rows of one id and length are one."""
    (values, length), (place, ids) = split_tokens(rows.column("tokens").combine_chunks()), _ranked(rows.column("ids"))
    base = int(length.max(initial=0)) + 1
    document, number = np.unique(place * base + length, return_inverse=True)
    coded = values.dictionary_encode()
    order = pc.sort_indices(coded.dictionary)
    rank = np.empty(len(order), np.int64)
    rank[order.to_numpy()] = np.arange(len(order))
    key = rank[coded.indices.to_numpy(zero_copy_only=False)] * len(document)
    key += np.repeat(number, length)
    key.sort()
    first = np.flatnonzero(np.r_[True, key[1:] != key[:-1]][:len(key)])
    tf = np.diff(np.r_[first, len(key)]).astype(np.int32)
    token, at = np.divmod(key[first], len(document))
    ends = pa.array(np.r_[0, np.cumsum(np.bincount(token, minlength=len(order)))].astype(np.int32))
    own = document[at]
    listed = [pa.ListArray.from_arrays(ends, values) for values in (
        ids.take(pa.array(own // base)), pa.array(tf), pa.array((own % base).astype(np.int32)))]
    block = pa.array(np.full(len(order), rows.column("block")[0].as_py(), np.int64))
    return pa.table([block, coded.dictionary.take(order), *listed], names=["block", "token", "ids", "tf", "len"])


def _counted(listed):
    """The group function ``listed`` with each list's length (``df``) and occurrences (``n``)."""
    def run(rows: pa.Table) -> pa.Table:
        made = listed(rows)
        tf = made.column("tf").combine_chunks()
        df = tf.value_lengths().to_numpy(zero_copy_only=False).astype(np.int64)
        sums = np.r_[0, np.cumsum(tf.flatten().to_numpy(zero_copy_only=False), dtype=np.int64)]
        ends = np.cumsum(df)
        return made.append_column("df", pa.array(df)).append_column("n", pa.array(sums[ends] - sums[ends - df]))
    return run


def _ranked(column: pa.ChunkedArray) -> tuple[np.ndarray, pa.Array]:
    """Every value's place among the distinct ones, and these in order, null first."""
    coded = column.combine_chunks().dictionary_encode(null_encoding="encode")
    order = pc.sort_indices(coded.dictionary, null_placement="at_start")
    place = np.empty(len(order), np.int64)
    place[order.to_numpy()] = np.arange(len(order))
    return place[coded.indices.to_numpy(zero_copy_only=False)], coded.dictionary.take(order)


def pack_queries(qid_col: str):
    """Arrow function: queries and their terms, many to a row, as a block is sent them: numbers of (token, weight) in a compressed table."""
    def run(batches):
        held, size = [], 0
        for batch in batches:
            ends = np.cumsum(pc.fill_null(pc.list_value_length(batch.column("tokens")), 0).to_numpy(zero_copy_only=False) + 32)
            lo = 0
            while lo < batch.num_rows:
                room = PACK_TERMS - size + (ends[lo - 1] if lo else 0)
                hi = max(int(np.searchsorted(ends, room, "right")), lo + (not held))
                if hi > lo:
                    held.append(batch.slice(lo, hi - lo))
                    size += int(ends[hi - 1] - (ends[lo - 1] if lo else 0))
                if hi < batch.num_rows:
                    yield _packed(pa.Table.from_batches(held), qid_col)
                    held, size = [], 0
                lo = hi
        if held:
            yield _packed(pa.Table.from_batches(held), qid_col)
    return run


def _packed(rows: pa.Table, qid_col: str) -> pa.RecordBatch:
    """One row: distinct (token, weight) pairs by falling use, and of each query the numbers of its pairs as rising differences, byte by byte."""
    tokens, weights = (rows.column(c).combine_chunks() for c in ("tokens", "weights"))
    token, weight = (a.flatten().dictionary_encode() for a in (tokens, weights))
    terms, kinds = tokens.value_lengths().to_numpy(zero_copy_only=False), max(len(weight.dictionary), 1)
    pair = token.indices.to_numpy(zero_copy_only=False).astype(np.int64) * kinds + weight.indices.to_numpy(zero_copy_only=False)
    pairs, code, uses = np.unique(pair, return_inverse=True, return_counts=True)
    order = np.argsort(-uses, kind="stable")
    number = np.empty(len(order), np.int64)
    number[order] = np.arange(len(order))
    which = np.repeat(np.arange(len(terms)), terms)
    code = np.sort(which * max(len(pairs), 1) + number[code]) - which * max(len(pairs), 1)
    step = np.diff(code, prepend=0)
    first = (np.cumsum(terms) - terms)[terms > 0]
    step[first] = code[first]
    lists = {"qid": rows.column(qid_col).combine_chunks(), "floor": rows.column("floor").combine_chunks(), "terms": pa.array(terms),
             "weight": weight.dictionary.take(pa.array(pairs[order] % kinds))}
    table = {c: pa.ListArray.from_arrays(pa.array([0, len(v)], pa.int32()), v) for c, v in lists.items()}
    table["step"] = pa.array([step.astype("<u4").view(np.uint8).reshape(-1, 4).T.tobytes()], pa.binary())
    table["token"] = pa.array([" ".join(token.dictionary.take(pa.array(pairs[order] // kinds)).to_pylist())])
    table, sink = pa.table(table), pa.BufferOutputStream()
    with pa.ipc.new_stream(sink, table.schema, options=pa.ipc.IpcWriteOptions(compression="zstd")) as out:
        out.write_table(table)
    return pa.record_batch([pa.array([sink.getvalue().to_pybytes()], pa.binary())], names=["packed"])


def _unpacked(packed: pa.Buffer) -> tuple[pa.Array, np.ndarray, np.ndarray, np.ndarray, pa.Array, np.ndarray]:
    """Of a packed row: the queries' ids and floors, each term's query and number, and the numbered tokens and weights."""
    table = pa.ipc.open_stream(packed).read_all()
    qids, floors, terms, weights = (table.column(c).combine_chunks().flatten() for c in ("qid", "floor", "terms", "weight"))
    terms = terms.to_numpy(zero_copy_only=False)
    step = np.frombuffer(table.column("step")[0].as_py(), np.uint8).reshape(4, -1).T.copy().view("<u4").ravel()
    sums, which = np.r_[0, np.cumsum(step, dtype=np.int64)], np.repeat(np.arange(len(terms)), terms)
    code = sums[1:] - sums[np.cumsum(terms) - terms][which]
    text = table.column("token")[0].as_py()
    return (qids, floors.fill_null(-np.inf).to_numpy(zero_copy_only=False), which, code, pa.array(text.split(" ") if len(weights) else [], pa.string()),
            weights.to_numpy(zero_copy_only=False))


def score_block(k: int, qid_col: str, id_col: str, qid_type: pa.DataType, params: bm25.Bm25Params, avgdl: float, precision: int | None,
                direct: int = DIRECT):
    """Co-group function: the k best documents of one block for each query."""
    def run(lists: pa.Table, rows: pa.Table) -> pa.Table:
        schema = pa.schema([(qid_col, qid_type), (id_col, lists.schema.field("ids").type.value_type), ("score", pa.float64())])
        found = [schema.empty_table()]
        block = _Block(lists, params, avgdl, direct) if lists.num_rows and rows.num_rows else None
        for packed in rows.column("packed") if block else ():
            qids, floors, which, code, tokens, weights = _unpacked(packed.as_buffer())
            at = pc.index_in(tokens, value_set=lists.column("token").combine_chunks()).fill_null(-1).to_numpy(zero_copy_only=False)
            at, weights = at[code], weights[code]
            which, at, weights = which[at >= 0], at[at >= 0], weights[at >= 0]
            which, docs, scores = block.search(which, at, weights, floors, k, precision)
            found.append(pa.table([qids.take(pa.array(which)).cast(qid_type), block.ids.take(pa.array(docs)), pa.array(scores, pa.float64())],
                                  schema=schema))
        return pa.concat_tables(found)
    return run


class _Block:
    """The posting lists of one block; documents are numbered in id order."""

    def __init__(self, lists: pa.Table, params: bm25.Bm25Params, avgdl: float, direct: int = DIRECT):
        self.direct = direct
        column = lists.column("ids").combine_chunks()
        self.ends = np.r_[0, np.cumsum(column.value_lengths().to_numpy(zero_copy_only=False))]
        coded = column.flatten().dictionary_encode()
        order = pc.sort_indices(coded.dictionary)
        self.ids = coded.dictionary.take(order)
        place = np.empty(len(order), np.int64)
        place[order.to_numpy()] = np.arange(len(order))
        self.docs = place[coded.indices.to_numpy(zero_copy_only=False)]
        tf, length = (lists.column(c).combine_chunks().flatten().to_numpy(zero_copy_only=False).astype(np.float64) for c in ("tf", "len"))
        self.part = tf * (params.k1 + 1) / (tf + params.k1 * (1 - params.b + params.b * length / avgdl))
        self._merge()
        self.most = np.maximum.reduceat(self.part, self.ends[:-1])
        self.read = 0  # postings added up; the rest was skipped by bounds

    def _merge(self) -> None:
        """Documents that share an id are one: its postings in a list, side by side, are added up."""
        new = np.r_[True, self.docs[1:] != self.docs[:-1]]
        new[self.ends[:-1]] = True
        if not new.all():
            first = np.flatnonzero(new)
            self.docs, self.part = self.docs[first], np.add.reduceat(self.part, first)
            self.ends = np.searchsorted(first, self.ends)

    def search(self, which: np.ndarray, at: np.ndarray, weight: np.ndarray, floors: np.ndarray, k: int,
               precision: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """(query, document, score) of the k best of each query; ``which``, ``at`` and ``weight`` hold its lists, by query."""
        n = len(floors)
        ends = np.searchsorted(which, np.arange(n + 1))
        known = np.diff(ends) > 0
        together = known & (np.bincount(which[weight <= 0], minlength=n) == 0)
        together &= np.bincount(which, weight * self.most[at], n) >= floors - MARGIN
        if together.sum() < BATCH:
            together[:] = False
        found = [self._together(which, at, weight, ends, np.flatnonzero(together), floors, k, precision)]
        for q in np.flatnonzero(known & ~together):
            own = slice(ends[q], ends[q + 1])
            docs, scores = self.best(at[own], weight[own], k, floors[q], precision)
            found.append((np.full(len(docs), q), docs, scores))
        return tuple(np.concatenate(x) for x in zip(*found))

    def _together(self, which: np.ndarray, at: np.ndarray, weight: np.ndarray, ends: np.ndarray, asked: np.ndarray,
                  floors: np.ndarray, k: int, precision: int | None) -> tuple[np.ndarray, np.ndarray, np.ndarray]:
        """Queries with positive weights alone, in batches: every posting of their lists is added up."""
        size, length, out = len(self.ids), np.diff(self.ends), [(np.zeros(0, np.int64), np.zeros(0, np.int64), np.zeros(0))]
        gain = np.bincount(at, minlength=len(length)) * length
        spread = np.argsort(-gain, kind="stable")[:MATRIX_BYTES // (8 * size)]
        spread = spread[gain[spread] * CELLS > len(asked) * size] if len(asked) else spread[:0]
        row = np.full(len(length), -1)
        row[spread] = np.arange(len(spread))
        matrix = np.zeros((len(spread), size))
        for i, token in enumerate(spread):
            docs, part = self.postings(token)
            matrix[i, docs] = part
        margin = MARGIN if precision is None else max(MARGIN, 10.0 ** -precision)
        width = max(1, min(256, size // (4 * k)))  # k of the best of so many neighbours bound the k-th best from below
        for lo in range(0, len(asked), BATCH):
            chunk = asked[lo:lo + BATCH]
            factor = np.zeros((len(chunk), len(spread)))
            for i, q in enumerate(chunk):
                own = slice(ends[q], ends[q + 1])
                factor[i, row[at[own]][row[at[own]] >= 0]] = weight[own][row[at[own]] >= 0]
            score = factor @ matrix
            for i, q in enumerate(chunk):
                own = slice(ends[q], ends[q + 1])
                few = row[at[own]] < 0
                docs, part = self._gathered(at[own][few], weight[own][few])
                score[i] += np.bincount(docs, part, size)
                self.read += int(length[at[own]].sum())
            floor = np.maximum(floors[chunk], 0.0)
            groups = size // width
            if groups >= k:
                best = score[:, :groups * width].reshape(len(chunk), groups, width).max(axis=2)
                floor = np.maximum(floor, np.partition(best, groups - k, axis=1)[:, groups - k])
            query, docs = np.nonzero((score > 0) & (score >= (floor - margin)[:, None]))
            value = score[query, docs]
            shown = value if precision is None else np.round(value, precision)
            order = np.lexsort((docs, -shown, query))
            query, docs, value = query[order], docs[order], value[order]
            first = np.searchsorted(query, np.arange(len(chunk)))
            kept = np.arange(len(query)) - first[query] < k
            out.append((chunk[query[kept]], docs[kept], value[kept]))
        return tuple(np.concatenate(x) for x in zip(*out))

    def postings(self, at: int) -> tuple[np.ndarray, np.ndarray]:
        lo, hi = self.ends[at], self.ends[at + 1]
        return self.docs[lo:hi], self.part[lo:hi]

    def best(self, at: np.ndarray, weight: np.ndarray, k: int, floor: float, precision: int | None) -> tuple[np.ndarray, np.ndarray]:
        if not len(at):
            return np.zeros(0, np.int64), np.zeros(0)
        prune = bool((weight > 0).all())
        bound = weight * self.most[at]
        if prune and bound.sum() < floor - MARGIN:
            return np.zeros(0, np.int64), np.zeros(0)
        if (self.ends[at + 1] - self.ends[at]).sum() <= self.direct or not prune:
            return self._all(at, weight, k, precision, prune)
        order = np.argsort(-bound, kind="stable")
        at, weight, bound = at[order], weight[order], bound[order]
        rest = np.r_[np.cumsum(bound[::-1])[::-1], 0.0]  # most that terms from i on can add
        score, look = np.zeros(len(self.ids)), 2
        for i in range(len(at)):
            if i == look:
                look *= 2
                if k <= len(score):
                    floor = max(floor, np.partition(score, len(score) - k)[len(score) - k])
            if rest[i] < floor - MARGIN:
                docs = np.flatnonzero(score + rest[i] >= floor - MARGIN)
                return _first(docs, self._finish(docs, score, at[i:], weight[i:]), k, precision)
            docs, part = self.postings(at[i])
            score[docs] += weight[i] * part
            self.read += len(docs)
        docs = np.flatnonzero(score)
        return _first(docs, score[docs], k, precision)

    def _gathered(self, at: np.ndarray, weight: np.ndarray) -> tuple[np.ndarray, np.ndarray]:
        """The postings of several lists, each times its weight."""
        if not len(at):
            return self.docs[:0], self.part[:0]
        spans = [slice(a, b) for a, b in zip(self.ends[at].tolist(), self.ends[at + 1].tolist())]
        docs, part = (np.concatenate([c[s] for s in spans]) for c in (self.docs, self.part))
        return docs, part * np.repeat(weight, self.ends[at + 1] - self.ends[at])

    def _all(self, at: np.ndarray, weight: np.ndarray, k: int, precision: int | None, positive: bool) -> tuple[np.ndarray, np.ndarray]:
        """Every posting added up; a document can match with a score of zero unless all weights are positive."""
        docs, part = self._gathered(at, weight)
        score = np.bincount(docs, part, len(self.ids))
        self.read += len(docs)
        found = np.flatnonzero(score) if positive else np.unique(docs)
        return _first(found, score[found], k, precision)

    def _finish(self, docs: np.ndarray, score: np.ndarray, at: np.ndarray, weight: np.ndarray) -> np.ndarray:
        """Full scores of ``docs``: their postings of the terms left, looked up where lists are long."""
        more = np.zeros(len(docs))
        for i, w in zip(at, weight):
            own, part = self.postings(i)
            if len(own) <= 8 * len(docs):
                score[own] += w * part
                self.read += len(own)
            else:
                where = np.minimum(np.searchsorted(own, docs), len(own) - 1)
                more += np.where(own[where] == docs, w * part[where], 0.0)
        return score[docs] + more


def _first(docs: np.ndarray, score: np.ndarray, k: int, precision: int | None) -> tuple[np.ndarray, np.ndarray]:
    """The k best, ties to the lesser document."""
    shown = score if precision is None else np.round(score, precision)
    if len(docs) > k:
        edge = np.partition(shown, len(docs) - k)[len(docs) - k]
        above, ties = shown > edge, np.flatnonzero(shown == edge)
        take = np.sort(np.r_[np.flatnonzero(above), ties[:k - above.sum()]])
        docs, score = docs[take], score[take]
    return docs, score


def _block_numbers(spark: SparkSession, start: int, n: int, buckets: int) -> Column:
    """The ``n`` numbers of a segment's blocks, as a constant array.

    Up to four blocks a bucket are numbered so that every bucket gets its share;
    more blocks are even enough as they come.
    """
    if n > 4 * buckets:
        return F.sequence(F.lit(start).cast("long"), F.lit(start + n - 1).cast("long"))
    candidates = spark.range(start, start + 64 * max(n, buckets)).select("id", F.pmod(F.hash("id"), F.lit(buckets)).alias("b"))
    turn = F.row_number().over(Window.partitionBy("b").orderBy("id"))
    chosen = candidates.withColumn("turn", turn).orderBy("turn", "b").limit(n).collect()
    return F.array(*[F.lit(r["id"]).cast("long") for r in chosen])


# ---------------------------------------------------------------------- manifest files
def _measured(corpus: DataFrame, id_col: str) -> tuple[int, int, int]:
    """Number of documents, sum of their hashes, and characters."""
    text = bm25.default_text(corpus)
    row = corpus.agg(F.count(F.lit(1)), F.sum(F.xxhash64(F.col(id_col), text).cast("decimal(38,0)")), F.sum(F.length(text))).first()
    return int(row[0]), int(row[1] or 0), int(row[2] or 0)


def _print(corpus: DataFrame, id_col: str) -> list[int]:
    return list(_measured(corpus, id_col)[:2])


def _manifest(path: str, version: int) -> str:
    return f"{path.rstrip('/')}/manifest/v{version:08d}.json"


def _folder(spark: SparkSession, path: str):
    jvm = spark._jvm.org.apache.hadoop.fs
    folder = jvm.Path(path)
    return jvm, folder, folder.getFileSystem(spark._jsparkSession.sessionState().newHadoopConf())


def _versions(spark: SparkSession, path: str) -> list[int]:
    _, folder, fs = _folder(spark, f"{path.rstrip('/')}/manifest")
    if not fs.exists(folder):
        return []
    names = [f.getPath().getName() for f in fs.listStatus(folder)]
    return sorted(int(n[1:9]) for n in names if n.startswith("v") and n.endswith(".json"))


def _commit(spark: SparkSession, path: str, manifest: dict) -> None:
    """Writes the manifest beside its place and renames it; a version that is there already is not replaced."""
    target = _manifest(path, manifest["version"])
    jvm, folder, fs = _folder(spark, f"{path.rstrip('/')}/manifest")
    draft = jvm.Path(f"{path.rstrip('/')}/manifest/_draft-{uuid.uuid4().hex}")
    fs.mkdirs(folder)
    out = fs.create(draft, False)
    out.write(bytearray(json.dumps(manifest).encode("utf-8")))
    out.close()
    if fs.exists(jvm.Path(target)) or not fs.rename(draft, jvm.Path(target)):
        fs.delete(draft, False)
        raise RuntimeError(f"another writer made version {manifest['version']} of {path}")
