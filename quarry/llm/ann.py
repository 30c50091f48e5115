"""Approximate nearest neighbours by inner product with a hierarchical k-means tree.

Fit: k-means in k-means on at most ``sample`` vectors, those with the least
hashes.  Index: every distinct vector goes down the tree to a leaf.  Search:
best-bin-first; a priority queue opens the node whose centroid has the largest
inner product with the query, until so many leaves are visited.  An inner node
counts with the most that a leaf's centroid below it can reach, so leaves open
in the order of their own centroids.  How many leaves is calibrated: bounded many sample queries are answered exactly against
all vectors, and visits widen until the wanted recall on them is reached (all
leaves if need be, which is exact).

Leaves next to each other are dealt in groups of about ``block`` vectors; a
query goes to a group once, with the list of its leaves there, and a task scores
the group with one matrix product per leaf and a top k over the group, so at
most k + 1 rows per query and group come out.

Copies: a vector is indexed once, with the ``k + 1`` least ids that have it (no
list of k can need more), so a vector that a third of all rows share costs one
entry.  Equal queries are searched once.  A leaf above ``block`` vectors is dealt
in parts, and queries in parts of at most ``ask_block``, so a task's share has a
bound.

Null and zero vectors, those with null or non-finite components, and those
whose length is not the most frequent one take no part; rows without id
neither.  Rows that repeat an id and vector count once; ids that repeat with
other vectors are neighbours by their best vector only.  Equal scores go by
the lesser id.  Empty tables give no rows.  Extra columns are ignored.
"""

from __future__ import annotations

import heapq
from collections.abc import Iterator

import numpy as np
import pyarrow as pa
from pyspark.sql import Column, DataFrame, Window
from pyspark.sql import functions as F

from quarry.llm.common import cut, join_heavy

SAMPLE = 20_000
BRANCH = 16
LEAF_SAMPLE = 64
CALIBRATION = 400
#: Aimed at on the calibration queries; leaves a margin above 0.9.
RECALL = 0.94
BLOCK = 8192
ASK_BLOCK = 16_384


def kmeans(x: np.ndarray, k: int, rng: np.random.Generator, rounds: int = 12) -> np.ndarray:
    """Centroids of Lloyd's method; empty ones are dropped."""
    c = x[rng.choice(len(x), k, replace=False)]
    for _ in range(rounds):
        near = np.argmin((c ** 2).sum(1) - 2 * x @ c.T, axis=1)
        n = np.bincount(near, minlength=len(c))
        total = np.zeros_like(c)
        np.add.at(total, near, x)
        c = total[n > 0] / n[n > 0, None]
    return c


class Tree:
    """Centroids by node; leaves are numbered from 0."""

    def __init__(self, x: np.ndarray, branch: int = BRANCH, leaf: int = LEAF_SAMPLE, seed: int = 3):
        rng = np.random.default_rng(seed)
        self.children: list[tuple[np.ndarray, list[int]] | None] = []
        self.leaf: dict[int, int] = {}

        def grow(rows: np.ndarray) -> int:
            node = len(self.children)
            self.children.append(None)
            c = kmeans(rows, branch, rng) if len(rows) > max(leaf, branch) else rows[:0]
            near = np.argmin((c ** 2).sum(1) - 2 * rows @ c.T, axis=1) if len(c) > 1 else np.zeros(0, int)
            if len(np.unique(near)) < 2:
                self.leaf[node] = len(self.leaf)
            else:
                self.children[node] = (c, [grow(rows[near == i]) if (near == i).any() else grow(rows[:0]) for i in range(len(c))])
            return node

        grow(x)
        self._measure()

    def _measure(self) -> None:
        """For every child of an inner node, how far the leaves' centroids below lie from its own (0 for a leaf)."""
        def below(node: int, own: np.ndarray) -> np.ndarray:
            if self.children[node] is None:
                return own[None]
            c, nodes = self.children[node]
            under = [below(child, c[i]) for i, child in enumerate(nodes)]
            self.reach[node] = np.array([np.sqrt(((u - c[i]) ** 2).sum(1)).max() for i, u in enumerate(under)])
            return np.concatenate(under)

        self.reach: dict[int, np.ndarray] = {}
        below(0, np.zeros(0))

    def assign(self, x: np.ndarray) -> np.ndarray:
        """The leaf of each row."""
        out = np.empty(len(x), np.int64)

        def down(node: int, rows: np.ndarray) -> None:
            if self.children[node] is None:
                out[rows] = self.leaf[node]
                return
            c, nodes = self.children[node]
            near = np.argmin((c ** 2).sum(1) - 2 * x[rows] @ c.T, axis=1)
            for i, child in enumerate(nodes):
                if len(part := rows[near == i]):
                    down(child, part)

        down(0, np.arange(len(x)))
        return out

    def visit(self, q: np.ndarray, leaves: int) -> list[int]:
        """The first leaves that best-bin-first opens for a query."""
        heap, out, length = [(0.0, 0)], [], float(np.sqrt(q @ q))
        while heap and len(out) < leaves:
            _, node = heapq.heappop(heap)
            if self.children[node] is None:
                out.append(self.leaf[node])
            else:
                c, nodes = self.children[node]
                for s, child in zip((-(c @ q) - length * self.reach[node]).tolist(), nodes):
                    heapq.heappush(heap, (s, child))
        return out


def _matrix(column: pa.Array) -> np.ndarray:
    values = column.flatten().to_numpy(zero_copy_only=False).astype(np.float64)
    return values.reshape(len(column), -1) if len(column) else values.reshape(0, 1)


def usable(vector: Column) -> Column:
    bad = F.exists(vector, lambda v: v.isNull() | F.isnan(v) | (F.abs(v) == float("inf")))
    return vector.isNotNull() & ~bad & F.exists(vector, lambda v: v != 0)


def search(df: DataFrame, queries: Column, k: int = 20, vec_id: str = "vec_id", vector: str = "embedding",
           sample: int = SAMPLE, branch: int = BRANCH, leaf: int = LEAF_SAMPLE, calibration: int = CALIBRATION,
           recall: float = RECALL, block: int = BLOCK, ask_block: int = ASK_BLOCK) -> DataFrame:
    """``query_id, rank, vec_id, score`` of the k nearest found, for each row where ``queries`` holds."""
    rows = df.select(F.col(vec_id).cast("long").alias("id"), F.col(vector).alias("v"), queries.alias("asks")).where(
        F.col("id").isNotNull()).where(usable(F.col("v")))
    width = rows.groupBy(F.size("v").alias("w")).count().orderBy(F.desc("count"), "w").limit(1).select("w")
    rows = rows.where(F.size("v") == width.scalar())
    copies = Window.partitionBy("v").orderBy("id")
    distinct = rows.select("id", "v").withColumn("n", F.dense_rank().over(copies)).where(F.col("n") <= k + 1)
    vectors = cut(distinct.groupBy("v").agg(F.min("id").alias("first"), F.array_sort(F.collect_set("id")).alias("ids")))
    # An entry's key: vectors differ in it, unlike in their first id where an id repeats.
    vectors = vectors.withColumn("key", F.struct("first", F.xxhash64("v").alias("h")))
    kind = vectors.schema["v"].dataType.simpleString()
    first = vectors.orderBy(F.xxhash64("first", "v"), "first").limit(sample).select("v").toArrow().column("v").combine_chunks()
    tree = Tree(_matrix(first), branch, leaf)
    n_leaves = len(tree.leaf)

    def assign(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), pa.array(tree.assign(_matrix(b.column(1))))], ["key", "v", "leaf"])

    key_kind = "struct<first:bigint,h:bigint>"
    placed = cut(vectors.select("key", "v").mapInArrow(assign, f"key {key_kind}, v {kind}, leaf long"))
    asked = rows.where("asks").select(F.col("id").alias("query_id"), "v").distinct()
    counts = asked.groupBy("v").agg(F.count(F.lit(1)).alias("n"))
    asked = cut(join_heavy(asked, vectors.select("v", "key").join(counts, "v"), "v", "n").select("query_id", "key"))
    searched = cut(placed.join(asked.select("key").distinct(), "key", "left_semi").select(F.col("key").alias("q"), F.col("v").alias("qv")))
    visits = _calibrate(tree, placed, searched, k, calibration, recall) if n_leaves > 1 else 1
    sizes = {r["leaf"]: r["n"] for r in placed.groupBy("leaf").agg(F.count(F.lit(1)).alias("n")).collect()}  # a row per leaf
    # Smaller groups while there are fewer than tasks: a group's size changes how rows are dealt, not what is found.
    tasks = 4 * df.sparkSession.sparkContext.defaultParallelism
    group, parts = deal(sizes, n_leaves, max(256, min(block, -(-sum(sizes.values()) // tasks))))

    def visit(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        names = ["q", "x", "group", "part", "leaves"]
        for b in batches:
            for i in range(0, b.num_rows, 1024):
                part = b.slice(i, 1024)
                rows, cols = [], ([], [], [])
                for j, q in enumerate(_matrix(part.column(1))):
                    opened = np.sort(np.array(tree.visit(q, visits), dtype=np.int64))
                    own, at = np.unique(group[opened], return_index=True)
                    for g, leaves in zip(own.tolist(), np.split(opened, at[1:])):
                        for p in range(parts[g]):
                            rows.append(j)
                            for c, value in zip(cols, (g, p, leaves)):
                                c.append(value)
                at = pa.array(rows, pa.int64())
                yield pa.RecordBatch.from_arrays([part.column(0).take(at), part.column(1).take(at), pa.array(cols[0], pa.int64()),
                                                  pa.array(cols[1], pa.int64()), pa.array(cols[2], pa.list_(pa.int64()))], names)

    def locate(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            g = group[b.column(2).to_numpy(zero_copy_only=False)]
            yield pa.RecordBatch.from_arrays([b.column(0), b.column(1), b.column(2), pa.array(g), pa.array(parts[g])],
                                             ["key", "x", "leaf", "group", "parts"])

    n_ask = max(1, -(-searched.count() // ask_block))
    left = placed.mapInArrow(locate, f"key {key_kind}, x {kind}, leaf long, group long, parts long").select(
        "group", F.pmod(F.xxhash64("key"), "parts").alias("part"), F.explode(F.sequence(F.lit(0), F.lit(n_ask - 1))).alias("ask"),
        F.col("key.first").alias("first"), F.col("key.h").alias("h"), "x", "leaf")
    right = searched.mapInArrow(visit, f"q {key_kind}, x {kind}, group long, part long, leaves array<long>").select(
        "group", "part", F.pmod(F.xxhash64("q"), F.lit(n_ask)).cast("int").alias("ask"), F.col("q.first").alias("first"),
        F.col("q.h").alias("h"), "x", "leaves")
    found = left.groupBy("group", "part", "ask").cogroup(right.groupBy("group", "part", "ask")).applyInArrow(
        _score(k + 1), "qf long, qh long, vf long, vh long, score double")
    nearest = Window.partitionBy("qf", "qh").orderBy(F.desc("score"), "vf", "vh")
    top = found.withColumn("n", F.row_number().over(nearest)).where(F.col("n") <= k + 1)
    top = top.select(F.struct(F.col("qf").alias("first"), F.col("qh").alias("h")).alias("q"),
                     F.struct(F.col("vf").alias("first"), F.col("vh").alias("h")).alias("key"), "score")
    named = top.join(vectors.select("key", "ids"), "key").select("q", "score", F.explode("ids").alias("id"))
    named = named.groupBy("q", "id").agg(F.max("score").alias("score"))
    best = Window.partitionBy("q").orderBy(F.desc("score"), "id")
    lists = named.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k + 1).groupBy("q").agg(
        F.sort_array(F.collect_list(F.struct("n", "id", "score"))).alias("list"))
    asks = asked.groupBy("key").agg(F.count(F.lit(1)).alias("n_asks"))
    lists = cut(lists.join(asks, lists["q"] == asks["key"]).select("key", "list", "n_asks"))
    out = join_heavy(asked, lists, "key", "n_asks")
    others = F.slice(F.filter("list", lambda x: x["id"] != F.col("query_id")), 1, k)
    out = out.select("query_id", F.posexplode(others).alias("at", "x"))
    return out.select("query_id", (F.col("at") + 1).cast("int").alias("rank"), F.col("x.id").alias("vec_id"), F.col("x.score").alias("score"))


def deal(sizes: dict[int, int], n_leaves: int, block: int) -> tuple[np.ndarray, np.ndarray]:
    """The group of each leaf and the parts of each group: neighbours together up to ``block`` vectors, larger leaves alone."""
    group, parts, filled = np.zeros(n_leaves, np.int64), [1], 0
    for leaf in range(n_leaves):
        n = sizes.get(leaf, 0)
        if filled and filled + n > block:
            parts.append(1)
            filled = 0
        group[leaf] = len(parts) - 1
        parts[-1] = max(1, -(-n // block)) if not filled else 1
        filled += n
    return group, np.array(parts, np.int64)


def _top(scores: np.ndarray, k: int) -> tuple[np.ndarray, np.ndarray]:
    """Rows and columns of the k best of each row, ties to the lesser column; -inf is out."""
    if scores.shape[1] > k:
        edge = -np.partition(-scores, k - 1, axis=1)[:, k - 1:k]
        take, ties = scores > edge, scores == edge
        take |= ties & (np.cumsum(ties, axis=1) <= k - take.sum(1, keepdims=True))
        return np.nonzero(take & (scores > -np.inf))
    return np.nonzero(scores > -np.inf)


def _score(k: int):
    def run(left: pa.Table, right: pa.Table) -> pa.Table:
        names, out = ["qf", "qh", "vf", "vh", "score"], []
        if left.num_rows and right.num_rows:
            left = left.sort_by([("first", "ascending"), ("h", "ascending")])
            v, leaf = _matrix(left.column("x").combine_chunks()), left.column("leaf").to_numpy()
            lists = right.column("leaves").combine_chunks()
            who, opened = np.repeat(np.arange(len(lists)), lists.value_lengths().to_numpy()), lists.flatten().to_numpy()
            members = {x: np.flatnonzero(leaf == x) for x in np.unique(leaf).tolist()}
            for i in range(0, right.num_rows, 512):
                q = _matrix(right.column("x").slice(i, 512).combine_chunks())
                scores = np.full((len(q), len(v)), -np.inf)
                here = (who >= i) & (who < i + 512)
                for x, at in members.items():
                    asks = who[here & (opened == x)] - i
                    scores[np.ix_(asks, at)] = q[asks] @ v[at].T
                rows, cols = _top(scores, k)
                out.append((rows + i, cols, scores[rows, cols]))
        rows, cols, best = (np.concatenate(x) for x in zip(*out)) if out else (np.zeros(0, np.int64),) * 3
        one = lambda t, c, at: t.column(c).take(pa.array(at))
        return pa.table([one(right, "first", rows), one(right, "h", rows), one(left, "first", cols), one(left, "h", cols),
                         pa.array(best, pa.float64())], names=names)

    return run


def exact(placed: DataFrame, queries: np.ndarray, firsts: np.ndarray, k: int) -> DataFrame:
    """``q, first, leaf, score``: the k nearest entries of each of a bounded set of queries (not its own), by a full scan."""
    def run(batches: Iterator[pa.RecordBatch]) -> Iterator[pa.RecordBatch]:
        for b in batches:
            for i in range(0, b.num_rows, 4096):
                part = pa.table(b.slice(i, 4096).columns, names=["first", "v", "leaf"]).sort_by("first")
                first, leaf = part.column("first").to_numpy(), part.column("leaf")
                scores = queries @ _matrix(part.column("v").combine_chunks()).T
                scores[firsts[:, None] == first] = -np.inf
                q, cols = _top(scores, k)
                yield pa.RecordBatch.from_arrays([pa.array(q), pa.array(first[cols]), leaf.take(pa.array(cols)).combine_chunks(),
                                                  pa.array(scores[q, cols])], ["q", "first", "leaf", "score"])

    best = Window.partitionBy("q").orderBy(F.desc("score"), "first")
    got = placed.select("key.first", "v", "leaf").mapInArrow(run, "q long, first long, leaf long, score double")
    return got.withColumn("n", F.row_number().over(best)).where(F.col("n") <= k)


def _calibrate(tree: Tree, placed: DataFrame, searched: DataFrame, k: int, calibration: int, recall: float) -> int:
    """Leaves to visit for the wanted recall on sample queries."""
    some = searched.orderBy(F.xxhash64("q", F.lit(9)), "q").limit(calibration).select("q.first", "qv").toArrow().combine_chunks()
    if not some.num_rows:
        return 1
    queries, firsts = _matrix(some.column("qv").combine_chunks()), some.column("first").to_numpy()
    order = [{leaf: i for i, leaf in enumerate(tree.visit(q, len(tree.leaf)))} for q in queries]
    need = sorted(order[r.q][r.leaf] + 1 for r in exact(placed, queries, firsts, k).select("q", "leaf").collect())
    return need[min(len(need) - 1, int(np.ceil(recall * len(need))) - 1)] if need else 1
