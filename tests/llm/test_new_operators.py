"""Centroid clustering, the digest index and importance resampling against brute force."""

import hashlib
import math
import re
import zlib
from collections import Counter, defaultdict

import numpy as np
import pytest
from pyspark.sql import functions as F

from quarry.llm import centroids, digests, resampling

FOLD = str.maketrans("ABCDEFGHIJKLMNOPQRSTUVWXYZ", "abcdefghijklmnopqrstuvwxyz")


# ---------------------------------------------------------------- centroids
def lloyd(rows, k, rounds, seed=3):
    rows = [(i, [math.floor(1024 * float(x)) for x in v]) for i, v in rows]
    first = sorted(rows, key=lambda r: (hashlib.sha256(f"{seed}:{'' if r[0] is None else r[0]}".encode()).hexdigest(), r[1]))[:k]
    c = [v for _, v in first]

    def near(v):
        return min((sum((a - b) ** 2 for a, b in zip(v, m)), j) for j, m in enumerate(c))

    for _ in range(rounds):
        members = defaultdict(list)
        for _, v in rows:
            members[near(v)[1]].append(v)
        c = [[sum(x) // len(members[j]) for x in zip(*members[j])] if members[j] else c[j] for j in range(len(c))]
    out = [(i, *near(v)[::-1]) for i, v in rows]
    per = Counter()
    for _, j, d in out:
        per[j] += d
    return Counter((i, j, d, per[j], sum(per.values()), tuple(c[j])) for i, j, d in out)


def vectors(spark, rows):
    return spark.createDataFrame([(i, v, "x") for i, v in rows], "vec_id long, embedding array<float>, cluster string")


def test_clusters_equal_lloyd_in_integers(spark):
    rng = np.random.default_rng(1)
    good = [(i, [float(np.float32(x)) for x in rng.normal(i % 5, 0.3, 6)]) for i in range(150)]
    good += [(200 + i, good[0][1]) for i in range(60)] + [(7, good[7][1]), (None, good[3][1]), (301, [0.0] * 6), (302, [-1e4] * 6)]
    bad = [(400, None), (401, [1.0] * 5), (402, [1.0] * 5 + [None]), (403, [float("nan")] * 6), (404, [float("inf")] * 6), (405, [])]
    for k, lead in ((8, 3), (3, 6), (5, 1)):
        got = centroids.cluster(vectors(spark, good + bad), k=k, rounds=4, width=6, lead=lead).collect()
        assert Counter((r.vec_id, r.cluster, r.distance, r.cluster_inertia, r.inertia, tuple(r.centroid)) for r in got) == lloyd(good, k, 4)


def test_clusters_with_ties_few_rows_and_none(spark):
    same = [(i, [0.5, 0.5]) for i in range(30)]
    got = centroids.cluster(vectors(spark, same), k=4, rounds=2, width=2).collect()
    assert {(r.cluster, r.distance) for r in got} == {(0, 0)} and len(got) == 30
    assert {r.cluster for r in centroids.cluster(vectors(spark, [(1, [0.0, 1.0]), (2, [5.0, 1.0])]), width=2).collect()} == {0, 1}
    none = centroids.cluster(vectors(spark, []), width=2)
    assert none.collect() == [] and none.columns == ["vec_id", "cluster", "distance", "cluster_inertia", "inertia", "centroid"]
    with pytest.raises(Exception, match="a component reaches"):
        centroids.cluster(vectors(spark, [(1, [2e5, 0.0])]), width=2).collect()


def test_bounds_hold_and_spare_distances():
    rng = np.random.default_rng(4)
    x = np.floor(rng.normal(0, 1, (4000, 32)) @ np.diag(1 / np.arange(1, 33)) * 1024).astype(np.int64)
    c = x[:40]
    _, axes = np.linalg.eigh(np.cov(x.T))
    turn = centroids.Rotation(x.mean(0), axes[:, ::-1][:, :8])
    near = centroids.Nearest(c, turn)
    exact = ((x[:, None] - c) ** 2).sum(2)
    assert (near.bounds(*turn(x.astype(float))) <= exact).all()
    number, best = near(x, *turn(x.astype(float)))
    assert (number == exact.argmin(1)).all() and (best == exact.min(1)).all()
    assert near.verified < 0.25 * exact.size


# ---------------------------------------------------------------- digest index
def sha(text):
    return hashlib.sha256((text or "").translate(FOLD).encode()).hexdigest()


def test_marks_equal_brute_force(spark, docs, tmp_path):
    rows = digests.digested(docs, keep=("doc_id", "source"))
    index = digests.DigestIndex(spark, str(tmp_path / "index"), buckets=4)
    index.add(rows, 1)
    got = index.mark(rows, 1).select("doc_id", "keep_id", "group_size", "kept", F.lower(F.hex("dedup_digest")).alias("h")).collect()
    groups = defaultdict(list)
    for r in docs.collect():
        groups[sha(r.text)].append(-1 if r.doc_id is None else r.doc_id)
    want = Counter((i, max(ids), len(ids), h) for h, ids in groups.items() for i in ids)
    null = lambda x: -1 if x is None else x
    assert Counter((null(r.doc_id), null(r.keep_id), r.group_size, r.h) for r in got) == want
    kept = Counter(r.h for r in got if r.kept)
    assert kept == Counter(dict.fromkeys(groups, 1)) and all(r.doc_id == r.keep_id for r in got if r.kept)


def test_deliveries_survive_reopening_and_replay(spark, tmp_path):
    def batch(*rows):
        return spark.createDataFrame([(i, t, "e") for i, t in rows], "doc_id long, text string, extra string")

    def ids(df):
        return sorted((r.doc_id is None, r.doc_id or 0) for r in df.collect())

    path = str(tmp_path / "index")
    first = batch((1, "Alpha"), (2, "alpha"), (3, "É"), (4, "é"), (5, None), (6, ""), (2, "ALPHA"))
    out = digests.deliver(first, digests.DigestIndex(spark, path, buckets=3), 1)
    assert out.columns == first.columns and ids(out) == [(False, 2), (False, 3), (False, 4), (False, 6)]
    second = batch((9, "aLPHA"), (10, "new"), (None, "New"), (None, "other"), (None, "other"))
    assert ids(digests.deliver(second, digests.DigestIndex(spark, path), 2)) == [(False, 10), (True, 0)]
    spark.sql(f"DROP TABLE {digests.DigestIndex(spark, path).table}")  # as a new session: the files are all there is
    again = digests.DigestIndex(spark, path, buckets=99)
    assert again.buckets == 3 and again.known().count() == 6
    before = sorted(map(tuple, again.entries().select("digest", "n", "batch", "kind").collect()))
    assert ids(digests.deliver(second, again, 2)) == [(False, 10), (True, 0)]
    assert ids(digests.deliver(second, again, 3)) == []
    assert sorted(map(tuple, again.entries().where("batch < 3").select("digest", "n", "batch", "kind").collect())) == before
    assert digests.deliver(first.where("false"), again, 4).count() == 0
    sizes = {r.digest.hex(): r.n for r in again.groups().collect()}
    assert sizes[sha("alpha")] == 5 and sizes[sha("new")] == 4 and sizes[sha("É")] == 1
    with pytest.raises(ValueError):
        digests.digested(first.withColumn("dedup_row", F.lit(1)))


def test_the_index_side_is_not_shuffled(spark, tmp_path):
    rows = digests.digested(spark.range(50).select(F.col("id").alias("doc_id"), F.col("id").cast("string").alias("text")))
    index = digests.DigestIndex(spark, str(tmp_path / "index"), buckets=4)
    index.add(rows, 1)
    plan = index.groups()._jdf.queryExecution().executedPlan().toString()
    assert "Bucketed: true" in plan and "Exchange" not in plan
    new = rows.select(F.col("dedup_digest").alias("digest")).join(index.known(2).select("digest").hint("merge"), "digest", "left_anti")
    plan = new._jdf.queryExecution().executedPlan().toString()
    assert "SortMergeJoin" in plan and plan.count("Exchange") == 1


# ---------------------------------------------------------------- resampling
MAKES = re.compile(r"[^\x00-\x2F\x3A-\x60\x7B-\x7F]+")


def features(text, buckets):
    w = MAKES.findall((text or "").translate(FOLD))
    return len(w), [zlib.crc32(f.encode()) % buckets for f in w + [f"{a} {b}" for a, b in zip(w, w[1:])]]


def drawn(rows, target, fraction, buckets, least, seed=7):
    made = [(i, *features(t, buckets)) for i, t in rows]
    s, t = Counter(b for r in made for b in r[2]), Counter(b for x in target for b in features(x, buckets)[1])
    n_s, n_t = sum(s.values()), sum(t.values())
    gain = [math.floor(1000 * math.log((t[b] + 1) * (n_s + buckets) / ((s[b] + 1) * (n_t + buckets)))) for b in range(buckets)]
    out = []
    for i, n, f in made:
        weight = sum(gain[b] for b in f) // len(f) if f else 0
        h = int(hashlib.sha256(f"{seed}:{'' if i is None else i}".encode()).hexdigest()[:8], 16)
        out.append((i, len(f), weight, weight + math.floor(-1000 * math.log(-math.log((h + 0.5) / 4294967296))), n))
    order = sorted((r for r in out if r[4] >= least), key=lambda r: (-r[3], r[0] is None, r[0] or 0))
    want = Counter((*r[:4], k + 1) for k, r in enumerate(order[:fraction[0] * len(order) // fraction[1]]))
    want.update((*r[:4], None) for r in order[fraction[0] * len(order) // fraction[1]:])
    want.update((*r[:4], None) for r in out if r[4] < least)
    return want


@pytest.mark.parametrize("fraction,buckets,least", [((25, 100), 10_000, 20), ((1, 2), 37, 1), ((1, 1), 40_000, 3)])
def test_resampling_equals_counting_every_text(spark, docs, fraction, buckets, least):
    more = [(100 + i, f"a{i % 3} b.{i % 4}\n\n  \nx\nONE two-three\r\nÀé ~z{i % 2}\n" + "same line here\n" * (i % 5)) for i in range(40)]
    more += [(None, more[0][1]), (100, more[0][1]), (100, more[0][1]), (200, "\n\n"), (201, "one"), (202, "one\ntwo"), (203, " é\u0085x")]
    rows = docs.select("doc_id", "text", F.lit(1).alias("key")).unionByName(
        spark.createDataFrame([(i, t, 1) for i, t in more], "doc_id long, text string, key int"))
    target = ["same line here", None, "", "alpha1 beta2\nONE two", "x\nONE"]
    got = resampling.resample(rows, spark.createDataFrame([(t,) for t in target], "text string"), fraction=fraction, buckets=buckets, min_words=least)
    assert got.columns == ["doc_id", "key", "res_features", "res_weight", "res_score", "res_rank"]
    want = drawn([(r.doc_id, r.text) for r in rows.collect()], target, fraction, buckets, least)
    assert Counter((r.doc_id, r.res_features, r.res_weight, r.res_score, r.res_rank) for r in got.collect()) == want


def test_resampling_of_empty_tables_and_clashing_names(spark, docs, empty):
    target = spark.createDataFrame([("a b",)], "text string")
    assert resampling.resample(empty, target).collect() == []
    got = resampling.resample(docs, target.where("false"), min_words=1).collect()
    assert len(got) == docs.count() and max(r.res_rank or 0 for r in got) > 0
    with pytest.raises(ValueError):
        resampling.resample(docs.withColumn("res_row", F.lit(1)), target)


def test_a_repeated_line_is_cut_into_features_once(spark):
    texts = spark.createDataFrame([("same line\nother\n\nsame line",)] * 50, "text string")
    rows = {r.words: r.occurrences for r in resampling.distinct_lines(texts, F.col("text"), 100).collect()}
    assert rows == {2: 100, 1: 50}
