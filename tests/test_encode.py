import numpy as np
import pytest

from quarry.operators import encode
from quarry.streaming import incremental


def test_python_and_jvm_hash_encoders_agree(spark):
    df = spark.read.parquet("/root/testdata/sf0.001/documents.parquet") \
              .selectExpr("doc_id", "text AS contents")
    jvm = {r.doc_id: np.array(r.embedding) for r in encode.hash_encode(df, dim=64).collect()}
    py = {r.doc_id: np.array(r.embedding) for r in
          encode.encode(df, encoder_factory=encode.HashingEncoderFactory(64), batch_size=7).collect()}
    assert jvm.keys() == py.keys()
    for k in jvm:
        assert np.allclose(jvm[k], py[k], atol=1e-12)


def test_quarantine_isolates_failing_rows(spark):
    from quarry.plans.catalog import HASH_DIM, MarkerFactory
    picky = MarkerFactory("xx")  # refuses texts with the marker
    df = spark.createDataFrame([(i, "fine text" if i != 3 else "x" * 50) for i in range(8)] + [(8, None)],
                               "doc_id long, contents string")
    rows = {r.doc_id: r for r in encode.encode(df, encoder_factory=picky, batch_size=4).collect()}
    assert rows[3].status == "error" and rows[3].embedding is None and "xx" in rows[3].error
    assert all(rows[i].status == "ok" and len(rows[i].embedding) == HASH_DIM for i in rows if i != 3)
    assert rows[8].embedding == [0.0] * HASH_DIM  # null text -> '' -> zero vector
    z = {r.doc_id: r for r in encode.encode(df, encoder_factory=picky, zero_fill=True,
                                            dim=HASH_DIM).collect()}
    assert z[3].embedding == [0.0] * HASH_DIM and z[3].status == "error"


def test_masked_mean_ignores_padding():
    h = np.array([[[1.0, 1.0], [3.0, 3.0], [100.0, 100.0]]])
    m = np.array([[1, 1, 0]])
    assert np.allclose(encode.masked_mean(h, m), [[2.0, 2.0]])


def test_incremental_and_stream_are_idempotent(spark, tmp_path):
    docs = spark.read.parquet("/root/testdata/sf0.001/documents.parquet") \
                .selectExpr("doc_id", "text AS contents")
    vec = str(tmp_path / "vectors")
    encode.hash_encode(docs.where("doc_id % 3 = 0")).write.parquet(vec)
    incremental.encode_missing(docs, vec)
    incremental.encode_missing(docs, vec)  # rerun adds nothing
    got = spark.read.parquet(vec)
    assert got.count() == docs.count() == got.select("doc_id").distinct().count()

    landing, out, ckpt = (str(tmp_path / n) for n in ("landing", "svec", "ckpt"))
    docs.write.parquet(landing)
    incremental.run_encode_stream(spark, landing, docs.schema, out, ckpt)
    incremental.run_encode_stream(spark, landing, docs.schema, out, ckpt)  # nothing new
    s = spark.read.parquet(out)
    assert s.count() == docs.count()
    one_shot = {r.doc_id: r.embedding for r in encode.hash_encode(docs).collect()}
    assert {r.doc_id: r.embedding for r in s.collect()} == one_shot


def test_failed_rows_are_stored_and_a_failing_read_adds_nothing(spark, tmp_path):
    from quarry.plans.catalog import MarkerFactory
    from quarry.streaming import incremental
    df = spark.createDataFrame([(1, "fine"), (2, "bad xx"), (3, "good")], "doc_id long, contents string")
    path = str(tmp_path / "vectors")
    for _ in range(2):
        incremental.encode_missing(df, path, encoder="model", encoder_factory=MarkerFactory("xx"))
    rows = {r.doc_id: r for r in spark.read.parquet(path).collect()}
    assert spark.read.parquet(path).count() == 3
    assert rows[2].status == "error" and "xx" in rows[2].error and rows[1].status == "ok"
    (tmp_path / "broken").mkdir()
    (tmp_path / "broken" / "part-0.parquet").write_bytes(b"not parquet")
    with pytest.raises(Exception):
        incremental.encode_missing(df, str(tmp_path / "broken"), encoder="model", encoder_factory=MarkerFactory("xx"))
    assert [p.name for p in (tmp_path / "broken").iterdir()] == ["part-0.parquet"]


def test_a_worker_loads_an_encoder_once(spark, tmp_path):
    from pathlib import Path
    folder = tmp_path / "loads"
    folder.mkdir()

    class Counting:
        cache_key = f"counting-{folder}"

        def __call__(self):
            import os
            import uuid
            Path(folder, f"{os.getpid()}-{uuid.uuid4().hex}").touch()
            return lambda texts: np.ones((len(texts), 2))

    df = spark.range(40).selectExpr("id AS doc_id", "'t' AS contents").repartition(20)
    encode.encode(df, encoder_factory=Counting()).collect()
    pids = [p.name.split("-")[0] for p in folder.iterdir()]
    assert pids and len(pids) == len(set(pids))


def test_pooling_takes_no_padding():
    states = np.arange(12, dtype=float).reshape(6, 2)
    got = encode.ragged_mean(states, np.array([0, 2, 2, 6]))
    assert got.tolist() == [[0, 0], [1, 2], [0, 0], [7, 8]]
    hidden, mask = np.zeros((4, 4, 2)), np.zeros((4, 4))
    for i, (a, b) in enumerate(((0, 0), (0, 2), (2, 2), (2, 6))):
        hidden[i, :b - a], mask[i, :b - a], hidden[i, b - a:] = states[a:b], 1, 99
    assert np.allclose(encode.masked_mean(hidden, mask), got)
    assert encode.ragged_mean(np.zeros((0, 2)), np.array([0, 0])).tolist() == [[0, 0], [0, 0]]


def test_pooled_vectors_do_not_depend_on_the_batch(spark):
    texts = [(i, "alpha beta " * (i % 5) + f"w{i}") for i in range(30)] + [(30, ""), (31, None)]
    df = spark.createDataFrame(texts, "doc_id long, contents string")
    made = [{r.doc_id: r.embedding for r in encode.encode(df.repartition(n), encoder_factory=f(16), batch_size=size).collect()}
            for f, n, size in ((encode.PooledHashingEncoderFactory, 1, 1), (encode.PooledHashingEncoderFactory, 5, 7),
                               (encode.HashingEncoderFactory, 2, 16))]
    assert all(np.allclose(made[0][i], other[i]) for other in made[1:] for i in made[0])
    assert encode.PooledHashingEncoderFactory(16) != encode.HashingEncoderFactory(16)
