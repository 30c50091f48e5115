import json

import pytest
from pyspark.sql import functions as F

from quarry.operators import retrieve
from quarry.sources import readers, writers


def test_query_and_request_arrays(spark, tmp_path):
    qp, rp = tmp_path / "q.json", tmp_path / "r.json"
    qp.write_text(json.dumps([{"id": "q1", "question": "first?"}, {"id": "q2", "question": "second?"}], indent=2))
    rp.write_text(json.dumps([{"id": "q2", "question": "second?", "options": {"A": "x", "B": "y"},
                               "answer": "B"}], indent=2))
    q = readers.read_queries(spark, str(qp))
    r = readers.read_requests(spark, str(rp))
    assert sorted(x.qid for x in q.collect()) == ["q1", "q2"]
    joined = {x.qid: x.answer for x in q.join(r.drop("question"), "qid", "left").collect()}
    assert joined == {"q1": None, "q2": "B"}  # paired by key, not position


def test_run_object_layout_and_gold(spark, tmp_path):
    run = {"q1": {"question": "?", "retriever": "BM25", "latency_ms": 3.5,
                  "top_20_results": [{"rank": 2, "score": 0.5, "id": "b", "title": "B", "content": "bb"},
                                     {"rank": 1, "score": 0.9, "id": "a", "title": "A", "content": "aa"}]},
           "q2": {"question": "!", "retriever": "BM25", "top_20_results": []}}
    p = tmp_path / "run.json"
    p.write_text(json.dumps(run, indent=2))
    df = readers.read_run(spark, str(p), layout="object", method="bm25")
    rows = {r.qid: r for r in df.collect()}
    assert rows["q1"].num_results == 2 and rows["q2"].latency_ms is None
    flat = retrieve.flatten_run(df).where("qid = 'q1'").orderBy("_pos").collect()
    assert [r.id for r in flat] == ["b", "a"]
    gold = {"q1": {"manually_selected_top_5": [{"id": "a", "relevance_score": 2}, {"relevance_score": 1},
                                               {"id": "a", "relevance_score": 1}]}}
    gp = tmp_path / "gold.json"
    gp.write_text(json.dumps(gold))
    g = readers.read_gold(spark, str(gp)).collect()
    assert [(r.id, r.relevance_score, r.pos) for r in g] == [("a", 2, 0), ("a", 1, 2)]


def test_corpus_json_round_trip(spark, tmp_path):
    c = spark.createDataFrame([("1", "s1", "t", "c", "t c"), ("2", "s2", None, "c", None)],
                              "doc_id string, source string, title string, content string, contents string")
    writers.write_corpus(c, str(tmp_path / "corpus"), fmt="json")
    back = readers.read_corpus(spark, str(tmp_path / "corpus"), fmt="json")
    assert sorted(back.select("doc_id", "source", "title", "content", "contents").collect()) == sorted(c.collect())


def test_run_objects_round_trip_with_requests(spark, tmp_path):
    results = spark.createDataFrame([(f"q{i}", "rrf", r, 1.0 / r, f'd"{r}', "t", "line\nbreak") for i in range(25) for r in (1, 2)],
                                    "qid string, method string, rank int, score double, id string, title string, content string")
    queries = spark.createDataFrame([(f"q{i}", f'what "{i}"?') for i in range(27)], "qid string, question string")
    requests = queries.select("qid", "question", F.create_map(F.lit("A"), "question").alias("options"), F.lit("A").alias("answer"))
    run = retrieve.build_run(results, queries, requests, latency_ms=2.5)
    path = str(tmp_path / "run")
    writers.write_run(run, path, layout="object", queries_per_object=5)
    files = [p for p in (tmp_path / "run").iterdir() if p.name.startswith("part-")]
    assert len(files) > 2 and sum(len(json.loads(p.read_text())) for p in files) == 27  # each file is a JSON object
    want = {r.qid: (r.question, r.full_question.options, r.num_results, [x.id for x in r.top_results]) for r in run.collect()}
    for layout in ("object_lines", "object"):
        back = readers.read_run(spark, path, layout=layout, method="rrf").collect()
        assert {r.qid: (r.question, r.full_question.options, r.num_results, [x.id for x in r.top_results]) for r in back} == want
        assert {r.latency_ms for r in back} == {2.5}
    writers.write_run(run, str(tmp_path / "lines"))
    lines = "".join(p.read_text() for p in sorted((tmp_path / "lines").glob("part-*")))
    ids = [json.loads(x)["qid"] for x in lines.splitlines()]
    assert ids == sorted(ids) and len(ids) == 27
    assert {r.qid: r.full_question.answer for r in readers.read_run(spark, str(tmp_path / "lines")).collect()} == dict.fromkeys(want, "A")
    with pytest.raises(ValueError):
        writers.write_run(run, path, layout="table")


def test_a_failed_write_shows_no_run(spark, tmp_path):
    run = spark.createDataFrame([(f"q{i}", "?") for i in range(20)], "qid string, question string")
    fails = F.when(F.col("qid") == "q7", F.raise_error(F.lit("lost"))).otherwise(F.array().cast("array<string>"))
    with pytest.raises(Exception, match="lost"):
        writers.write_run(run.withColumn("top_results", fails), str(tmp_path / "run"), layout="object", queries_per_object=2)
    assert not list(tmp_path.glob("run/part-*")) and not (tmp_path / "run" / "_SUCCESS").exists()


@pytest.mark.parametrize("indent", [2, 4, None])
def test_arrays_and_objects_of_any_layout_are_read_in_splits(spark, tmp_path, indent):
    items = [{"id": f"q{i}", "question": f"is }}, this [{i}] \n  }},?", "options": {"A": "[", "B": "]}"}, "answer": "A"} for i in range(400)]
    (tmp_path / "r.json").write_text(json.dumps(items, indent=indent))
    got = readers.read_json_array(spark, str(tmp_path / "r.json"), readers.REQUEST_SCHEMA, indent or 2)
    assert {r.id: (r.question, r.options, r.answer) for r in got.collect()} == {
        x["id"]: (x["question"], x["options"], x["answer"]) for x in items}
    gold = {x["id"]: {"manually_selected_top_5": [{"id": str(j), "relevance_score": j / 2} for j in range(i % 3)]} for i, x in enumerate(items)}
    (tmp_path / "g.json").write_text(json.dumps(gold, indent=indent))
    rows = readers.read_json_object(spark, str(tmp_path / "g.json"), readers.GOLD_ENTRY, indent or 2).collect()
    assert {r.key: [(g.id, g.relevance_score) for g in r.e.manually_selected_top_5] for r in rows} == {
        k: [(g["id"], g["relevance_score"]) for g in v["manually_selected_top_5"]] for k, v in gold.items()}
    if indent:
        before = spark.conf.get("spark.sql.files.maxPartitionBytes")
        try:
            spark.conf.set("spark.sql.files.maxPartitionBytes", "8k")
            split = readers.read_json_array(spark, str(tmp_path / "r.json"), readers.REQUEST_SCHEMA, indent)
            assert split.select(F.spark_partition_id()).distinct().count() > 3 and split.count() == 400
        finally:
            spark.conf.set("spark.sql.files.maxPartitionBytes", before)


def test_empty_arrays_and_objects(spark, tmp_path):
    for i, (text, read) in enumerate([("[]", readers.read_queries), ("", readers.read_queries), ("[\n]", readers.read_queries),
                                      ("{}", readers.read_gold), ("", readers.read_gold), ("{\n}\n", readers.read_gold)]):
        (tmp_path / str(i)).write_text(text)
        assert read(spark, str(tmp_path / str(i))).count() == 0
