"""Sinks round trips, bounded JSON export, chunked files, the trained model, token spans."""

import glob
import json
import os
import re

from pyspark.sql import functions as F

from tagweave.operators import graph
from tagweave.operators.model import SentimentModel, train_sentiment_model
from tagweave.operators.tokens import assemble, finish, token_spans
from tagweave.sinks import (export_graph_json, export_top_json, read_json_document, write_chunks, write_graph,
                            write_json_document)
from tagweave.sources import read_graph
from tagweave.sources.fixtures import read_table, scored_view
from conftest import SF_SMALL


def test_graph_roundtrip_and_missing(spark, scratch):
    posts = scored_view(spark, SF_SMALL, "posts")
    v, e = graph.build_graph(posts)
    for fmt in ("parquet", "json"):
        out = os.path.join(scratch, fmt)
        write_graph(v, e, out, fmt)
        rv, re_ = read_graph(spark, out, fmt)
        assert sorted(map(tuple, rv.collect())) == sorted(map(tuple, v.collect()))
        assert sorted(map(tuple, re_.collect())) == sorted(map(tuple, e.collect()))
    ev, ee = read_graph(spark, os.path.join(scratch, "missing"))
    assert ev.count() == 0 and ee.count() == 0 and ev.columns == ["id", "degree", "dominant_sentiment"]


def test_export_top_json(spark, scratch):
    posts = scored_view(spark, SF_SMALL, "posts")
    v, e = graph.build_graph(posts)
    npath, epath = export_top_json(v, e, scratch, top_n=5)
    nodes = json.loads(open(glob.glob(os.path.join(npath, "part-*"))[0]).read())
    edges = json.loads(open(glob.glob(os.path.join(epath, "part-*"))[0]).read())
    assert len(nodes) == 5 and set(nodes[0]) == {"id", "degree", "dominant_sentiment"}
    ids = {n["id"] for n in nodes}
    assert edges and all(x["src"] in ids and x["dst"] in ids for x in edges)


def test_write_chunks(spark, scratch):
    df = spark.range(2500).select(F.col("id").cast("string").alias("id"))
    out = write_chunks(df.coalesce(1), os.path.join(scratch, "c"), chunk_size=1000)
    files = sorted(glob.glob(os.path.join(out, "chunk-*.json")))
    assert [sum(1 for _ in open(f)) for f in files] == [1000, 1000, 500]


def ids(files):
    return [json.loads(line)["id"] for f in files for line in open(f)]


def test_chunks_are_numbered_full_and_in_order(spark, scratch):
    out = os.path.join(scratch, "c")
    df = spark.range(2500).select((F.col("id") * 7919 % 2500).alias("id"), F.lit("x").alias("a.b"))
    write_chunks(df.repartition(7), out, chunk_size=300, order_by=("id",))
    files = sorted(glob.glob(os.path.join(out, "chunk-*.json")))
    assert [os.path.basename(f) for f in files] == [f"chunk-{i:08d}.json" for i in range(9)]
    assert ids(files) == list(range(2500)) and ids(files[:1]) == list(range(300))
    times = [os.stat(f).st_mtime_ns for f in files]
    assert times == sorted(times) and len(set(times)) == 9  # a file stream reads them in this order
    write_chunks(df.where("id < 5"), out, chunk_size=300, order_by=("id",))  # goes on after the last one
    more = sorted(glob.glob(os.path.join(out, "chunk-*.json")))
    assert len(more) == 10 and ids(more[9:]) == list(range(5)) and os.stat(more[9]).st_mtime_ns > times[-1]
    write_chunks(df.where("id < 0"), out)
    assert sorted(glob.glob(os.path.join(out, "chunk-*.json"))) == more
    write_chunks(df.where("id < 7"), out, chunk_size=3, mode="overwrite", order_by=("id",))
    assert [len(ids([f])) for f in sorted(glob.glob(os.path.join(out, "*.json")))] == [3, 3, 1]
    assert not glob.glob(os.path.join(out, "_*"))


def test_chunks_that_share_a_task_are_full_too(spark, scratch, monkeypatch):
    import tagweave.sinks.graph as sink
    monkeypatch.setattr(sink, "MAX_CHUNK_TASKS", 3)
    out = write_chunks(spark.range(1050).repartition(5), os.path.join(scratch, "c"), chunk_size=100, order_by=("id",))
    files = sorted(glob.glob(os.path.join(out, "chunk-*.json")))
    assert [len(ids([f])) for f in files] == [100] * 10 + [50] and ids(files) == list(range(1050))


def document(path):
    return "".join(open(f, encoding="ascii").read() for f in sorted(glob.glob(os.path.join(path, "part-*"))))


def test_complete_graph_as_json_documents(spark, scratch):
    from tagweave.schema import EDGE, VERTEX
    posts = scored_view(spark, "/root/testdata/sf0.01", "posts")
    v, e = graph.build_graph(posts)
    vpath, epath = export_graph_json(v, e, scratch)
    for path, df, keys, schema in ((vpath, v, ("id",), VERTEX), (epath, e, ("src", "dst"), EDGE)):
        want = sorted((r.asDict() for r in df.collect()), key=lambda r: tuple(r[k] for k in keys))
        assert document(path).rstrip("\n") == json.dumps(want, indent=2)  # to the letter
        assert sorted(map(tuple, read_json_document(spark, path, schema).collect())) == sorted(map(tuple, df.collect()))


def test_json_document_of_odd_values(spark, scratch):
    rows = [("é \U0001f600", 1, None), ('q"\\\n  }\n{', 2, 1.5), (None, 3, 2.0), ("same", 4, 0.25), ("same", 4, 0.25)]
    df = spark.createDataFrame(rows, "name string, `a.b` int, x double").repartition(4)
    path = write_json_document(df, os.path.join(scratch, "d"), ("a.b",))
    assert [tuple(r.values()) for r in json.loads(document(path))] == rows
    assert sorted(map(repr, map(tuple, read_json_document(spark, path, df.schema).collect()))) == sorted(map(repr, rows))
    empty = write_json_document(df.where("false"), os.path.join(scratch, "e"), ("a.b",))
    assert json.loads(document(empty)) == [] and read_json_document(spark, empty, df.schema).count() == 0


def test_model_invariants(spark, scratch):
    docs = read_table(spark, SF_SMALL, "documents").select("doc_id", "text")
    labels = read_table(spark, SF_SMALL, "labels").select(
        "doc_id", F.when(F.col("quality") == 1, "positive").otherwise("negative").alias("sentiment"))
    train = docs.join(labels, "doc_id")
    m = train_sentiment_model(train, max_iter=10)
    a = {r["doc_id"]: r["sentiment"] for r in m.transform(docs).collect()}
    assert set(a.values()) <= {"positive", "negative", "neutral"} and len(a) == docs.count()
    m2 = train_sentiment_model(train, max_iter=10)
    assert a == {r["doc_id"]: r["sentiment"] for r in m2.transform(docs).collect()}
    strict = SentimentModel(m.pipeline_model, m.labels, threshold=1.01)
    assert {r["sentiment"] for r in strict.transform(docs).collect()} == {"neutral"}
    m.save(os.path.join(scratch, "model"))
    back = SentimentModel.load(os.path.join(scratch, "model"))
    assert a == {r["doc_id"]: r["sentiment"] for r in back.transform(docs).collect()}


def test_token_spans_and_finisher(spark):
    df = spark.createDataFrame([(1, "I  love\tthis!")], "id long, text string")
    doc = assemble(df)
    assert doc.first()["document"] == "I love this!"
    spans = [tuple(r) for r in token_spans(doc, "id").orderBy("pos").collect()]
    assert spans == [(1, 0, 0, 0, "I"), (1, 1, 2, 5, "love"), (1, 2, 7, 10, "this"), (1, 3, 11, 11, "!")]
    raw = [tuple(r)[2:4] for r in token_spans(df, "id", "text").orderBy("pos").collect()]
    assert raw == [(0, 0), (3, 6), (8, 11), (12, 12)]
    ann = spark.createDataFrame([([("sentiment", 0, 5, "positive")],)],
                                "a array<struct<annotatorType:string,begin:int,end:int,result:string>>")
    assert ann.select(finish("a").alias("f")).first()["f"] == "positive"


def test_token_spans_are_linear_and_do_not_shuffle(spark):
    import re
    import time
    took = []
    for n in (100_000, 400_000):
        text = " ".join(f"w{i % 977}é," for i in range(n))
        df = spark.createDataFrame([(1, text)], "id long, text string").cache()
        df.count()
        best = 1e9
        for _ in range(2):
            t = time.perf_counter()
            row = token_spans(df, "id", "text").agg(F.count("*").alias("n"), F.sum("begin").alias("b"), F.max("end").alias("e")).first()
            best = min(best, time.perf_counter() - t)
        took.append(best)
        want = [m.span() for m in re.finditer(r"\w+|,", text)]
        assert (row["n"], row["b"], row["e"]) == (len(want), sum(s for s, _ in want), want[-1][1] - 1)
        df.unpersist()
    assert took[1] < 10 * took[0]
    plan = token_spans(spark.range(1).select(F.lit("a b").alias("t"), "id"), "id", "t")._jdf.queryExecution().executedPlan().toString()
    assert "Exchange" not in plan
    rows = token_spans(spark.createDataFrame([(1, None), (2, ""), (3, " \t "), (4, "a  "), (4, "x'y z")], "id long, text string"), "id", "text").collect()
    assert sorted(tuple(r) for r in rows) == [(4, 0, 0, 0, "a"), (4, 0, 0, 2, "x'y"), (4, 1, 4, 4, "z")]


def test_many_chunks_share_tasks_and_stay_full(spark, scratch):
    n = spark.sparkContext.defaultParallelism * 4
    rows = spark.range(10 * 3 * n + 5).select("id")
    before = spark._jvm.java.lang.System.currentTimeMillis()
    out = write_chunks(rows, os.path.join(scratch, "c"), chunk_size=10, order_by=("id",))
    files = sorted(glob.glob(os.path.join(out, "chunk-*.json")))
    assert [len(ids([f])) for f in files] == [10] * (3 * n) + [5] and ids(files) == list(range(30 * n + 5))
    times = [os.stat(f).st_mtime_ns for f in files]
    assert times == sorted(set(times)) and times[0] >= before * 1_000_000
    assert not glob.glob(os.path.join(out, "_*"))


def test_chunks_of_many_files_are_written_by_few_tasks(spark, scratch, monkeypatch):
    kind = type(spark.range(1))
    dealt, plain = [], kind.repartitionById
    monkeypatch.setattr(kind, "repartitionById", lambda self, n, *a: dealt.append(n) or plain(self, n, *a))
    cores = spark.sparkContext.defaultParallelism
    write_chunks(spark.range(40 * cores), os.path.join(scratch, "c"), chunk_size=1)
    assert 4 * cores <= dealt[0] <= 5 * cores  # a task a chunk before: 40 for each core


def test_token_spans_are_summed_in_one_pass_whatever_the_slices(spark, monkeypatch):
    from tagweave.operators import tokens as module
    monkeypatch.setattr(module, "SPANS_AT_ONCE", 3)
    texts = [("a", "Ünï  日本's x!\n𝒳 y "), ("b", ""), ("a", " one, two  three four"), (None, "z\t#z"), ("c", None)]
    out = token_spans(spark.createDataFrame(texts, "id string, text string").coalesce(1), "id", "text")
    want = []
    for key, text in texts:
        for pos, m in enumerate(re.finditer(r"\w+(?:'[^\W\d_]+)?|[^\w\s]", text or "")):
            want.append((key, pos, m.start(), m.end() - 1, m.group()))
    assert sorted(map(tuple, out.collect()), key=str) == sorted(want, key=str)
    assert "Generate" not in out._jdf.queryExecution().executedPlan().toString()  # no pass for each level of a tree


def test_model_scores_in_a_session_that_has_observed_a_query(spark):
    from pyspark.sql import Observation
    seen = Observation()
    spark.range(3).observe(seen, F.count(F.lit(1)).alias("n")).collect()
    assert seen.get == {"n": 3}  # the session now holds its observations, which cannot be serialised
    rows = [("good day", "positive"), ("good", "positive"), ("bad", "negative"), ("bad day", "negative"), ("day", None)]
    train = spark.createDataFrame(rows, "text string, sentiment string")
    m = train_sentiment_model(train, num_features=64, max_iter=10, threshold=0.5)
    got = {r["text"]: r["sentiment"] for r in m.transform(train.select("text")).collect()}
    assert got["good"] == "positive" and got["bad"] == "negative" and len(got) == 5
    assert not m.pipeline_model.stages[-1].hasSummary
