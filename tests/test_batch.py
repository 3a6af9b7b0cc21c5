"""The batch job end to end: CSV in, graph directories and top-N JSON out."""

import glob
import json
import os

from tagweave.plans.batch import run_batch
from tagweave.sources import read_graph


def test_run_batch_csv(spark, scratch):
    src = os.path.join(scratch, "in.csv")
    with open(src, "w", encoding="utf-8") as f:
        f.write('0,"1","Mon Apr 06 22:19:45 PDT 2009","NO_QUERY","u","#a #b #a"\n')
        f.write('4,"2","Mon Apr 06 22:19:45 PDT 2009","NO_QUERY","v","#b #c"\n')
        f.write('2,"3","Mon Apr 06 22:19:45 PDT 2009","NO_QUERY","w","no tags # here"\n')
        f.write('4,"4","Mon Apr 06 22:19:45 PDT 2009","NO_QUERY","x","plain"\n')
    out = os.path.join(scratch, "out")
    res = run_batch(spark, src, "csv", out, top_n=2)
    assert res.counts == {"posts": 4, "posts_with_hash": 3, "posts_with_tags": 2}
    v, e = read_graph(spark, out)
    assert {tuple(r) for r in v.collect()} == {("a", 2, "negative"), ("b", 2, "negative"),
                                                ("c", 1, "positive")}
    assert {tuple(r) for r in e.collect()} == {("a", "a", 1), ("a", "b", 2), ("b", "c", 1)}
    nodes = json.loads(open(glob.glob(os.path.join(res.top_json[0], "part-*"))[0]).read())
    assert [n["id"] for n in nodes] == ["a", "b"]
    split = {r["sentiment"]: r["count"] for r in res.sentiment.collect()}
    assert split == {"negative": 1, "positive": 2, "neutral": 1}


def test_run_batch_keeps_rejects_and_reads_the_input_once_for_the_counts(spark, scratch):
    src = os.path.join(scratch, "in.csv")
    with open(src, "w", encoding="utf-8") as f:
        f.write('0,"1","d","q","u","#a #b"\n4,"2","d","q","five"\n')
    out = os.path.join(scratch, "out")
    res = run_batch(spark, src, "csv", out, keep_rejects=True)
    assert res.counts == {"posts": 1, "posts_with_hash": 1, "posts_with_tags": 1}
    assert [r["record"] for r in spark.read.parquet(res.rejects_path).collect()] == ['4,"2","d","q","five"']
    open(src, "w").close()
    assert run_batch(spark, src, "csv", out, keep_rejects=True).counts == {"posts": 0, "posts_with_hash": 0, "posts_with_tags": 0}
