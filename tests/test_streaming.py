"""Streaming: availableNow over files equals batch; restart adds no duplicates."""

import os

from pyspark.sql import functions as F

from tagweave.operators import graph
from tagweave.schema import STREAM_OUT
from tagweave.sinks import write_chunks
from tagweave.sources.fixtures import raw_view
from tagweave.streaming import (live_edges, live_vertices, start_graph_stream, start_stream,
                                to_wire)
from conftest import SF_SMALL


def wire_batches(spark):
    wire = to_wire(raw_view(spark, SF_SMALL, "posts"))
    return [wire.where(F.pmod(F.xxhash64("id"), F.lit(4)) == i) for i in range(4)]


def read_out(spark, out):
    return spark.read.schema(STREAM_OUT).json(out)


def test_stream_restart_no_duplicates(spark, scratch):
    parts = wire_batches(spark)
    inp, out, ckpt = (os.path.join(scratch, d) for d in ("in", "out", "ckpt"))
    for i in range(3):
        write_chunks(parts[i], os.path.join(inp, f"b{i}"), chunk_size=500)
    # the file source lists the folder, so each batch dir becomes files of one folder
    flat = os.path.join(scratch, "flat")
    for i in range(3):
        parts[i].write.mode("append").json(flat)
    q = start_stream(spark, flat, out, ckpt, trigger="available_now", max_files_per_trigger=1)
    q.awaitTermination()
    first = read_out(spark, out).count()
    parts[3].write.mode("append").json(flat)
    q = start_stream(spark, flat, out, ckpt, trigger="available_now")
    q.awaitTermination()
    got = read_out(spark, out)
    expected = sum(p.count() for p in parts)
    assert first < expected
    assert got.count() == expected
    assert got.select("id").distinct().count() == expected
    assert dict(got.dtypes)["hashtags"] == "array<string>"


def test_live_graph_equals_batch(spark, scratch):
    parts = wire_batches(spark)
    flat, state, ckpt = (os.path.join(scratch, d) for d in ("flat", "state", "ckpt"))
    for p in parts:
        p.write.mode("append").json(flat)
    q = start_graph_stream(spark, flat, state, ckpt, dedupe=False, trigger="available_now",
                           max_files_per_trigger=2)
    q.awaitTermination()
    from tagweave.sources.fixtures import scored_view
    posts = scored_view(spark, SF_SMALL, "posts")
    bv = {tuple(r) for r in graph.vertices(posts).collect()}
    be = {tuple(r) for r in graph.edges(posts).collect()}
    assert {tuple(r) for r in live_vertices(spark, state).select("id", "degree", "dominant_sentiment").collect()} == bv
    assert {tuple(r) for r in live_edges(spark, state).collect()} == be


def test_live_graph_empty_state(spark, scratch):
    assert live_vertices(spark, os.path.join(scratch, "none")).count() == 0
    assert live_edges(spark, os.path.join(scratch, "none")).count() == 0


def test_processing_time_trigger_picks_up_new_files(spark, scratch):
    parts = wire_batches(spark)
    flat, out, ckpt = (os.path.join(scratch, d) for d in ("flat", "out", "ckpt"))
    parts[0].write.mode("append").json(flat)
    q = start_stream(spark, flat, out, ckpt, trigger="1 second")
    try:
        q.processAllAvailable()
        parts[1].write.mode("append").json(flat)
        q.processAllAvailable()
        assert q.isActive
    finally:
        q.stop()
    assert read_out(spark, out).count() == parts[0].count() + parts[1].count()


def test_replayed_batch_does_not_double_count(spark, scratch):
    from tagweave.streaming import write_deltas
    posts = spark.createDataFrame([(["a", "b"], "positive"), (["a"], "negative")],
                                  "hashtags array<string>, sentiment string")
    state = os.path.join(scratch, "state")
    write_deltas(posts, state, 0)
    write_deltas(posts, state, 1)
    write_deltas(posts, state, 1)  # a retry of batch 1 overwrites its own partition
    v = {r["id"]: (r["degree"], r["dominant_sentiment"]) for r in live_vertices(spark, state).collect()}
    assert v == {"a": (4, "negative"), "b": (2, "positive")}
    assert {tuple(r) for r in live_edges(spark, state).collect()} == {("a", "b", 2)}


POSTS = [(["a", "b"], "positive")]
TAGGED = "hashtags array<string>, sentiment string"


def pointer_of(spark, state):
    from tagweave.streaming.live_graph import _current
    return _current(spark, state)


def test_levels_keep_reads_and_folders_bounded(spark, scratch, monkeypatch):
    from tagweave.streaming import live_graph, write_deltas
    monkeypatch.setattr(live_graph, "FAN", 3)
    monkeypatch.setattr(live_graph, "KEEP", 4)
    posts = spark.createDataFrame(POSTS, TAGGED)
    state = os.path.join(scratch, "state")
    for batch in range(30):
        write_deltas(posts, state, batch)
    p = pointer_of(spark, state)
    assert p["batch"] == 29 and len(p["snapshots"]) <= 3 * 4  # 30 batches in base 3
    assert sorted(s["level"] for s in p["snapshots"]) == [1, 3]
    assert len(os.listdir(os.path.join(state, "current"))) <= 2 * 5  # pointers (and their checksum files)
    assert len(os.listdir(os.path.join(state, "data"))) <= 15 and len(p["dropped"]) <= 12
    assert {tuple(r) for r in live_edges(spark, state).collect()} == {("a", "b", 30)}
    assert {r["id"]: r["degree"] for r in live_vertices(spark, state).collect()} == {"a": 30, "b": 30}


def test_replay_after_compaction_and_after_a_broken_attempt(spark, scratch):
    from tagweave.streaming import compact, write_deltas
    from tagweave.streaming.live_graph import _delta, _write_snapshot
    from tagweave.operators.graph import edges, sentiment_profile
    posts = spark.createDataFrame(POSTS, TAGGED)
    state = os.path.join(scratch, "state")
    for batch in range(3):
        write_deltas(posts, state, batch)
    compact(spark, state)
    write_deltas(posts, state, 2)  # the last batch comes again
    assert len(pointer_of(spark, state)["snapshots"]) == 1
    _write_snapshot(spark, state, 0, 3, _delta(sentiment_profile(posts), edges(posts)))  # data without a pointer
    before = len(os.listdir(os.path.join(state, "data")))
    write_deltas(posts, state, 3)
    assert len(os.listdir(os.path.join(state, "data"))) == before  # the broken attempt's folder is gone
    write_deltas(posts.where("false"), state, 4)  # an empty batch
    for _ in range(2):
        assert {tuple(r) for r in live_edges(spark, state).collect()} == {("a", "b", 4)}
        assert {r["id"]: r["degree"] for r in live_vertices(spark, state).collect()} == {"a": 4, "b": 4}
        compact(spark, state)


def test_state_belongs_to_one_stream(spark, scratch):
    import pytest
    from tagweave.streaming import write_deltas
    parts = wire_batches(spark)
    inp, state, ckpt = (os.path.join(scratch, d) for d in ("in", "state", "ckpt"))
    parts[0].write.json(inp)
    start_graph_stream(spark, inp, state, ckpt, trigger="available_now").awaitTermination()
    n = live_edges(spark, state).agg(F.sum("weight")).first()[0]
    with pytest.raises(ValueError, match="another checkpoint"):  # a new one
        start_graph_stream(spark, inp, state, os.path.join(scratch, "new"))
    other = os.path.join(scratch, "other")  # one that another stream has used
    start_stream(spark, inp, os.path.join(scratch, "out"), other, trigger="available_now").awaitTermination()
    with pytest.raises(ValueError, match="another checkpoint"):
        start_graph_stream(spark, inp, state, other)
    with pytest.raises(ValueError, match="another stream"):
        write_deltas(spark.createDataFrame(POSTS, TAGGED), state, 7, "x")
    parts[1].write.mode("append").json(inp)  # its own goes on
    start_graph_stream(spark, inp, state, ckpt, trigger="available_now").awaitTermination()
    assert live_edges(spark, state).agg(F.sum("weight")).first()[0] > n


def wire_rows(spark, path, *rows):
    """Wire files written one after the other: (id, time of day, tags)."""
    import json
    df = spark.createDataFrame([(str(i), f"post {i}", json.dumps(tags), f"Mon Apr 06 {t} 2009", "neutral") for i, t, tags in rows],
                               "id string, text string, hashtags string, created_at string, sentiment string")
    df.coalesce(1).write.mode("append").json(path)


def test_a_post_sent_again_counts_once_and_late_ones_do_not(spark, scratch):
    inp, out, ckpt, state, ckpt2 = (os.path.join(scratch, d) for d in ("in", "out", "ckpt", "state", "ckpt2"))
    run = lambda: (start_stream(spark, inp, out, ckpt, trigger="available_now", dedupe_within="1 hour").awaitTermination(),
                   start_graph_stream(spark, inp, state, ckpt2, trigger="available_now", dedupe_within="1 hour").awaitTermination())
    wire_rows(spark, inp, (1, "10:00:00", ["a"]), (2, "10:05:00", ["a", "b"]), (2, "10:05:00", ["a", "b"]))
    run()
    wire_rows(spark, inp, (1, "10:00:00", ["a"]), (3, "10:30:00", ["b"]))  # 1 again, in another batch
    run()
    wire_rows(spark, inp, (4, "14:00:00", ["c"]))  # moves the watermark to 13:00
    run()
    wire_rows(spark, inp, (5, "11:00:00", ["late"]), (6, "13:30:00", ["c"]), (4, "14:00:00", ["c"]))
    run()
    rows = spark.read.schema("id string, event_time timestamp").json(out).collect()
    assert sorted(r["id"] for r in rows) == ["1", "2", "3", "4", "6"]
    assert {r["id"]: r["degree"] for r in live_vertices(spark, state).collect()} == {"a": 2, "b": 2, "c": 2}


def test_tags_by_window_of_event_time(spark, scratch):
    from tagweave.streaming import decode_wire, read_wire_stream, windowed_tag_counts
    inp, out, ckpt = (os.path.join(scratch, d) for d in ("in", "out", "ckpt"))

    def run():
        counts = windowed_tag_counts(decode_wire(read_wire_stream(spark, inp), keep_event_time=True), "1 hour", "30 minutes")
        counts.writeStream.format("parquet").option("path", out).option("checkpointLocation", ckpt).trigger(availableNow=True).start().awaitTermination()

    wire_rows(spark, inp, (1, "10:10:00", ["a"]), (2, "10:50:00", ["a", "b"]), (3, "11:10:00", ["a"]))
    run()
    wire_rows(spark, inp, (4, "10:45:00", ["b"]), (5, "12:40:00", ["c"]))  # 4 is out of order, but not late
    run()
    wire_rows(spark, inp, (6, "10:55:00", ["a"]), (7, "14:00:00", ["c"]))  # 6 is late: its window is closed
    run()
    got = {(r["start"].hour, r["tag"]): r["n"] for r in spark.read.parquet(out).collect()}
    assert got == {(10, "a"): 2, (10, "b"): 2, (11, "a"): 1, (12, "c"): 1}


def test_a_small_batch_is_one_shuffle_of_few_tasks(spark, scratch):
    from tagweave.streaming.live_graph import _counted, write_deltas
    rows = [(["a", "b", "b"], "positive"), (["a"], "negative"), ([], "neutral"), (None, "neutral")]
    posts = spark.createDataFrame(rows, TAGGED).repartition(5).persist()
    delta, tasks = _counted(posts)
    plan = delta._jdf.queryExecution().executedPlan().toString()
    assert tasks == 1 and plan.count("Exchange hashpartitioning") <= 1  # two aggregates and the block plan before: four
    long = ([f"t{i:03d}" for i in range(70)] + ["a"], "negative")  # beyond the row-local plan, in one batch with short ones
    state, partitions = os.path.join(scratch, "state"), spark.conf.get("spark.sql.shuffle.partitions")
    for batch, part in enumerate([posts, posts.union(spark.createDataFrame([long], TAGGED)), posts.where("false"), *[posts] * 6]):
        write_deltas(part, state, batch)
    alls = spark.createDataFrame(rows * 8 + [long], TAGGED)
    want = graph.build_graph(alls.na.fill({"sentiment": "neutral"}))
    assert {tuple(r) for r in live_vertices(spark, state).collect()} == {tuple(r) for r in want[0].collect()}
    assert {tuple(r) for r in live_edges(spark, state).collect()} == {tuple(r) for r in want[1].collect()}
    assert spark.conf.get("spark.sql.shuffle.partitions") == partitions
    assert spark.conf.get("spark.sql.adaptive.coalescePartitions.initialPartitionNum", None) is None
    assert all(len(os.listdir(os.path.join(state, "data", d, p))) <= 2 for d in os.listdir(os.path.join(state, "data"))
               if d.split("-")[1] == "0" and int(d.split("-")[0]) != 1 for p in os.listdir(os.path.join(state, "data", d)) if p.startswith("part="))


def test_state_of_sent_again_posts_is_committed_by_the_cores(spark, scratch):
    from tagweave.streaming import files
    wire = to_wire(raw_view(spark, SF_SMALL, "posts")).limit(300)
    inp, out, ckpt = (os.path.join(scratch, d) for d in ("in", "out", "ckpt"))
    for order in ("id", "text"):
        write_chunks(wire, inp, chunk_size=100, order_by=(order,))
    before = {k: spark.conf.get(k, None) for k in ("spark.sql.shuffle.partitions", "spark.sql.streaming.stateStore.providerClass")}
    spark.conf.set("spark.sql.shuffle.partitions", "200")
    try:
        q = start_stream(spark, inp, out, ckpt, trigger="available_now", max_files_per_trigger=3, dedupe_within="20000 days")
        assert spark.conf.get("spark.sql.shuffle.partitions") == "200"  # the session's own settings are as they were
        q.awaitTermination()
    finally:
        spark.conf.set("spark.sql.shuffle.partitions", before["spark.sql.shuffle.partitions"])
    assert spark.conf.get("spark.sql.streaming.stateStore.providerClass", None) == before["spark.sql.streaming.stateStore.providerClass"]
    parts = [d for d in os.listdir(os.path.join(ckpt, "state", "0")) if d.isdigit()]
    assert len(parts) <= files.STATE_PARTITIONS_PER_CORE * spark.sparkContext.defaultParallelism
    assert sorted(r["id"] for r in read_out(spark, out).collect()) == sorted(r["id"] for r in wire.collect())


def test_batches_of_a_stream_share_their_code_and_logs_stay_readable(spark, scratch):
    from tagweave.streaming import files
    compiled = spark._jvm.org.apache.spark.metrics.source.CodegenMetrics.METRIC_COMPILATION_TIME()
    wire = to_wire(raw_view(spark, SF_SMALL, "posts")).limit(260).localCheckpoint()
    inp, out, ckpt = (os.path.join(scratch, d) for d in ("in", "out", "ckpt"))
    names = ("spark.sql.streaming.fileSource.log.compactInterval", "spark.sql.streaming.checkpointFileManagerClass")
    before = [spark.conf.get(k, None) for k in names]
    write_chunks(wire, inp, chunk_size=10)
    n = compiled.getCount()
    start_stream(spark, inp, out, ckpt, trigger="available_now", max_files_per_trigger=2).awaitTermination()  # 13 batches
    assert compiled.getCount() - n <= 5  # one for each batch before
    assert [spark.conf.get(k, None) for k in names] == before
    rows = read_out(spark, out)
    assert rows.select("processing_time").distinct().count() == 13
    first = sorted(map(str, rows.select("id", "text").collect()))
    assert first == sorted(map(str, wire.select("id", "text").collect()))
    log = os.path.join(ckpt, "sources", "0")
    assert not [f for f in os.listdir(log) if f.endswith(".compact")] and files.SOURCE_LOG_INTERVAL > 13  # written anew at the tenth batch before
    write_chunks(wire, inp, chunk_size=10)  # a restart reads the log
    start_stream(spark, inp, out, ckpt, trigger="available_now", max_files_per_trigger=2).awaitTermination()
    assert sorted(map(str, read_out(spark, out).select("id", "text").collect())) == sorted(first * 2)
    assert files.log_conf(spark, "file:/a", "/b").keys() == set(names)


def test_a_batch_of_the_live_graph_is_one_job_without_a_shuffle(spark, scratch):
    """Pairs are made and summed once for FAN batches; before, every batch was counted in jobs of its own."""
    from tagweave.streaming import live_graph, write_deltas
    long = ([f"t{i:03d}" for i in range(70)] + ["a"], "negative")
    rows = [(["a", "b", "b"], "positive"), (["a"], "negative"), ([], "neutral")]
    posts = spark.createDataFrame(rows, TAGGED).coalesce(1).cache()
    posts.count()
    state, tracker = os.path.join(scratch, "state"), spark.sparkContext.statusTracker()
    for batch in range(3):
        spark.sparkContext.setJobGroup(f"batch-{batch}", "")
        write_deltas(posts, state, batch)
        jobs = tracker.getJobIdsForGroup(f"batch-{batch}")
        assert len(jobs) == 1 and len(tracker.getJobInfo(jobs[0]).stageIds) == 1
    spark.sparkContext.setLocalProperty("spark.jobGroup.id", None)
    n = live_graph.FAN
    for batch in range(3, n + 4):
        write_deltas(posts.union(spark.createDataFrame([long], TAGGED)) if batch in (5, n + 2) else posts, state, batch)
    snapshots = pointer_of(spark, state)["snapshots"]
    assert [s["level"] for s in snapshots] == [1, 0, 0, 0, 0]  # sums of FAN batches, and posts of the last ones
    alls = spark.createDataFrame(rows * (n + 4) + [long] * 2, TAGGED)
    want = graph.build_graph(alls)
    for _ in range(2):  # levels together, then one snapshot
        assert {tuple(r) for r in live_vertices(spark, state).collect()} == {tuple(r) for r in want[0].collect()}
        assert {tuple(r) for r in live_edges(spark, state).collect()} == {tuple(r) for r in want[1].collect()}
        live_graph.compact(spark, state)
    assert [s["level"] for s in pointer_of(spark, state)["snapshots"]] == [2]


def test_control_files_by_hadoop_and_by_plain_files_are_the_same(spark, scratch, monkeypatch):
    from tagweave.streaming import compact, live_graph, write_deltas
    posts = spark.createDataFrame(POSTS, TAGGED)
    state = os.path.join(scratch, "state")
    for batch in range(4):  # by turns
        monkeypatch.setattr(live_graph, "_plain", (lambda *_: None) if batch % 2 else (lambda _, path: path.removeprefix("file:")))
        write_deltas(posts, state, batch)
        assert pointer_of(spark, state)["batch"] == batch
    compact(spark, state)
    os.makedirs(os.path.join(state, "data", "000000000004-0-broken"))
    write_deltas(posts, state, 4)
    assert not os.path.exists(os.path.join(state, "data", "000000000004-0-broken"))
    assert {tuple(r) for r in live_edges(spark, state).collect()} == {("a", "b", 5)}


def test_logs_of_a_stream_hold_what_is_superseded_for_seconds_only(spark, scratch, monkeypatch):
    """Each batch lists the folders of the logs; with ten minutes of entries in them a batch costs the more the faster the batches are."""
    from tagweave.streaming import files
    monkeypatch.setattr(files, "LOG_DELAY", 0)
    names = [f"spark.sql.streaming.{n}.log.cleanupDelay" for n in ("fileSource", "fileSink")]
    assert files.upkeep_conf(spark) == {n: "0" for n in names}
    wire = to_wire(raw_view(spark, SF_SMALL, "posts")).limit(240).localCheckpoint()
    inp, out, ckpt = (os.path.join(scratch, d) for d in ("in", "out", "ckpt"))
    write_chunks(wire, inp, chunk_size=10)
    spark.conf.set("spark.sql.streaming.minBatchesToRetain", "5")
    try:
        start_stream(spark, inp, out, ckpt, trigger="available_now", max_files_per_trigger=1).awaitTermination()  # 24 batches
    finally:
        spark.conf.unset("spark.sql.streaming.minBatchesToRetain")
    log = [f for f in os.listdir(os.path.join(out, "_spark_metadata")) if not f.startswith(".")]
    assert len(log) < 24 and "19.compact" in log and "0" not in log
    assert [spark.conf.get(n, None) for n in names] == [None, None]
    assert sorted(map(str, read_out(spark, out).select("id", "text").collect())) == sorted(map(str, wire.select("id", "text").collect()))
    spark.conf.set(names[0], "7s")  # the session's own setting stays
    assert list(files.upkeep_conf(spark)) == names[1:]
    spark.conf.unset(names[0])
