"""Graph operators against the plain-Python model: duplicates, ties, all pair plans."""

import random

import pytest
from pyspark.sql import functions as F

import brute
from tagweave.operators import graph


def posts_df(spark, posts):
    return spark.createDataFrame(posts, "hashtags array<string>, sentiment string")


def collect_edges(df):
    return {(r["src"], r["dst"]): r["weight"] for r in df.collect()}


def collect_vertices(df):
    return {r["id"]: (r["degree"], r["dominant_sentiment"]) for r in df.collect()}


def test_duplicates_make_self_loops_and_multiply(spark):
    df = posts_df(spark, [(["b", "a", "a"], "positive")])
    assert collect_edges(graph.edges(df, "array")) == {("a", "a"): 1, ("a", "b"): 2}
    assert collect_edges(graph.edges(df, "blocks")) == {("a", "a"): 1, ("a", "b"): 2}
    assert collect_vertices(graph.vertices(df)) == {"a": (2, "positive"), "b": (1, "positive")}


def test_tie_goes_to_alphabetical_first(spark):
    df = posts_df(spark, [(["x"], "positive"), (["x"], "negative")])
    assert collect_vertices(graph.vertices(df)) == {"x": (2, "negative")}
    assert collect_vertices(graph.vertices(df, sentiments=None)) == {"x": (2, "negative")}


def test_no_tags_no_vertices(spark):
    df = posts_df(spark, [([], "neutral"), (None, "neutral"), (["solo"], "neutral")])
    assert collect_vertices(graph.vertices(df)) == {"solo": (1, "neutral")}
    assert collect_edges(graph.edges(df)) == {}


def random_posts(seed, n_posts=300, long_posts=3):
    rnd = random.Random(seed)
    vocab = [f"t{i}" for i in range(40)] + ["é", "日本", "z_9"]
    sents = ["positive", "negative", "neutral"]
    posts = []
    for _ in range(n_posts):
        k = rnd.choice([0, 1, 2, 3, 5, 8])
        posts.append(([rnd.choice(vocab[:12]) for _ in range(k)], rnd.choice(sents)))
    for _ in range(long_posts):  # long posts with repeats: the block plan
        posts.append(([rnd.choice(vocab) for _ in range(rnd.randint(70, 400))], rnd.choice(sents)))
    return posts


@pytest.mark.parametrize("seed", [1, 2])
def test_all_pair_plans_equal_brute_force(spark, seed):
    posts = random_posts(seed)
    exp_v, exp_e = brute.graph(posts)
    df = posts_df(spark, posts)
    assert collect_vertices(graph.vertices(df)) == exp_v
    assert collect_vertices(graph.vertices(df, sentiments=None)) == exp_v
    for method in ("auto", "array", "blocks"):
        assert collect_edges(graph.edges(df, method)) == exp_e, method
    # tiny blocks: a long post is cut into many blocks on many partitions
    assert collect_edges(graph.edges(df, "auto", array_pair_limit=4, salt_block=3)) == exp_e


def test_invariants_and_summary(spark):
    posts = random_posts(3)
    df = posts_df(spark, posts)
    v, e = graph.build_graph(df)
    s = graph.graph_summary(v, e).first()
    assert s["tag_occurrences"] == sum(len(t) for t, _ in posts)
    assert s["total_pairs"] == sum(len(t) * (len(t) - 1) // 2 for t, _ in posts)
    assert e.where(F.col("src") > F.col("dst")).count() == 0
    assert e.join(v, e["src"] == v["id"], "left_anti").count() == 0
    assert e.join(v, e["dst"] == v["id"], "left_anti").count() == 0
    # invariant under row order and partitioning
    shuffled = df.repartition(5)
    assert collect_edges(graph.edges(shuffled)) == collect_edges(e)


def test_pair_occurrences_list(spark):
    df = posts_df(spark, [(["c", "a", "b"], "neutral")])
    got = sorted((r["src"], r["dst"]) for r in graph.pair_occurrences(df).collect())
    assert got == [("a", "b"), ("a", "c"), ("b", "c")]


def test_hash_keys_equal_brute_force(spark):
    posts = random_posts(4)
    _, exp_e = brute.graph(posts)
    df = posts_df(spark, posts)
    for method in ("auto", "array", "blocks"):
        assert collect_edges(graph.edges(df, method, keys="hash")) == exp_e, method
    assert collect_edges(graph.edges(df, keys="string")) == exp_e
    st = graph.key_stats(df)
    assert st["tags"] == st["keys"]


def test_hash_plan_gate():
    ok = graph._hash_plan_ok
    assert ok({"tags": 5000, "keys": 5000, "bytes": 1000})
    assert not ok({"tags": 5000, "keys": 4999, "bytes": 1000})       # a collision: strings
    assert not ok({"tags": 10, "keys": 10, "bytes": 100})            # small vocabulary
    assert not ok({"tags": 5000, "keys": 5000, "bytes": 1 << 40})    # dictionary too large to broadcast


def test_copies_of_a_long_post_are_paired_once(spark):
    tags = [f"t{i:03d}" for i in range(100)]
    df = posts_df(spark, [(tags, "neutral")] * 400 + [(["a", "a", "b"], "neutral")])
    got = collect_edges(graph.edges(df))
    assert len(got) == 4950 + 2 and got["t000", "t099"] == 400 and got["a", "a"] == 1 and got["a", "b"] == 2
    assert graph.post_pairs(df).count() == 4950 + 3


def test_pair_totals_equal_the_graph(spark):
    posts = random_posts(6) + [([], "neutral")]
    df = posts_df(spark, posts)
    _, exp_e = brute.graph(posts)
    row = graph.pair_totals(df).first()
    assert row["total_pairs"] == sum(exp_e.values())
    assert row["self_loops"] == sum(a == b for a, b in exp_e)
    assert row["posts"] == sum(bool(t) for t, _ in posts) and row["tag_occurrences"] == sum(len(t) for t, _ in posts)


def test_pair_occurrences_of_long_posts_keep_their_sentiment(spark, monkeypatch):
    from collections import Counter
    from itertools import combinations
    monkeypatch.setattr(graph, "_LISTED", 3)
    long = [f"t{i % 60:02d}" for i in range(90)]
    posts = [(long, "positive"), (long, "positive"), (long, "negative"), (["b", "a", "a"], "neutral"), (["x"], "neutral"), ([], "neutral")]
    want = Counter((a, b, s) for tags, s in posts for a, b in combinations(sorted(tags), 2))
    df = spark.createDataFrame(posts, "hashtags array<string>, sentiment string")
    assert Counter(tuple(r) for r in graph.pair_occurrences(df).collect()) == want


def test_grid_shuffles_tags_not_pairs_and_equals_brute_force(spark, monkeypatch):
    from tagweave.operators import pair_grid
    rnd = random.Random(7)
    vocab = [f"t{i}" for i in range(1500)] + ["é", "日本", "𝒳", "ｚ"]  # the last two: UTF-8 and UTF-16 order them differently
    long = [rnd.choice(vocab) for _ in range(300)]
    posts = [([rnd.choice(vocab) for _ in range(rnd.choice([0, 1, 2, 9, 30, 90, 200]))] + ["hot"], "neutral") for _ in range(150)]
    posts += [(long, "neutral")] * 5 + [(["a", "a", "a"], "neutral"), (None, "neutral"), ([], "neutral")]
    exp_v, exp_e = brute.graph([(t or [], s) for t, s in posts])
    assert len(exp_v) >= graph.HASH_MIN_TAGS
    df = posts_df(spark, posts).repartition(3)
    e = graph.edges(df, keys="auto")
    plan = e._jdf.queryExecution().executedPlan().toString()
    assert "HashAggregate(keys=[src" not in plan and "_hs" not in plan  # no pair is summed behind a shuffle
    assert collect_edges(e) == exp_e and e.count() == len(exp_e)
    # few pairs at once, small dense blocks: both ways to sum take several steps
    monkeypatch.setattr(pair_grid, "PAIRS_AT_ONCE", 500)
    monkeypatch.setattr(pair_grid, "DENSE_SUMS", 600)
    assert collect_edges(pair_grid.grid_edges(graph._collapsed(df, 65), 3)) == exp_e


def test_grid_groups_follow_the_tags():
    from tagweave.operators.pair_grid import CELL_TAGS, MAX_GROUPS, groups_for
    assert groups_for(0, 1) == 2 and groups_for(1000, 12) * (groups_for(1000, 12) + 1) // 2 >= 36
    assert 2 * 10 * CELL_TAGS / groups_for(10 * CELL_TAGS, 12) <= CELL_TAGS and groups_for(1 << 60, 12) == MAX_GROUPS


def test_grid_shuffles_the_tags_once_whatever_its_groups(spark):
    from tagweave.operators import pair_grid
    rows = [([f"t{(i * j) % 97}" for j in range(2 + i % 70)], "positive") for i in range(300)]
    df = spark.createDataFrame(rows, "hashtags array<string>, sentiment string").repartition(4).localCheckpoint()
    want = collect_edges(graph.edges(df))
    for groups in (2, 12):
        edges = pair_grid.grid_edges(graph._collapsed(df, 65), groups)
        assert collect_edges(edges) == want
        edges.collect()
        plan = edges._jdf.queryExecution().executedPlan().toString().split("Initial Plan")[0]
        # before, each row was repeated for all cells of its group; now both sides of the cells read one shuffle
        assert "CartesianProduct" in plan and "explode" not in plan and "ReusedExchange" in plan
