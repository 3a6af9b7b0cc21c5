"""Top-N views, degree centrality and PageRank."""

import pytest
from pyspark.sql import functions as F

import brute
from tagweave.operators import centrality, graph, views


@pytest.fixture
def small_graph(spark):
    posts = [(["a", "b", "c"], "positive"), (["a", "b"], "negative"), (["a", "d"], "neutral"),
             (["e"], "neutral"), (["b", "b"], "positive")]
    df = spark.createDataFrame(posts, "hashtags array<string>, sentiment string")
    return posts, graph.vertices(df), graph.edges(df)


def test_top_vertices_ties_by_id(spark, small_graph):
    _, v, _ = small_graph
    assert [r["id"] for r in views.top_vertices(v, 3).collect()] == ["b", "a", "c"]


def test_top_subgraph(spark, small_graph):
    _, v, e = small_graph
    nodes = {r["id"]: r for r in views.top_subgraph_nodes(v, e, 2).collect()}
    assert set(nodes) == {"a", "b"} and nodes["b"]["label"] == "#b"
    edges = {(r["source"], r["target"]): r["width"] for r in views.top_subgraph_edges(v, e, 2).collect()}
    assert edges == {("a", "b"): 1.0, ("b", "b"): 1.0}
    empty = e.where(F.lit(False))
    assert views.top_subgraph_nodes(v, empty, 2).count() == 0
    nodes_nested, _ = views.subgraph_elements(v, e, 2)
    assert nodes_nested.first()["style"]["background-color"].startswith("#")


def test_split_and_bar(spark, small_graph):
    _, v, _ = small_graph
    split = [(r["dominant_sentiment"], r["count"]) for r in views.vertex_sentiment_split(v).collect()]
    assert split == [("neutral", 2), ("positive", 2), ("negative", 1)]
    assert views.top_bar(v, 1).first()["label"] == "#b"


def test_degree_centrality(spark, small_graph):
    _, v, e = small_graph
    got = {r["id"]: (r["neighbor_degree"], r["weighted_degree"]) for r in
           centrality.degree_centrality(v, e).collect()}
    assert got == {"a": (3, 4), "b": (2, 3), "c": (2, 2), "d": (1, 1), "e": (0, 0)}


def test_pagerank_matches_brute_force(spark, small_graph):
    posts, v, e = small_graph
    bv, be = brute.graph(posts)
    exp = brute.pagerank(bv, be, 5)
    got = {r["id"]: r["rank"] for r in
           centrality.pagerank(v, e, max_iter=5, tol=None).collect()}
    assert got.keys() == exp.keys()
    assert all(abs(got[k] - exp[k]) < 1e-9 for k in exp)
    for plan in ("blocks", "lazy"):
        same = {r["id"]: r["rank"] for r in centrality.pagerank(v, e, max_iter=5, tol=None, plan=plan).collect()}
        assert all(abs(same[k] - exp[k]) < 1e-9 for k in exp)


@pytest.fixture
def no_broadcast(spark):
    old = spark.conf.get("spark.sql.autoBroadcastJoinThreshold")
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", "-1")  # as for a vector that is too large
    yield
    spark.conf.set("spark.sql.autoBroadcastJoinThreshold", old)


def test_blocked_adjacency_is_not_shuffled_and_a_hub_is_split(spark, monkeypatch, no_broadcast):
    monkeypatch.setattr(centrality, "HUB_NEIGHBOURS", 50)
    monkeypatch.setattr(centrality, "BLOCK_NEIGHBOURS", 200)
    n = 1000  # a star with a ring: the hub has n neighbours
    edges = [("hub", f"v{i:04d}") for i in range(n)] + [tuple(sorted((f"v{i:04d}", f"v{(i + 1) % n:04d}"))) for i in range(n)]
    e = spark.createDataFrame([(a, b, 1) for a, b in edges], "src string, dst string, weight long")
    v = spark.createDataFrame([("hub", 1, "neutral"), ("lone", 1, "neutral")] + [(f"v{i:04d}", 1, "neutral") for i in range(n)],
                              "id string, degree long, dominant_sentiment string")
    adj = centrality._undirected(e).select(F.col("id").alias("src"), F.col("nbr").alias("dst"))
    ranks = adj.groupBy(F.col("src").alias("_k")).agg(F.count(F.lit(1)).alias("_deg"))
    blocks = centrality._Blocks(adj, ranks)
    try:
        table = spark.table(blocks.name)
        rows = table.where("src = 'hub'").select(F.size("dsts").alias("n"), F.spark_partition_id().alias("p")).collect()
        assert sum(r["n"] for r in rows) == n and len(rows) == n // 50 and max(r["n"] for r in rows) < 100
        messages = blocks.messages(spark.createDataFrame([("hub", 1.0, n)], "_k string, rank double, _deg long"))
        plan = messages._jdf.queryExecution().executedPlan().toString()
        scan = plan.index("Bucketed: true")
        assert plan.count("Exchange") <= 1 and "Exchange" not in plan[plan.rindex("Join", 0, scan):scan] and messages.count() == n, plan
    finally:
        blocks.drop()
    fast = {r["id"]: r["rank"] for r in centrality.pagerank(v, e, tol=1e-5).collect()}
    slow = {r["id"]: r["rank"] for r in centrality.pagerank(v, e, tol=1e-5, plan="blocks").collect()}
    assert fast.keys() == slow.keys() and all(abs(fast[k] - slow[k]) < 1e-9 for k in fast)
    # the fixed point: each rank equals its own update
    nbrs = {}
    for a, b in edges:
        nbrs.setdefault(a, []).append(b)
        nbrs.setdefault(b, []).append(a)
    assert all(abs(slow[k] - 0.15 - 0.85 * sum(slow[u] / len(nbrs[u]) for u in nbrs.get(k, []))) < 1e-5 for k in slow)


def test_pagerank_converges(spark, small_graph):
    _, v, e = small_graph
    r = {x["id"]: x["rank"] for x in centrality.pagerank(v, e, max_iter=100, tol=1e-6).collect()}
    assert abs(r["e"] - 0.15) < 1e-12 and r["a"] > r["d"]


def path_graph(spark, n):
    v = spark.createDataFrame([(f"{i:03d}", 1, "neutral") for i in range(n)], "id string, degree long, dominant_sentiment string")
    e = spark.createDataFrame([(f"{i:03d}", f"{i + 1:03d}", 1) for i in range(n - 1)], "src string, dst string, weight long")
    return v, e


def test_pagerank_runs_to_its_tolerance(spark):
    import pytest
    from tagweave.operators.centrality import NotConverged, pagerank
    v, e = path_graph(spark, 60)
    done = {r["id"]: r["rank"] for r in pagerank(v, e, tol=1e-4).collect()}
    long = {r["id"]: r["rank"] for r in pagerank(v, e, max_iter=80, tol=None).collect()}
    assert max(abs(done[k] - long[k]) for k in long) < 1e-3
    with pytest.raises(NotConverged) as error:
        pagerank(v, e, max_iter=3, tol=1e-6)
    assert error.value.moved > 1e-6 and error.value.ranks.count() == 60


def test_one_vertex_has_centrality_zero(spark):
    from tagweave.operators.centrality import degree_centrality
    v, e = path_graph(spark, 1)
    assert degree_centrality(v, e).first()["centrality"] == 0.0


def test_large_top_n_and_posts_in_top(spark):
    from tagweave.operators import graph, views
    v, e = path_graph(spark, 50)
    assert views.top_vertices(v, 20_000).count() == 50 and views.top_subgraph_edges(v, e, 20_000).count() == 49
    posts = spark.createDataFrame([(["a", "b", "c"], "neutral")] * 3 + [(["a", "z"], "neutral"), (["b", "b"], "neutral")],
                                  "hashtags array<string>, sentiment string")
    v = graph.vertices(posts)
    want = {tuple(r) for r in views.top_subgraph_edges(v, graph.edges(posts), 2).collect()}
    got = {tuple(r) for r in views.top_subgraph_edges(v, graph.edges(views.posts_in_top(posts, v, 2)), 2).collect()}
    assert got == want and len(got) == 2


def test_slider_index_answers_every_setting(spark):
    from tagweave.operators import views
    from tagweave.sources.fixtures import scored_view
    posts = scored_view(spark, "/root/testdata/sf0.001", "turn_posts").select("hashtags", "sentiment").cache()
    v, e = graph.vertices(posts), graph.edges(posts)
    nodes, links = views.slider_index(v, graph.edges(views.posts_in_top(posts, v, 50)))
    nodes, links = nodes.cache(), links.cache()
    for n in views.SLIDER:
        want_nodes, want_links = views.top_subgraph(v, e, n)
        assert sorted(map(tuple, nodes.where(nodes["rank"] <= n).drop("rank").collect())) == sorted(map(tuple, want_nodes.collect()))
        assert sorted(map(tuple, links.where(links["rank"] <= n).drop("rank").collect())) == sorted(map(tuple, want_links.collect()))
    assert views.at_slider(nodes).count() == sum(min(n, nodes.count()) for n in views.SLIDER)
    posts.unpersist()


def test_subgraph_nodes_need_a_pair_not_the_edges(spark):
    from tagweave.operators import views
    lone = spark.createDataFrame([(["a"], "neutral"), (["b"], "neutral")], "hashtags array<string>, sentiment string")
    assert views.top_subgraph_nodes(graph.vertices(lone), views.posts_with_pairs(lone)).count() == 0
    loop = spark.createDataFrame([(["a", "a"], "neutral")], "hashtags array<string>, sentiment string")
    assert views.top_subgraph_nodes(graph.vertices(loop), views.posts_with_pairs(loop)).count() == 1


def test_both_directions_come_from_one_pass_over_the_edges(spark):
    e = spark.createDataFrame([("a", "b", 2), ("a", "a", 1), ("b", "c", 3)], "src string, dst string, weight long")
    both = centrality._undirected(e)
    assert sorted(map(tuple, both.collect())) == [("a", "b", 2), ("b", "a", 2), ("b", "c", 3), ("c", "b", 3)]
    assert "Union" not in both._jdf.queryExecution().executedPlan().toString()
