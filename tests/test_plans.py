"""Plan shape: no Python in the hot path, top-N as TakeOrderedAndProject, pushdown."""

from tagweave.operators import graph, views
from tagweave.plans.catalog import QUERIES
from tagweave.sources.fixtures import scored_view
from conftest import SF_SMALL


def plan_of(df):
    return df._jdf.queryExecution().executedPlan().toString()


def test_no_python_udfs_anywhere(spark):
    # these run jobs or streams before they return
    skip = ("sentiment_model", "model_", "stream_", "graph_roundtrip_", "batch_", "load_", "pagerank_tol")
    for name, q in QUERIES.items():
        if name.startswith(skip):
            continue
        p = plan_of(q(spark, SF_SMALL))
        assert "PythonUDF" not in p and "BatchEvalPython" not in p and "ArrowEvalPython" not in p, name


def test_top_vertices_plans_as_take_ordered(spark):
    v = graph.vertices(scored_view(spark, SF_SMALL, "posts"))
    assert "TakeOrderedAndProject" in plan_of(views.top_vertices(v, 20))


def test_top_subgraph_semi_joins_broadcast(spark):
    posts = scored_view(spark, SF_SMALL, "posts")
    v, e = graph.build_graph(posts)
    df = views.top_subgraph_edges(v, e, 20)
    df.collect()
    final = df._jdf.queryExecution().executedPlan().toString()
    assert "BroadcastHashJoin" in final and "LeftSemi" in final


def test_scan_prunes_columns(spark):
    df = QUERIES["tag_counts"](spark, SF_SMALL)
    p = df._jdf.queryExecution().executedPlan().toString()
    # orders scan reads only the columns the post view needs
    assert "o_totalprice" not in p and "o_orderpriority" not in p


def test_long_posts_are_spread_by_an_explicit_repartition(spark):
    df = spark.createDataFrame([([f"t{i}" for i in range(300)], "neutral")],
                               "hashtags array<string>, sentiment string")
    p = plan_of(graph.edges(df, method="blocks"))
    # an explicit partition count: adaptive execution must not coalesce the blocks back together
    assert "REPARTITION_BY_NUM" in p and "_fp" in p and "_b" in p


def test_tag_regex_runs_once_per_row(spark):
    for name in ("vertices", "tag_counts", "edges_by_multiplicity"):
        p = plan_of(QUERIES[name](spark, SF_SMALL))
        assert p.count("regexp_extract_all") == 1, name
    from tagweave.plans.batch import tagged_posts
    assert plan_of(tagged_posts(scored_view(spark, SF_SMALL, "posts"))).count("regexp_extract_all(lower") == 1
    assert plan_of(QUERIES["to_wire"](spark, SF_SMALL)).count("regexp_extract_all(lower") == 1
    # totals and self-loops read the posts in a branch each
    assert plan_of(QUERIES["doc_pair_totals"](spark, SF_SMALL)).count("regexp_extract_all") == 2
    # edges over raw text: one evaluation in each of its two branches (short / long posts)
    assert plan_of(QUERIES["edges"](spark, SF_SMALL)).count("regexp_extract_all") == 2


def test_hot_tag_is_combined_before_the_shuffle(spark):
    # one tag in every post: the vertex aggregate must be partial before its exchange
    df = spark.createDataFrame([(["hot", f"t{i % 50}"], "neutral") for i in range(3000)],
                               "hashtags array<string>, sentiment string").repartition(8)
    v = graph.vertices(df)
    p = plan_of(v)
    assert "partial_count" in p and p.index("partial_count") > p.index("Exchange")  # partial sits below
    assert {r["id"]: r["degree"] for r in v.where("id = 'hot'").collect()} == {"hot": 3000}


def test_hot_post_is_spread_over_tasks(spark):
    from pyspark.sql import functions as F
    from tagweave.operators.graph import _block_pairs
    one = spark.createDataFrame([([f"w{i:04d}" for i in range(3000)],)], "hashtags array<string>")
    pairs = _block_pairs(one, block=100, partitions=8)
    parts = pairs.select(F.spark_partition_id().alias("p")).distinct().count()
    assert parts >= 6                       # 30 blocks of one post land in most of the 8 tasks
    assert pairs.count() == 3000 * 2999 // 2


def test_token_spans_do_not_shuffle(spark):
    from tagweave.operators.tokens import token_spans
    from tagweave.sources.fixtures import read_table
    assert "Exchange" not in plan_of(token_spans(read_table(spark, SF_SMALL, "documents"), "doc_id", "text"))
