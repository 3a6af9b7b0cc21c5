"""Dashboard data as DataFrames: top-N vertices, top-N subgraph, splits.

The top-N set holds at most ``top_n`` rows: up to ``BROADCAST_TOP_N`` its ids are
broadcast to the edge semi-joins, a larger set is joined without a hint.
"""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..functions.labels import EDGE_COLOR, edge_width, node_size, sentiment_color
from ..functions.text import display_label

DEFAULT_TOP_N = 20
# Ids of the top-N set that may be broadcast.
BROADCAST_TOP_N = 10_000


def _check_n(top_n: int) -> int:
    n = int(top_n)
    if n <= 0:
        raise ValueError("top_n must be positive")
    return n


def top_vertices(v: DataFrame, top_n: int = DEFAULT_TOP_N) -> DataFrame:
    """The ``top_n`` vertices by degree, ties by id (a total order).

    Plans as ``TakeOrderedAndProject``: a per-partition top-n, then a merge of
    ``top_n`` rows per partition.
    """
    return v.orderBy(F.desc("degree"), F.asc("id")).limit(_check_n(top_n))


def top_subgraph_nodes(v: DataFrame, e: DataFrame, top_n: int = DEFAULT_TOP_N) -> DataFrame:
    """Nodes of the top-N subgraph: ``id, label, degree, sentiment, color, size``.

    Empty when the edge set is empty (an uncorrelated EXISTS, evaluated once). ``e``: the edges, or any table that is empty
    when they are, such as :func:`posts_with_pairs`, which makes no edge for it.
    """
    top = top_vertices(v, top_n)
    return (top.where(e.exists())
            .select("id", display_label("id").alias("label"), "degree",
                    F.col("dominant_sentiment").alias("sentiment"),
                    sentiment_color("dominant_sentiment").alias("color"),
                    node_size("degree").alias("size")))


def top_subgraph_edges(v: DataFrame, e: DataFrame, top_n: int = DEFAULT_TOP_N) -> DataFrame:
    """Edges with both ends in the top-N set: ``source, target, weight, width, color``."""
    ids = top_vertices(v, top_n).select(F.col("id").alias("_id"))
    if _check_n(top_n) <= BROADCAST_TOP_N:
        ids = F.broadcast(ids)
    kept = (e.join(ids, F.col("src") == F.col("_id"), "left_semi")
            .join(ids, F.col("dst") == F.col("_id"), "left_semi"))
    return kept.select(F.col("src").alias("source"), F.col("dst").alias("target"), "weight",
                       edge_width("weight").alias("width"), F.lit(EDGE_COLOR).alias("color"))


def posts_with_pairs(posts: DataFrame) -> DataFrame:
    """Posts with two tags or more; there is an edge if there is such a post."""
    return posts.where(F.size("hashtags") > 1)


def posts_in_top(posts: DataFrame, v: DataFrame, top_n: int = DEFAULT_TOP_N) -> DataFrame:
    """Posts with their tags cut down to the top-N set, before any pair is made.

    Edges of these posts are the edges with both ends in the set. The ids, ``top_n`` strings, are
    one scalar subquery; posts with fewer than two such tags go.
    """
    ids = top_vertices(v, top_n).agg(F.collect_list("id")).scalar()
    kept = posts.withColumn("_top", ids).withColumn(
        "hashtags", F.filter("hashtags", lambda t: F.array_contains("_top", t))).drop("_top")
    return kept.where(F.size("hashtags") > 1)


# The settings of the dashboard's slider.
SLIDER = tuple(range(5, 51, 5))


def ranked_vertices(v: DataFrame, max_n: int = SLIDER[-1]) -> DataFrame:
    """The ``max_n`` top vertices with their ``rank`` from 1: those with ``rank <= n`` are the top n, for every n up to ``max_n``."""
    best = top_vertices(v, max_n).agg(F.array_sort(F.collect_list(F.struct(-F.col("degree"), "id", "dominant_sentiment"))).alias("_top"))
    return best.select(F.posexplode("_top").alias("_at", "_v")).select(
        (F.col("_at") + 1).alias("rank"), F.col("_v.id").alias("id"), (-F.col("_v.col1")).alias("degree"),
        F.col("_v.dominant_sentiment").alias("dominant_sentiment"))


def slider_index(v: DataFrame, e: DataFrame, max_n: int = SLIDER[-1]) -> tuple[DataFrame, DataFrame]:
    """Nodes and edges of every top-n subgraph up to ``max_n``, each with the ``rank`` from which on it is in.

    A node enters at its own rank, an edge at the larger one of its ends', so one table answers every position of
    the slider by ``rank <= n``. ``e`` may be the edges of ``posts_in_top(posts, v, max_n)``: no other edge can be in.
    """
    top = ranked_vertices(v, _check_n(max_n))
    ends = top.select(F.col("id").alias("_id"), F.col("rank").alias("_rank"))
    if max_n <= BROADCAST_TOP_N:
        ends = F.broadcast(ends)
    edges = (e.join(ends.select(F.col("_id").alias("_s"), F.col("_rank").alias("_rs")), F.col("src") == F.col("_s"))
             .join(ends.select(F.col("_id").alias("_d"), F.col("_rank").alias("_rd")), F.col("dst") == F.col("_d")))
    return (top.select("rank", "id", display_label("id").alias("label"), "degree", F.col("dominant_sentiment").alias("sentiment"),
                       sentiment_color("dominant_sentiment").alias("color"), node_size("degree").alias("size")),
            edges.select(F.greatest("_rs", "_rd").alias("rank"), F.col("src").alias("source"), F.col("dst").alias("target"), "weight",
                         edge_width("weight").alias("width"), F.lit(EDGE_COLOR).alias("color")))


def at_slider(index: DataFrame, settings: tuple[int, ...] = SLIDER) -> DataFrame:
    """The rows of a slider index for each setting, with the column ``top_n``."""
    return (index.select(F.explode(F.array(*[F.lit(int(n)) for n in settings])).alias("top_n"), "*")
            .where(F.col("rank") <= F.col("top_n")).drop("rank"))


def top_subgraph(v: DataFrame, e: DataFrame, top_n: int = DEFAULT_TOP_N) -> tuple[DataFrame, DataFrame]:
    return top_subgraph_nodes(v, e, top_n), top_subgraph_edges(v, e, top_n)


def subgraph_elements(v: DataFrame, e: DataFrame, top_n: int = DEFAULT_TOP_N) -> tuple[DataFrame, DataFrame]:
    """The same subgraph as nested ``data`` / ``style`` structs, one row per element."""
    nodes = top_subgraph_nodes(v, e, top_n).select(
        F.struct(F.col("id"), F.col("label"), F.col("degree"), F.col("sentiment")).alias("data"),
        F.struct(F.col("color").alias("background-color"), F.col("size").alias("width"),
                 F.col("size").alias("height"), F.col("label")).alias("style"))
    edges = top_subgraph_edges(v, e, top_n).select(
        F.struct("source", "target", "weight").alias("data"),
        F.struct(F.col("width"), F.col("color").alias("line-color")).alias("style"))
    return nodes, edges


def top_bar(v: DataFrame, top_n: int = DEFAULT_TOP_N) -> DataFrame:
    """Bar-chart rows: ``degree, label, color, text`` of the top-N vertices."""
    return top_vertices(v, top_n).select(
        "degree", display_label("id").alias("label"),
        sentiment_color("dominant_sentiment").alias("color"),
        F.col("dominant_sentiment").alias("text"))


def vertex_sentiment_split(v: DataFrame) -> DataFrame:
    """``(dominant_sentiment, count)``: vertices per dominant sentiment, largest first."""
    return (v.groupBy("dominant_sentiment").agg(F.count(F.lit(1)).alias("count"))
            .orderBy(F.desc("count"), F.asc("dominant_sentiment")))
