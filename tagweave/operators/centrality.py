"""Degree centrality and PageRank over the co-occurrence graph.

The graph is read as undirected (``src <= dst`` is only a canonical order)
and self-loops are left out of both measures.
"""

from __future__ import annotations

import uuid

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from ..session import discard, hadoop_path, scratch_path
from ..session import materialize as write_table


def _undirected(e: DataFrame) -> DataFrame:
    """Both directions of every non-loop edge: ``(id, nbr, weight)``; the edges are made once for both."""
    ways = F.array(F.struct(F.col("src").alias("id"), F.col("dst").alias("nbr")), F.struct(F.col("dst").alias("id"), F.col("src").alias("nbr")))
    return e.where(F.col("src") != F.col("dst")).select(F.explode(ways).alias("_way"), "weight").select("_way.id", "_way.nbr", "weight")


def degree_centrality(v: DataFrame, e: DataFrame) -> DataFrame:
    """``(id, neighbor_degree, weighted_degree, centrality)`` for every vertex.

    ``neighbor_degree`` counts distinct other tags, ``weighted_degree`` sums the
    weights of those edges, ``centrality = neighbor_degree / (|V| - 1)``.
    ``|V|`` is an uncorrelated scalar subquery (run once), not a window over
    all vertices. Tags without neighbours get 0.
    """
    agg = _undirected(e).groupBy("id").agg(
        F.count(F.lit(1)).alias("neighbor_degree"),
        F.sum("weight").cast("long").alias("weighted_degree"))
    n_vertices = v.select(F.count(F.lit(1))).scalar()
    out = v.select("id").join(agg, "id", "left").select(
        "id",
        F.coalesce("neighbor_degree", F.lit(0)).cast("long").alias("neighbor_degree"),
        F.coalesce("weighted_degree", F.lit(0)).cast("long").alias("weighted_degree"))
    return out.withColumn(
        "centrality",
        F.coalesce(F.try_divide(F.col("neighbor_degree").cast("double"), (n_vertices - 1).cast("double")), F.lit(0.0)))


# A rank-share row is (long key, double share); broadcast the share vector
# only while its proven size (vertex count x row bytes) stays under this.
SHARE_ROW_BYTES = 24
SHARE_BROADCAST_BYTES = 64 << 20
# Neighbours in one row of the blocked adjacency (a hub has several rows, spread by hash), and neighbours in one block, about.
HUB_NEIGHBOURS = 1 << 16
BLOCK_NEIGHBOURS = 1 << 24
MAX_BLOCKS = 20_000


def _vertex_key_stats(v: DataFrame) -> tuple[int, bool]:
    """Vertex count, and whether ``xxhash64`` is collision-free over the ids (one small job)."""
    row = v.agg(F.count(F.lit(1)).alias("n"), F.count_distinct(F.xxhash64("id")).alias("h")).first()
    return row["n"], row["n"] == row["h"]


class NotConverged(RuntimeError):
    """A tolerance run used up its iterations; ``ranks`` holds the last vector, ``moved`` its largest step."""

    def __init__(self, ranks: DataFrame, moved: float, iterations: int):
        super().__init__(f"ranks still move by {moved} after {iterations} iterations")
        self.ranks, self.moved = ranks, moved


class _Edges:
    """Edges ``(src, dst)`` as one written table, each once; shares reach both of its ends by broadcast."""

    def __init__(self, adj: DataFrame):
        self.adj = adj

    def messages(self, ranks: DataFrame) -> DataFrame:
        share = ranks.select(F.col("_k").alias("_u"), (F.col("rank") / F.col("_deg")).alias("_c"))
        s, d = F.broadcast(share.alias("_s")), F.broadcast(share.alias("_d"))
        ways = F.array(F.struct(F.col("dst").alias("_k"), F.col("_s._c").alias("_c")), F.struct(F.col("src").alias("_k"), F.col("_d._c").alias("_c")))
        return (self.adj.join(s, F.col("src") == F.col("_s._u")).join(d, F.col("dst") == F.col("_d._u"))
                .select(F.explode(ways).alias("_m")).select("_m._k", "_m._c"))

    def drop(self) -> None:
        discard(self.adj)


class _Blocks:
    """Adjacency partitioned once into blocks: rows ``(src, part, dsts)``, bucketed and sorted by ``(src, part)``.

    A vertex with more than ``HUB_NEIGHBOURS`` neighbours has several rows in different blocks, so no block holds all of a hub. The
    shares, one row for each of these rows, are shuffled to the blocks; the adjacency stays where it is.
    """

    def __init__(self, adj: DataFrame, degrees: DataFrame):
        spark = adj.sparkSession
        n = degrees.agg(F.sum("_deg")).first()[0] or 0
        blocks = max(1, min(n // BLOCK_NEIGHBOURS + 1, MAX_BLOCKS))
        hubs = degrees.where(F.col("_deg") > HUB_NEIGHBOURS).select(F.col("_k").alias("_h"), "_deg")
        part = F.coalesce(F.pmod(F.xxhash64("dst"), self._parts(F.col("_deg"))), F.lit(0)).cast("int")
        rows = (adj.join(hubs, F.col("src") == F.col("_h"), "left").select("src", part.alias("part"), "dst")
                .repartition(blocks, "src", "part").groupBy("src", "part").agg(F.collect_list("dst").alias("dsts")))
        self.spark, self.name, self.path = spark, f"tagweave_adjacency_{uuid.uuid4().hex}", scratch_path(spark, "pagerank-blocks")
        rows.write.bucketBy(blocks, "src", "part").sortBy("src", "part").option("path", self.path).saveAsTable(self.name)

    @staticmethod
    def _parts(degree):
        return F.ceil(degree / F.lit(HUB_NEIGHBOURS))

    def messages(self, ranks: DataFrame) -> DataFrame:
        parts = F.explode(F.sequence(F.lit(0), (self._parts(F.col("_deg")) - 1).cast("int")))
        share = ranks.select(F.col("_k").alias("src"), parts.alias("part"), (F.col("rank") / F.col("_deg")).alias("_c"))
        return self.spark.table(self.name).join(share, ["src", "part"]).select(F.explode("dsts").alias("_k"), "_c")

    def drop(self) -> None:
        self.spark.sql(f"DROP TABLE IF EXISTS {self.name}")
        path = hadoop_path(self.spark, self.path)
        path.getFileSystem(self.spark._jsc.hadoopConfiguration()).delete(path, True)


def pagerank(v: DataFrame, e: DataFrame, max_iter: int | None = None, tol: float | None = 0.01,
             reset: float = 0.15, plan: str = "auto") -> DataFrame:
    """``(id, rank)``: PageRank with reset probability ``reset``.

    Ranks start at 1.0 and follow ``rank(v) = reset + (1 - reset) * sum(rank(u) / deg(u))``
    over neighbours u (unweighted, undirected, no self-loops); a vertex
    without neighbours settles at ``reset`` after the first iteration. Edge
    ends must be vertices. With ``tol`` it runs until no rank moves more than
    ``tol`` (one scalar action per iteration; the ranks converge geometrically, by ``1 - reset`` an iteration); a
    ``max_iter`` that is used up before raises :class:`NotConverged`. With ``tol=None`` it runs exactly ``max_iter`` iterations.

    Plan: vertices are keyed by ``xxhash64(id)`` when one
    small job shows the hashes collision-free (else by the string id), so
    the loop joins and sums fixed-width keys. The adjacency is written once, and the loop runs over vertices with neighbours
    only (each of them receives a contribution every iteration). The rank vector ``(key, rank, degree)`` is written every iteration,
    with the rank before beside it: the degrees and the old ranks go through the same aggregate as the messages, so an iteration
    is one join and one aggregate, and the largest step is read off the written table. The vector is
    broadcast to the adjacency while the vertex count proves it under ``SHARE_BROADCAST_BYTES`` (``plan="broadcast"``).
    Beyond that (``"blocks"``) the adjacency lies in blocks by source, hubs split over several, and only the vector is shuffled to it. Messages
    are summed by task before their shuffle, so a vertex that many point to is one row a task. ``plan="lazy"`` makes one lazy plan on string keys.
    """
    if tol is None and max_iter is None:
        raise ValueError("pagerank needs max_iter or tol")
    if plan not in ("auto", "broadcast", "blocks", "lazy"):
        raise ValueError(f"Unknown plan: {plan}")
    if plan == "lazy":
        return _lazy_pagerank(v, e, max_iter, tol, reset)
    n_vertices, unique = _vertex_key_stats(v)
    key = (lambda c: F.xxhash64(c)) if unique else (lambda c: F.col(c))
    if plan == "auto":
        plan = "broadcast" if unique and n_vertices * SHARE_ROW_BYTES <= SHARE_BROADCAST_BYTES else "blocks"
    adj = write_table(e.where(F.col("src") != F.col("dst")).select(key("src").alias("src"), key("dst").alias("dst")), "pagerank-adjacency")
    ways = adj.select(F.explode(F.array(F.struct("src", "dst"), F.struct(F.col("dst").alias("src"), F.col("src").alias("dst")))).alias("_way")).select("_way.*")
    ranks = write_table(ways.groupBy(F.col("src").alias("_k")).agg(F.count(F.lit(1)).alias("_deg"))
                        .select("_k", F.lit(1.0).alias("rank"), "_deg", F.lit(1.0).alias("_old")), "pagerank-ranks")
    if plan == "blocks":
        graph = _Blocks(ways, ranks)
        discard(adj)
    else:
        graph = _Edges(adj)
    done, moved = 0, None
    while max_iter is None or done < int(max_iter):
        carried = ranks.select("_k", F.lit(0.0).alias("_c"), "_deg", F.col("rank").alias("_old"))
        new = write_table(
            graph.messages(ranks).unionByName(carried, allowMissingColumns=True).groupBy("_k").agg(
                (F.lit(reset) + F.lit(1.0 - reset) * F.sum("_c")).alias("rank"), F.max("_deg").alias("_deg"), F.max("_old").alias("_old")),
            "pagerank-ranks")
        discard(ranks)
        ranks, done = new, done + 1
        if tol is not None:
            moved = ranks.agg(F.max(F.abs(F.col("rank") - F.col("_old")))).first()[0] or 0.0
            if moved < tol:
                break
    graph.drop()
    lone = F.lit(reset if done > 0 else 1.0)
    out = (v.select("id", key("id").alias("_k")).join(ranks, "_k", "left")
           .select("id", F.coalesce(F.col("rank"), lone).alias("rank")))
    if moved is not None and moved >= tol:
        raise NotConverged(out, moved, done)
    return out


def _lazy_pagerank(v: DataFrame, e: DataFrame, max_iter: int | None, tol: float | None, reset: float) -> DataFrame:
    """A fixed number of iterations as one plan, nothing written."""
    if tol is not None or max_iter is None:
        raise ValueError("the lazy plan runs a fixed number of iterations: give max_iter and tol=None")
    adj = _undirected(e).select(F.col("id").alias("src"), F.col("nbr").alias("dst"))
    deg = adj.groupBy(F.col("src").alias("_k")).agg(F.count(F.lit(1)).alias("_deg"))
    ranks = deg.select("_k", F.lit(1.0).alias("rank"))
    for _ in range(int(max_iter)):
        share = ranks.join(deg, "_k").select(F.col("_k").alias("_u"), (F.col("rank") / F.col("_deg")).alias("_c"))
        ranks = (adj.join(share, F.col("src") == F.col("_u")).groupBy(F.col("dst").alias("_k"))
                 .agg((F.lit(reset) + F.lit(1.0 - reset) * F.sum("_c")).alias("rank")))
    lone = F.lit(reset if max_iter > 0 else 1.0)
    return (v.select("id", F.col("id").alias("_k")).join(ranks, "_k", "left")
            .select("id", F.coalesce(F.col("rank"), lone).alias("rank")))
