"""Connected components of a link table, by alternating stars, with Spark joins only."""

from __future__ import annotations

from pyspark.sql import DataFrame
from pyspark.sql import functions as F

from .common import discard, materialize


def connected_components(links: DataFrame, name: str = "components") -> DataFrame:
    """``(node, component)`` for every node of ``links(a, b)``; the component is its smallest node.

    Every round hangs each node's larger neighbours on its smallest neighbour,
    then each node and its smaller neighbours on the smallest of them; the link
    table stays linear in size and the rounds logarithmic in the longest path.
    Only a count and a checksum reach the driver. Each round is written
    to the shared scratch folder, which cuts lineage. A hub's links
    are reduced by ``min`` with map-side combine and joined by a plain equi-join
    against a written table, which adaptive execution splits.
    """
    edges = materialize(_canonical(links.select(F.col("a").alias("u"), F.col("b").alias("v"))), name)
    state = None
    while True:
        both = edges.unionByName(edges.select(F.col("v").alias("u"), F.col("u").alias("v")))
        least = materialize(both.groupBy("u").agg(F.least(F.min("v"), F.first("u")).alias("m")), name)
        large = materialize(_canonical(both.where("v > u").join(least, "u").select(
            F.col("v").alias("u"), F.col("m").alias("v"))), name)
        discard(edges, least)
        least = materialize(large.groupBy("u").agg(F.min("v").alias("m")), name)
        small = large.join(least, "u").select(F.col("v").alias("u"), F.col("m").alias("v")).unionByName(
            least.select("u", F.col("m").alias("v")))
        edges = materialize(_canonical(small), name)
        discard(large, least)
        now = edges.agg(F.count(F.lit(1)), F.sum(F.xxhash64("u", "v").cast("decimal(38,0)"))).first()
        if now == state:
            break
        state = now
    roots = edges.select(F.col("v").alias("node"), F.col("v").alias("component")).distinct()
    out = materialize(edges.select(F.col("u").alias("node"), F.col("v").alias("component")).unionByName(roots), name)
    discard(edges)
    return out


def _canonical(edges: DataFrame) -> DataFrame:
    """Distinct links from the larger to the smaller node, without loops."""
    return edges.where("u <> v").select(F.greatest("u", "v").alias("u"), F.least("u", "v").alias("v")).distinct()
