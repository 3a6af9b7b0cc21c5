"""The batch job: posts in, graph out.

1. load and normalise posts, attach sentiment;
2. write the slim post table ``(sentiment, hashtags, has_hashtags)`` to the
   shared checkpoint directory -- the raw text is scanned and parsed once and
   the lineage is cut there; the row counts are observed while it is written, the sentiment split comes
   from the slim table. On demand, malformed records go to a table of their own;
3. write vertices and edges, complete (Spark output directories);
4. optionally export an excerpt, the top-N subgraph, as JSON array documents.
"""

from __future__ import annotations

from dataclasses import dataclass

from pyspark.sql import DataFrame, Observation, SparkSession
from pyspark.sql import functions as F

from ..operators.graph import edges as edges_of
from ..operators.graph import vertices as vertices_of
from ..operators.sentiment import sentiment_distribution, with_sentiment
from ..session import scratch_path
from ..sinks.graph import export_top_json, write_graph
from ..sources.posts import load_posts, load_posts_and_rejects


@dataclass
class BatchResult:
    vertices_path: str  # the complete graph
    edges_path: str
    tagged_path: str  # scratch: delete it when no longer needed
    top_json: tuple[str, str] | None  # the top-N excerpt
    sentiment: DataFrame
    counts: dict
    rejects_path: str | None = None  # malformed records, if asked for


def tagged_posts(posts: DataFrame) -> DataFrame:
    """The slice of scored posts the graph needs: posts with at least one tag.

    The tags pass through a generator of one row, which the optimizer does not push the filter
    through: the tag regex runs once per row.
    """
    return (posts.select("sentiment", F.explode_outer(F.array("hashtags")).alias("hashtags"))
            .where(F.size("hashtags") > 0))


def run_batch(spark: SparkSession, data_path: str, data_format: str, out_dir: str, *,
              sample_fraction: float | None = None, max_rows: int | None = None,
              sentiment_mode: str = "label", model=None, out_format: str = "parquet",
              top_n: int | None = 20, keep_rejects: bool = False, **load_options) -> BatchResult:
    """Run the job; a malformed record fails it, unless ``keep_rejects`` writes those to ``<out_dir>/rejects``."""
    load, rejects_path = load_posts, None
    if keep_rejects:
        load, rejects_path = load_posts_and_rejects, f"{out_dir.rstrip('/')}/rejects"
    posts = load(spark, data_path, data_format, sample_fraction=sample_fraction,
                 max_rows=max_rows, **load_options)
    if keep_rejects:
        posts, rejects = posts
        rejects.write.mode("overwrite").parquet(rejects_path)
    scored = with_sentiment(posts, sentiment_mode, model)
    # every post as a slim row; posts without tags are a few bytes and count too
    tagged_path, counts = scratch_path(spark, "tagged-posts"), Observation("batch-counts")
    (scored.select("sentiment", "hashtags", "has_hashtags")
     .observe(counts, F.count(F.lit(1)).alias("posts"),
              F.coalesce(F.sum(F.col("has_hashtags").cast("long")), F.lit(0)).alias("posts_with_hash"),
              F.coalesce(F.sum((F.size("hashtags") > 0).cast("long")), F.lit(0)).alias("posts_with_tags"))
     .write.mode("overwrite").parquet(tagged_path))
    tagged = spark.read.parquet(tagged_path)
    v, e = vertices_of(tagged), edges_of(tagged, keys="auto")
    vpath, epath = write_graph(v, e, out_dir, out_format)
    top = None
    if top_n:
        sv, se = spark.read.format(out_format).load(vpath), spark.read.format(out_format).load(epath)
        top = export_top_json(sv, se, out_dir, top_n)
    return BatchResult(vpath, epath, tagged_path, top, sentiment_distribution(tagged), dict(counts.get), rejects_path)
