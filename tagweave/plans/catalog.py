"""Registered queries: name -> (spark, sf_dir) -> DataFrame.

Every query reads the driver's tables (through the fixture views of
``tagweave.sources.fixtures``) and runs over whole tables and whole texts.
Array results are emitted as joined strings and instants as epoch seconds,
so the DuckDB twins in ``tagweave.plans.oracle`` hash to the same values
whatever the session time zone.
"""

from __future__ import annotations

from collections.abc import Callable

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.dates import strip_zone
from ..functions.labels import label_to_sentiment, sentiment_from_text
from ..functions.text import distinct_hashtags, has_hash, hashtags, shrink, tokens
from ..operators import centrality, graph, sentiment, views, weights
from ..operators.model import train_sentiment_model
from ..operators.tokens import finish, token_spans
from ..session import materialize, scratch_path
from .batch import run_batch, tagged_posts
from ..schema import EDGE, STREAM_OUT, VERTEX
from ..sinks.graph import export_graph_json, read_json_document, write_chunks, write_graph
from ..sources.fixtures import raw_view, read_table, scored_view
from ..sources.graph_files import read_graph
from ..sources.posts import hash_sample, load_posts, load_posts_and_rejects, normalize_posts, posts_with_hashtags
from ..streaming.files import start_stream
from ..streaming.live_graph import compact, live_edges, live_vertices, start_graph_stream
from ..streaming.wire import to_wire

Query = Callable[[SparkSession, str], DataFrame]

TOP_N = 20
SAMPLE_FRACTION = 0.1
MAX_ROWS = 100
PAGERANK_ITERATIONS = 5


def _epoch(c) -> F.Column:
    return F.unix_timestamp(c).cast("long")


def _tagged(spark, sf_dir, view):
    """The slim tagged-post table of a view, written once to the shared checkpoint dir.

    As in the batch job: the text is parsed once, and every graph operator
    (vertices, both pair plans, the key check, the tag dictionary) reads the
    small ``(sentiment, hashtags)`` table instead of re-parsing.
    """
    return materialize(tagged_posts(scored_view(spark, sf_dir, view)), f"tagged-{view}")


def _graph(spark, sf_dir, view="posts", method="auto"):
    posts = _tagged(spark, sf_dir, view)
    return graph.vertices(posts), graph.edges(posts, method, keys="auto")


# --- loading and scalar functions -------------------------------------------

def _loaded(p):
    return p.select("id", "text", F.array_join("hashtags", " ").alias("hashtags"),
                    _epoch("created_at").alias("created_at_epoch"),
                    "original_sentiment", "has_hashtags")


def q_load_normalized(spark, sf_dir):
    return _loaded(normalize_posts(raw_view(spark, sf_dir, "posts")))


def _csv_lines(raw, *more, fields=None):
    """Headerless CSV lines of raw posts, every field quoted; ``fields``: how many of them."""
    quoted = [F.concat(F.lit('"'), F.replace(F.coalesce(F.col(c).cast("string"), F.lit("")), F.lit('"'), F.lit('""')), F.lit('"'))
              for c in ("sentiment_label", "id", "date", "query", "user", "text")]
    if fields is not None:
        quoted = [F.slice(F.array(*quoted), F.lit(1), fields)]
    return raw.select(F.concat_ws(",", *quoted, *more).alias("value"))


def _lined(spark, sf_dir):
    """The posts view with a line end in place of every blank of a text."""
    return raw_view(spark, sf_dir, "posts").withColumn("text", F.replace("text", F.lit(" "), F.lit("\n")))


def q_load_csv(spark, sf_dir):
    """CSV whose texts hold line ends, through the loader."""
    path = scratch_path(spark, "posts-csv")
    _csv_lines(_lined(spark, sf_dir)).write.text(path)
    return _loaded(load_posts(spark, path, "csv"))


def q_load_csv_latin1(spark, sf_dir):
    """CSV in ISO-8859-1, split at line ends; every text with a letter beyond ASCII."""
    path = scratch_path(spark, "posts-latin1")
    raw = raw_view(spark, sf_dir, "posts").withColumn("text", F.concat(F.lit("café #é "), "text"))
    (raw.select("sentiment_label", "id", "date", "query", "user", "text").write
     .option("encoding", "ISO-8859-1").option("quoteAll", "true").option("escape", '"').csv(path))
    return _loaded(load_posts(spark, path, "csv", encoding="ISO-8859-1", multiline=False))


def q_load_dropmalformed(spark, sf_dir):
    """Posts without a label get a seventh field in the file; the loader skips these records."""
    path = scratch_path(spark, "posts-malformed")
    _csv_lines(raw_view(spark, sf_dir, "posts"), F.when(F.col("sentiment_label") == 2, "more")).write.text(path)
    return _loaded(load_posts(spark, path, "csv", mode="DROPMALFORMED"))


def q_load_rejects(spark, sf_dir):
    """Every record of a CSV with line ends in its texts: labels 4 have five fields, other ones but 0 seven."""
    path = scratch_path(spark, "posts-rejects")
    label = F.col("sentiment_label")
    (_csv_lines(_lined(spark, sf_dir), F.when(label == 2, '"more"'), fields=F.when(label == 4, 5).otherwise(6)).write.text(path))
    posts, rejects = load_posts_and_rejects(spark, path, "csv")
    return posts.select(F.lit("post").alias("kind"), "id", "text").unionByName(
        rejects.select(F.col("reason").alias("kind"), F.lit(None).cast("string").alias("id"), F.col("record").alias("text")))


def q_load_json(spark, sf_dir):
    path = scratch_path(spark, "posts-json")
    _lined(spark, sf_dir).write.json(path)
    return _loaded(load_posts(spark, path, "json"))


def q_load_sampled(spark, sf_dir):
    """Hash sample and row cap through the loader."""
    path = scratch_path(spark, "posts-parquet")
    raw_view(spark, sf_dir, "posts").write.parquet(path)
    return load_posts(spark, path, "parquet", sample_fraction=0.999, sample_method="hash", max_rows=MAX_ROWS).select("id")


def q_hash_sample_edges(spark, sf_dir):
    """Sizes of hash samples up to the edge where every row is kept."""
    raw = raw_view(spark, sf_dir, "posts").select("id")
    sizes = [hash_sample(raw, f).agg(F.count(F.lit(1)).alias("n")).select(F.lit(str(f)).alias("fraction"), "n")
             for f in (0.1, 0.999, 1 - 1e-10)]
    return sizes[0].unionByName(sizes[1]).unionByName(sizes[2])


def q_label_by_value(spark, sf_dir):
    """Labels as whole numbers, fractions, text and null: quantities and discounts of all lines."""
    lines = read_table(spark, sf_dir, "lineitem")
    q, d = F.col("l_quantity"), F.col("l_discount")
    return lines.select("l_orderkey", "l_linenumber", label_to_sentiment(q).alias("by_quantity"),
                        label_to_sentiment(d * 100).alias("by_discount"),
                        label_to_sentiment(F.concat(q.cast("int").cast("string"), F.lit(".0"))).alias("by_text"),
                        label_to_sentiment(F.when(q > 25, "junk")).alias("by_junk"))


def q_posts_with_hashtags(spark, sf_dir):
    """F1 on whole documents: texts with a '#', tags or not."""
    d = read_table(spark, sf_dir, "documents").select(F.col("doc_id").alias("id"), "text")
    return posts_with_hashtags(normalize_posts(d)).select("id", F.size("hashtags").alias("n_tags"))


def q_hash_sample(spark, sf_dir):
    return hash_sample(raw_view(spark, sf_dir, "posts"), SAMPLE_FRACTION).select("id")


def q_sample_bernoulli(spark, sf_dir):
    path = scratch_path(spark, "posts-parquet")
    raw_view(spark, sf_dir, "posts").write.parquet(path)
    return load_posts(spark, path, "parquet", sample_fraction=SAMPLE_FRACTION).select("id")


def q_limit_ordered(spark, sf_dir):
    return raw_view(spark, sf_dir, "posts").orderBy("id").limit(MAX_ROWS).select("id")


def q_hashtags_extract(spark, sf_dir):
    p = raw_view(spark, sf_dir, "posts")
    h = hashtags("text")
    return p.select("id", F.array_join(h, " ").alias("tags"), F.size(h).alias("n_tags"))


def q_hashtags_distinct(spark, sf_dir):
    p = raw_view(spark, sf_dir, "posts")
    return p.select("id", F.array_join(distinct_hashtags("text"), " ").alias("tags"))


def q_turn_hashtags(spark, sf_dir):
    p = raw_view(spark, sf_dir, "turn_posts")
    h = hashtags("text")
    return p.select("id", F.array_join(h, " ").alias("tags"), F.size(h).alias("n_tags"))


def q_created_at_parse(spark, sf_dir):
    p = normalize_posts(raw_view(spark, sf_dir, "posts"))
    return p.select("id", _epoch("created_at").alias("created_at_epoch"))


# Zones as they may stand in a date.
ZONES = ("UTC", "PST", "PDT", "EST", "EDT", "CET", "CEST", "JST", "-0330", "+05:45")


def q_created_at_zones(spark, sf_dir):
    """Dates whose zone goes round by id, daylight and standard ones in every season."""
    zone = F.get(F.array(*[F.lit(z) for z in ZONES]), (F.col("id").cast("long") % len(ZONES)).cast("int"))
    raw = raw_view(spark, sf_dir, "posts").withColumn("date", F.replace("date", F.lit("UTC"), zone))
    return normalize_posts(raw).select("id", _epoch("created_at").alias("created_at_epoch"))


def q_created_at_constant(spark, sf_dir):
    p = normalize_posts(raw_view(spark, sf_dir, "posts"), created_at_mode="constant")
    return p.select("id", _epoch("created_at").alias("created_at_epoch"))


def q_date_strip_zone(spark, sf_dir):
    return raw_view(spark, sf_dir, "posts").select("id", strip_zone("date").alias("created_at"))


def q_sentiment_label(spark, sf_dir):
    return scored_view(spark, sf_dir, "posts").select("id", "sentiment")


def q_sentiment_from_text(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    return d.select("doc_id", sentiment_from_text(F.lower("text")).alias("sentiment"))


def q_sentiment_distribution(spark, sf_dir):
    return sentiment.sentiment_distribution(scored_view(spark, sf_dir, "posts"))


def q_confusion_counts(spark, sf_dir):
    return sentiment.confusion_counts(scored_view(spark, sf_dir, "posts"))


def q_has_hashtags_vs_tags(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    return d.select("doc_id", has_hash("text").alias("has_hashtags"),
                    F.size(hashtags("text")).alias("n_tags"))


def q_pages_has_hashtags(spark, sf_dir):
    p = read_table(spark, sf_dir, "pages")
    return p.select("page_id", has_hash("html").alias("has_hashtags"),
                    F.size(hashtags("html")).alias("n_tags"))


def q_text_shrink(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    return d.select("doc_id", shrink("text").alias("text"))


def q_token_counts(spark, sf_dir):
    d = read_table(spark, sf_dir, "documents")
    return d.select("doc_id", F.size(tokens("text")).alias("n_tokens"))


# --- graph -----------------------------------------------------------------

def q_tag_counts(spark, sf_dir):
    return graph.tag_counts(scored_view(spark, sf_dir, "posts"))


def q_tag_sentiment_counts(spark, sf_dir):
    return graph.tag_sentiment_counts(scored_view(spark, sf_dir, "posts"))


def q_dominant_sentiment(spark, sf_dir):
    return graph.dominant_sentiment(scored_view(spark, sf_dir, "posts"))


def q_vertices(spark, sf_dir):
    return graph.vertices(scored_view(spark, sf_dir, "posts"))


def q_vertices_general(spark, sf_dir):
    return graph.vertices(scored_view(spark, sf_dir, "posts"), sentiments=None)


def q_pairs(spark, sf_dir):
    return graph.pair_occurrences(_tagged(spark, sf_dir, "posts"))


def q_edges(spark, sf_dir):
    return graph.edges(scored_view(spark, sf_dir, "posts"))


def q_edges_by_multiplicity(spark, sf_dir):
    return graph.edges(scored_view(spark, sf_dir, "posts"), method="blocks")


def q_graph_summary(spark, sf_dir):
    return graph.graph_summary(*_graph(spark, sf_dir, "posts"))


def _vertices(spark, sf_dir, view="posts"):
    return graph.vertices(scored_view(spark, sf_dir, view))


def q_top_vertices(spark, sf_dir):
    return views.top_vertices(_vertices(spark, sf_dir), TOP_N)


def q_top_subgraph_nodes(spark, sf_dir):
    posts = _tagged(spark, sf_dir, "posts")
    return views.top_subgraph_nodes(graph.vertices(posts), views.posts_with_pairs(posts), top_n=TOP_N)


def _slider(spark, sf_dir, view="posts"):
    """One index for all positions of the slider; tags are cut down to the largest set before pairs are made."""
    posts = _tagged(spark, sf_dir, view)
    v = materialize(graph.vertices(posts), "vertices")
    return views.slider_index(v, graph.edges(views.posts_in_top(posts, v, views.SLIDER[-1])))


def q_slider_nodes(spark, sf_dir):
    return views.at_slider(_slider(spark, sf_dir)[0])


def q_slider_edges(spark, sf_dir):
    return views.at_slider(_slider(spark, sf_dir)[1])


def q_turn_slider_edges(spark, sf_dir):
    return views.at_slider(_slider(spark, sf_dir, "turn_posts")[1])


def _top_edges(view):
    """Tags are cut down to the top-N before any pair is made."""
    def q(spark, sf_dir):
        posts = _tagged(spark, sf_dir, view)
        v = materialize(graph.vertices(posts), "vertices")
        return views.top_subgraph_edges(v, graph.edges(views.posts_in_top(posts, v, TOP_N)), top_n=TOP_N)
    return q


def q_top_bar(spark, sf_dir):
    return views.top_bar(_vertices(spark, sf_dir), TOP_N)


def q_vertex_sentiment_split(spark, sf_dir):
    return views.vertex_sentiment_split(_vertices(spark, sf_dir))


def _centrality(view):
    def q(spark, sf_dir):
        dc = centrality.degree_centrality(*_graph(spark, sf_dir, view))
        return dc.withColumn("centrality", F.round("centrality", 9))
    return q


def _pagerank(view):
    def q(spark, sf_dir):
        v, e = _graph(spark, sf_dir, view)
        pr = centrality.pagerank(v, e, max_iter=PAGERANK_ITERATIONS, tol=None)
        return pr.select("id", F.round("rank", 6).alias("rank"))
    return q


def q_turn_vertices(spark, sf_dir):
    return graph.vertices(_tagged(spark, sf_dir, "turn_posts"))


def q_turn_edges(spark, sf_dir):
    return graph.edges(_tagged(spark, sf_dir, "turn_posts"), keys="auto")


def q_turn_graph_summary(spark, sf_dir):
    return graph.graph_summary(*_graph(spark, sf_dir, "turn_posts"))


def q_graph_roundtrip_edges(spark, sf_dir):
    v, e = _graph(spark, sf_dir, "posts")
    out = scratch_path(spark, "graph")
    write_graph(v, e, out, "parquet")
    return read_graph(spark, out, "parquet")[1]


def q_graph_roundtrip_vertices(spark, sf_dir):
    """The complete graph as JSON directories, read back: its vertices."""
    v, e = _graph(spark, sf_dir, "posts")
    out = scratch_path(spark, "graph")
    write_graph(v, e, out, "json")
    return read_graph(spark, out, "json")[0].select("id", F.col("degree").cast("long").alias("degree"), "dominant_sentiment")


def _json_documents(spark, sf_dir):
    return export_graph_json(*_graph(spark, sf_dir, "posts"), scratch_path(spark, "graph-json"))


def q_graph_json_vertices(spark, sf_dir):
    """The complete graph as JSON array documents, read back: its vertices."""
    return read_json_document(spark, _json_documents(spark, sf_dir)[0], VERTEX)


def q_graph_json_edges(spark, sf_dir):
    return read_json_document(spark, _json_documents(spark, sf_dir)[1], EDGE)


def q_chunk_sequence(spark, sf_dir):
    """Posts by id in numbered files of 1,000: what each file holds."""
    out = write_chunks(raw_view(spark, sf_dir, "posts").select("id", "text"), scratch_path(spark, "chunks"), chunk_size=1000, order_by=("id",))
    rows = spark.read.schema("id string").json(out).withColumn("chunk", F.regexp_extract(F.input_file_name(), r"chunk-(\d+)", 1).cast("int"))
    return rows.groupBy("chunk").agg(F.count(F.lit(1)).alias("n"), F.min("id").alias("first_id"), F.max("id").alias("last_id"))


def _batch_job(spark, sf_dir):
    """The batch job on one CSV input."""
    path = scratch_path(spark, "batch-csv")
    _csv_lines(_lined(spark, sf_dir)).write.text(path)
    return run_batch(spark, path, "csv", scratch_path(spark, "batch-graph"))


def q_batch_counts(spark, sf_dir):
    counts = _batch_job(spark, sf_dir).counts
    return spark.createDataFrame([tuple(counts.values())], ", ".join(f"{c} long" for c in counts))


def q_batch_edges(spark, sf_dir):
    return spark.read.parquet(_batch_job(spark, sf_dir).edges_path)


def q_pagerank_tol(spark, sf_dir):
    """Run until no rank moves by 1e-9, with the adjacency in blocks."""
    v, e = _graph(spark, sf_dir, "posts")
    return centrality.pagerank(v, e, tol=1e-9, plan="blocks").select("id", F.round("rank", 6).alias("rank"))


def q_finisher(spark, sf_dir):
    """Token annotations of whole documents joined to one string, and its sentiment reading (N4, P13)."""
    spans = F.transform(tokens("text"), lambda t: F.struct(t.alias("result")))
    d = read_table(spark, sf_dir, "documents").select("doc_id", finish(spans).alias("finished"))
    return d.withColumn("sentiment", sentiment_from_text("finished"))


def q_model_invariants(spark, sf_dir):
    """The model chain checked by what must hold: rows kept, labels in their domain, sub-threshold rows neutral, one answer after save and load."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select(
        "doc_id", F.when(F.col("quality") == 1, "positive").otherwise("negative").alias("sentiment"))
    model = train_sentiment_model(docs.join(labels, "doc_id"))
    path = scratch_path(spark, "model")
    model.save(path)
    again = type(model).load(path)
    strict = type(model).load(path, threshold=1.1)  # no probability reaches it
    out = (model.transform(docs).join(again.transform(docs).select("doc_id", F.col("sentiment").alias("again")), "doc_id")
           .join(strict.transform(docs).select("doc_id", F.col("sentiment").alias("strict")), "doc_id"))
    return out.agg(F.count(F.lit(1)).alias("n"), F.count_if(F.col("sentiment").isin("positive", "negative", "neutral")).alias("in_domain"),
                   F.count_if(F.col("sentiment") == F.col("again")).alias("same_after_load"),
                   F.count_if(F.col("strict") == "neutral").alias("neutral_below_threshold"))


def _spread(df):
    """Rows dealt over the cores when the table has fewer files: a small file is one task, whatever its rows cost."""
    cores = df.sparkSession.sparkContext.defaultParallelism
    return df.repartition(cores) if len(df.inputFiles()) < cores else df


def q_token_spans(spark, sf_dir):
    return token_spans(_spread(read_table(spark, sf_dir, "documents").select("doc_id", "text")), "doc_id", "text")


def q_sentiment_model(spark, sf_dir):
    """Train on labelled documents (quality 0/1 as negative/positive), score all of them."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select(
        "doc_id", F.when(F.col("quality") == 1, "positive").otherwise("negative").alias("sentiment"))
    model = train_sentiment_model(docs.join(labels, "doc_id"))
    return model.transform(docs).select("doc_id", "sentiment")


def _labelled_documents(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select(
        "doc_id", F.when(F.col("quality") == 1, "positive").otherwise("negative").alias("label"))
    return docs.join(labels, "doc_id")


def _document_weights(spark, sf_dir):
    """Token weights from the labelled documents that are not held out."""
    known = _labelled_documents(spark, sf_dir).where(~weights.held_out("doc_id"))
    return materialize(weights.fit_token_weights(known, "doc_id", label_col="label"), "token-weights")


def q_token_weights(spark, sf_dir):
    return _document_weights(spark, sf_dir).select("token", F.col("class").alias("label"), F.round("weight", 6).alias("weight"))


def q_weights_sentiment(spark, sf_dir):
    docs = read_table(spark, sf_dir, "documents")
    out = weights.score_by_weights(docs, _document_weights(spark, sf_dir), "doc_id")
    return out.select("doc_id", "sentiment", F.round("confidence", 6).alias("confidence"))


def _held_out_scores(spark, sf_dir):
    kept = _labelled_documents(spark, sf_dir).where(weights.held_out("doc_id"))
    return weights.score_by_weights(kept, _document_weights(spark, sf_dir), "doc_id").join(kept.select("doc_id", "label"), "doc_id")


def q_heldout_confusion(spark, sf_dir):
    """Labels against predictions on documents that the weights were not fitted on."""
    return sentiment.confusion_counts(_held_out_scores(spark, sf_dir).withColumnRenamed("label", "original_sentiment"))


def q_heldout_calibration(spark, sf_dir):
    out = weights.calibration(_held_out_scores(spark, sf_dir), "label")
    return out.withColumn("confidence", F.round("confidence", 6))


def q_model_confusion(spark, sf_dir):
    """Agreement of labels and model predictions on the labelled documents."""
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text")
    labels = read_table(spark, sf_dir, "labels").select(
        "doc_id", F.when(F.col("quality") == 1, "positive").otherwise("negative").alias("original_sentiment"))
    labelled = docs.join(labels, "doc_id")
    model = train_sentiment_model(labelled.withColumnRenamed("original_sentiment", "sentiment"))
    return sentiment.confusion_counts(model.transform(labelled))


def q_to_wire(spark, sf_dir):
    return to_wire(raw_view(spark, sf_dir, "posts"))


def _wire_files(spark, sf_dir, name):
    base = scratch_path(spark, name)
    write_chunks(to_wire(raw_view(spark, sf_dir, "posts")), f"{base}/in", chunk_size=1000)
    return base


def q_stream_posts(spark, sf_dir):
    """``availableNow`` file stream over the wire chunks of the posts view."""
    base = _wire_files(spark, sf_dir, "stream-posts")
    q = start_stream(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt",
                     trigger="available_now", max_files_per_trigger=4)
    q.awaitTermination()
    return _streamed(spark, base)


def _streamed(spark, base):
    """What a stream wrote; ``stamped``: its processing time is one of this hour's."""
    out = spark.read.schema(STREAM_OUT).json(f"{base}/out")
    age = F.unix_timestamp(F.current_timestamp()) - F.unix_timestamp("processing_time")
    return out.select("id", "text", F.array_join("hashtags", " ").alias("hashtags"), "sentiment", age.between(0, 3600).alias("stamped"))


def q_stream_once(spark, sf_dir):
    """Every post is sent twice, the second time in other files and batches; it counts once (by event time, none late)."""
    base = scratch_path(spark, "stream-once")
    wire = materialize(to_wire(raw_view(spark, sf_dir, "posts")), "wire")  # made once for both sendings
    for order in ("id", "text"):
        write_chunks(wire, f"{base}/in", chunk_size=1000, order_by=(order,))
    start_stream(spark, f"{base}/in", f"{base}/out", f"{base}/ckpt", trigger="available_now",
                 max_files_per_trigger=64, dedupe_within="20000 days").awaitTermination()
    return _streamed(spark, base)


def _restarted(spark, sf_dir, start):
    """Two ``availableNow`` runs on one checkpoint, the second half of the files arriving between them."""
    base = scratch_path(spark, "stream-restart")
    wire = materialize(to_wire(raw_view(spark, sf_dir, "posts")), "wire")  # made once for both halves
    half = F.pmod(F.xxhash64("id"), F.lit(2))
    for part in (0, 1):
        write_chunks(wire.where(half == part), f"{base}/in", chunk_size=1000)
        start(base).awaitTermination()
    return base


def q_stream_restart_posts(spark, sf_dir):
    base = _restarted(spark, sf_dir, lambda b: start_stream(spark, f"{b}/in", f"{b}/out", f"{b}/ckpt", trigger="available_now"))
    return _streamed(spark, base)


def _restarted_graph(spark, sf_dir):
    base = _restarted(spark, sf_dir, lambda b: start_graph_stream(
        spark, f"{b}/in", f"{b}/state", f"{b}/ckpt", trigger="available_now", max_files_per_trigger=4))
    compact(spark, f"{base}/state")
    return f"{base}/state"


def q_stream_restart_vertices(spark, sf_dir):
    return live_vertices(spark, _restarted_graph(spark, sf_dir))


def q_stream_restart_edges(spark, sf_dir):
    return live_edges(spark, _restarted_graph(spark, sf_dir))


def _stream_graph(spark, sf_dir):
    base = _wire_files(spark, sf_dir, "stream-graph")
    q = start_graph_stream(spark, f"{base}/in", f"{base}/state", f"{base}/ckpt",
                           trigger="available_now", max_files_per_trigger=16)
    q.awaitTermination()
    return f"{base}/state"


def q_stream_graph_vertices(spark, sf_dir):
    return live_vertices(spark, _stream_graph(spark, sf_dir))


def q_stream_graph_edges(spark, sf_dir):
    return live_edges(spark, _stream_graph(spark, sf_dir))


def q_doc_graph_summary(spark, sf_dir):
    return graph.graph_summary(*_graph(spark, sf_dir, "doc_posts"))


def q_doc_pair_totals(spark, sf_dir):
    """Pairs and self-loops of whole documents, every word a tag, in closed form."""
    return graph.pair_totals(scored_view(spark, sf_dir, "doc_posts"))


def q_doc_top_vertices(spark, sf_dir):
    v = graph.vertices(_tagged(spark, sf_dir, "doc_posts"))
    return views.top_vertices(v, TOP_N)


QUERIES: dict[str, Query] = {
    "load_parquet_normalized": q_load_normalized,
    "hash_sample": q_hash_sample,
    "sample_bernoulli": q_sample_bernoulli,
    "limit_ordered": q_limit_ordered,
    "hashtags_extract": q_hashtags_extract,
    "hashtags_distinct": q_hashtags_distinct,
    "turn_hashtags": q_turn_hashtags,
    "created_at_parse": q_created_at_parse,
    "created_at_constant": q_created_at_constant,
    "date_strip_zone": q_date_strip_zone,
    "sentiment_label": q_sentiment_label,
    "sentiment_from_text": q_sentiment_from_text,
    "sentiment_distribution": q_sentiment_distribution,
    "confusion_counts": q_confusion_counts,
    "has_hashtags_vs_tags": q_has_hashtags_vs_tags,
    "pages_has_hashtags": q_pages_has_hashtags,
    "text_shrink": q_text_shrink,
    "token_counts": q_token_counts,
    "tag_counts": q_tag_counts,
    "tag_sentiment_counts": q_tag_sentiment_counts,
    "dominant_sentiment": q_dominant_sentiment,
    "vertices": q_vertices,
    "vertices_general": q_vertices_general,
    "pairs": q_pairs,
    "edges": q_edges,
    "edges_by_multiplicity": q_edges_by_multiplicity,
    "graph_summary": q_graph_summary,
    "top_vertices": q_top_vertices,
    "top_subgraph_nodes": q_top_subgraph_nodes,
    "top_subgraph_edges": _top_edges("posts"),
    "top_bar": q_top_bar,
    "vertex_sentiment_split": q_vertex_sentiment_split,
    "degree_centrality": _centrality("posts"),
    "pagerank_5": _pagerank("posts"),
    "turn_vertices": q_turn_vertices,
    "turn_edges": q_turn_edges,
    "turn_graph_summary": q_turn_graph_summary,
    "turn_top_subgraph_edges": _top_edges("turn_posts"),
    "turn_degree_centrality": _centrality("turn_posts"),
    "turn_pagerank_5": _pagerank("turn_posts"),
    "graph_roundtrip_edges": q_graph_roundtrip_edges,
    "token_spans": q_token_spans,
    "sentiment_model": q_sentiment_model,
    "model_confusion": q_model_confusion,
    "token_weights": q_token_weights,
    "weights_sentiment": q_weights_sentiment,
    "heldout_confusion": q_heldout_confusion,
    "heldout_calibration": q_heldout_calibration,
    "to_wire": q_to_wire,
    "stream_posts": q_stream_posts,
    "stream_graph_vertices": q_stream_graph_vertices,
    "stream_graph_edges": q_stream_graph_edges,
    "load_csv": q_load_csv,
    "load_csv_latin1": q_load_csv_latin1,
    "load_rejects": q_load_rejects,
    "created_at_zones": q_created_at_zones,
    "slider_nodes": q_slider_nodes,
    "slider_edges": q_slider_edges,
    "turn_slider_edges": q_turn_slider_edges,
    "graph_json_vertices": q_graph_json_vertices,
    "graph_json_edges": q_graph_json_edges,
    "chunk_sequence": q_chunk_sequence,
    "stream_once": q_stream_once,
    "load_dropmalformed": q_load_dropmalformed,
    "load_json": q_load_json,
    "load_sampled": q_load_sampled,
    "hash_sample_edges": q_hash_sample_edges,
    "label_by_value": q_label_by_value,
    "posts_with_hashtags": q_posts_with_hashtags,
    "graph_roundtrip_vertices": q_graph_roundtrip_vertices,
    "batch_counts": q_batch_counts,
    "batch_edges": q_batch_edges,
    "pagerank_tol": q_pagerank_tol,
    "finisher": q_finisher,
    "model_invariants": q_model_invariants,
    "stream_restart_posts": q_stream_restart_posts,
    "stream_restart_vertices": q_stream_restart_vertices,
    "stream_restart_edges": q_stream_restart_edges,
    "doc_pair_totals": q_doc_pair_totals,
    # whole documents, every word a tag: the heaviest queries, kept last
    "doc_graph_summary": q_doc_graph_summary,
    "doc_top_vertices": q_doc_top_vertices,
}
