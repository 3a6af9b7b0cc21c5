"""Post-shaped views derived from the driver's test tables.

Three views, each over whole tables and whole texts:

* ``posts`` -- one post per order. Text = the brands (``Brand#NN``) of the
  order's parts joined by a blank, in line order, so the hashtags are the
  brand numbers: a small vocabulary with many repeats and self-loops. An
  order without lines has null text. Label from the order status
  (F -> 0, O -> 4, else 2); date = order date as ``EEE MMM dd HH:mm:ss UTC yyyy``.
* ``turn_posts`` -- one post per conversation turn; every word of the whole
  turn becomes a hashtag (large Unicode vocabulary, skewed word counts).
  Label by role (user -> 0, assistant -> 4, else 2): plumbing only.
* ``doc_posts`` -- one post per document, every word of the whole document a
  hashtag (up to thousands of distinct tags in one row: the hot-row case).
  Label from ``labels.quality`` (0 -> 0, 1 -> 4, unlabelled -> null).

``oracle_views`` holds the same derivations in DuckDB SQL.
"""

from __future__ import annotations

from pyspark.sql import DataFrame, SparkSession
from pyspark.sql import functions as F

from ..functions.text import words_as_tags
from ..operators.sentiment import with_sentiment
from .posts import normalize_posts


def read_table(spark: SparkSession, sf_dir: str, name: str) -> DataFrame:
    return spark.read.parquet(f"{sf_dir.rstrip('/')}/{name}.parquet")


def posts_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    orders = read_table(spark, sf_dir, "orders")
    lines = read_table(spark, sf_dir, "lineitem").select("l_orderkey", "l_partkey", "l_linenumber")
    part = read_table(spark, sf_dir, "part").select("p_partkey", "p_brand")
    brands = (lines.join(part, lines["l_partkey"] == part["p_partkey"])
              .groupBy("l_orderkey")
              .agg(F.array_join(F.transform(
                  F.array_sort(F.collect_list(F.struct("l_linenumber", "l_partkey", "p_brand"))),
                  lambda x: x["p_brand"]), " ").alias("text")))
    status = F.col("o_orderstatus")
    return orders.join(brands, orders["o_orderkey"] == brands["l_orderkey"], "left").select(
        F.when(status == "F", 0).when(status == "O", 4).otherwise(2).alias("sentiment_label"),
        F.col("o_orderkey").cast("string").alias("id"),
        F.date_format("o_orderdate", "EEE MMM dd HH:mm:ss 'UTC' yyyy").alias("date"),
        F.lit("NO_QUERY").alias("query"),
        F.concat(F.lit("c"), F.col("o_custkey").cast("string")).alias("user"),
        F.col("text"))


def turn_posts_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    conv = read_table(spark, sf_dir, "conversations")
    role = F.col("role")
    return conv.select(
        F.when(role == "user", 0).when(role == "assistant", 4).otherwise(2).alias("sentiment_label"),
        F.concat_ws("-", F.col("conv_id").cast("string"), F.col("turn").cast("string")).alias("id"),
        F.lit(None).cast("string").alias("date"),
        F.lit("NO_QUERY").alias("query"),
        role.alias("user"),
        words_as_tags("text").alias("text"))


def doc_posts_raw(spark: SparkSession, sf_dir: str) -> DataFrame:
    docs = read_table(spark, sf_dir, "documents").select("doc_id", "text", "source")
    labels = read_table(spark, sf_dir, "labels").select("doc_id", "quality")
    q = F.col("quality")
    return docs.join(labels, "doc_id", "left").select(
        F.when(q == 0, 0).when(q == 1, 4).alias("sentiment_label"),
        F.col("doc_id").cast("string").alias("id"),
        F.lit(None).cast("string").alias("date"),
        F.lit("NO_QUERY").alias("query"),
        F.col("source").alias("user"),
        words_as_tags("text").alias("text"))


RAW_VIEWS = {"posts": posts_raw, "turn_posts": turn_posts_raw, "doc_posts": doc_posts_raw}


def raw_view(spark: SparkSession, sf_dir: str, name: str = "posts") -> DataFrame:
    return RAW_VIEWS[name](spark, sf_dir)


def scored_view(spark: SparkSession, sf_dir: str, name: str = "posts") -> DataFrame:
    """Normalised posts with label-mode sentiment."""
    return with_sentiment(normalize_posts(raw_view(spark, sf_dir, name)))


# --- the same views for DuckDB (oracle) --------------------------------------

_TAG = r"#([\p{L}\p{N}_]+)"
_WORD = r"[\p{L}\p{N}_]+"

ORACLE_RAW = {
    "posts": """
  SELECT CASE o.o_orderstatus WHEN 'F' THEN 0 WHEN 'O' THEN 4 ELSE 2 END AS sentiment_label,
         CAST(o.o_orderkey AS VARCHAR) AS id,
         strftime(o.o_orderdate, '%a %b %d %H:%M:%S UTC %Y') AS date,
         'NO_QUERY' AS query,
         'c' || CAST(o.o_custkey AS VARCHAR) AS "user",
         b.text AS text
  FROM orders o LEFT JOIN (
    SELECT l.l_orderkey, string_agg(p.p_brand, ' ' ORDER BY l.l_linenumber, l.l_partkey) AS text
    FROM lineitem l JOIN part p ON l.l_partkey = p.p_partkey
    GROUP BY l.l_orderkey) b ON o.o_orderkey = b.l_orderkey""",
    "turn_posts": f"""
  SELECT CASE role WHEN 'user' THEN 0 WHEN 'assistant' THEN 4 ELSE 2 END AS sentiment_label,
         CAST(conv_id AS VARCHAR) || '-' || CAST(turn AS VARCHAR) AS id,
         CAST(NULL AS VARCHAR) AS date, 'NO_QUERY' AS query, role AS "user",
         regexp_replace(text, '{_WORD}', '#\\0', 'g') AS text
  FROM conversations""",
    "doc_posts": f"""
  SELECT CASE WHEN l.quality = 0 THEN 0 WHEN l.quality = 1 THEN 4 END AS sentiment_label,
         CAST(d.doc_id AS VARCHAR) AS id,
         CAST(NULL AS VARCHAR) AS date, 'NO_QUERY' AS query, d.source AS "user",
         regexp_replace(d.text, '{_WORD}', '#\\0', 'g') AS text
  FROM documents d LEFT JOIN labels l ON d.doc_id = l.doc_id""",
}


def oracle_scored(name: str) -> str:
    """CTE body of the normalised, label-scored view ``name`` in DuckDB SQL."""
    return f"""
  SELECT id, text,
         regexp_extract_all(lower(coalesce(text, '')), '{_TAG}', 1) AS hashtags,
         CASE TRY_CAST(sentiment_label AS INTEGER) WHEN 0 THEN 'negative'
              WHEN 4 THEN 'positive' ELSE 'neutral' END AS original_sentiment,
         CASE TRY_CAST(sentiment_label AS INTEGER) WHEN 0 THEN 'negative'
              WHEN 4 THEN 'positive' ELSE 'neutral' END AS sentiment,
         coalesce(contains(text, '#'), false) AS has_hashtags,
         date
  FROM ({ORACLE_RAW[name]}) raw_rows"""
