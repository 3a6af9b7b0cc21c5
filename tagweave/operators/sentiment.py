"""Post sentiment: from the data's own labels, or from a trained model."""

from __future__ import annotations

from pyspark.sql import DataFrame, Window
from pyspark.sql import functions as F

from ..functions.labels import normalize_sentiment
from .weights import score_by_weights


def with_sentiment(posts: DataFrame, mode: str = "label", model=None) -> DataFrame:
    """Add ``sentiment`` (positive / negative / neutral) to normalised posts.

    ``mode="label"`` copies ``original_sentiment``; ``mode="model"`` scores the
    text with a fitted :class:`tagweave.operators.model.SentimentModel`; ``mode="weights"`` scores it by a
    table of token weights (see :mod:`tagweave.operators.weights`; ids identify posts). The
    choice is explicit and errors are raised: no silent fall-back.
    """
    if mode == "label":
        return posts.withColumn("sentiment", normalize_sentiment("original_sentiment"))
    if mode == "model":
        if model is None:
            raise ValueError("mode='model' needs a fitted SentimentModel")
        return model.transform(posts)
    if mode == "weights":
        if model is None:
            raise ValueError("mode='weights' needs a table of token weights")
        scored = score_by_weights(posts, model).select(F.col("id").alias("_id"), "sentiment")
        return posts.drop("sentiment").join(scored, F.col("id").eqNullSafe(F.col("_id"))).drop("_id")
    raise ValueError(f"Unknown sentiment mode: {mode}")


def sentiment_distribution(posts: DataFrame, column: str = "sentiment") -> DataFrame:
    """``(sentiment, count, pct)``; pct = 100 * count / total, rounded to 4 places.

    The total is a window over the grouped result (a handful of rows), not
    over the posts.
    """
    counts = posts.groupBy(F.col(column).alias("sentiment")).agg(F.count(F.lit(1)).alias("count"))
    total = F.sum("count").over(Window.partitionBy())
    return counts.select("sentiment", "count",
                         F.round(F.lit(100.0) * F.col("count") / total, 4).alias("pct"))


def confusion_counts(posts: DataFrame) -> DataFrame:
    """``(original_sentiment, sentiment, n)``: agreement of labels and predictions."""
    return (posts.groupBy("original_sentiment", "sentiment")
            .agg(F.count(F.lit(1)).alias("n")))
