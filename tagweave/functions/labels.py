"""Sentiment labels and their display colours."""

from __future__ import annotations

from pyspark.sql import Column
from pyspark.sql import functions as F

from ._util import as_col

# Label codes of the post data set and the display colours.
NEGATIVE_CODE = 0
POSITIVE_CODE = 4
COLORS = {"positive": "#4CAF50", "negative": "#F44336", "neutral": "#9E9E9E"}
DEFAULT_COLOR = "#9E9E9E"
EDGE_COLOR = "#666"


def label_to_sentiment(label) -> Column:
    """0 -> negative, 4 -> positive, anything else (null, junk) -> neutral.

    Labels compare by value: ``"4.0"`` is positive, 0.5 is neutral. ``try_cast``
    keeps a junk label from raising under ANSI mode.
    """
    code = as_col(label).try_cast("double")
    return (F.when(code == NEGATIVE_CODE, "negative")
            .when(code == POSITIVE_CODE, "positive")
            .otherwise("neutral"))


def normalize_sentiment(s) -> Column:
    """Keep positive / negative, everything else becomes neutral."""
    c = as_col(s)
    return (F.when(c == "positive", "positive")
            .when(c == "negative", "negative")
            .otherwise("neutral"))


def sentiment_from_text(s) -> Column:
    """Free-form classifier output: contains 'positive' wins, then 'negative'."""
    c = as_col(s)
    return (F.when(c.contains("positive"), "positive")
            .when(c.contains("negative"), "negative")
            .otherwise("neutral"))


def sentiment_color(s) -> Column:
    c = as_col(s)
    expr = F.when(c == "positive", COLORS["positive"])
    expr = expr.when(c == "negative", COLORS["negative"])
    expr = expr.when(c == "neutral", COLORS["neutral"])
    return expr.otherwise(DEFAULT_COLOR)


def node_size(degree) -> Column:
    """Node size: twice the degree, clamped to [20, 80]."""
    return F.greatest(F.lit(20), F.least(F.lit(80), as_col(degree) * 2))


def edge_width(weight) -> Column:
    """Edge width: half the weight (true division), clamped to [1, 10]."""
    return F.greatest(F.lit(1.0), F.least(F.lit(10.0), as_col(weight) / 2.0))
