"""Column-level functions (built-in Spark expressions only)."""

from .dates import constant_created_at, parse_post_date, strip_zone
from .labels import (edge_width, label_to_sentiment, node_size,
                     normalize_sentiment, sentiment_color, sentiment_from_text)
from .text import (display_label, distinct_hashtags, has_hash, hashtags,
                   shrink, tags_from_json, tags_to_json, text_or_empty, tokens,
                   words_as_tags)

__all__ = [
    "constant_created_at", "parse_post_date", "strip_zone", "edge_width",
    "label_to_sentiment", "node_size", "normalize_sentiment", "sentiment_color",
    "sentiment_from_text", "display_label", "distinct_hashtags", "has_hash",
    "hashtags", "shrink", "tags_from_json", "tags_to_json", "text_or_empty",
    "tokens", "words_as_tags",
]
