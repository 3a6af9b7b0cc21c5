"""Sources: post loaders, saved-graph reader, fixture views."""

from .graph_files import read_graph
from .posts import hash_sample, load_posts, load_posts_and_rejects, normalize_posts, read_raw, read_records

__all__ = ["read_graph", "hash_sample", "load_posts", "load_posts_and_rejects", "normalize_posts", "read_raw", "read_records"]
