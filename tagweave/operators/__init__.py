"""DataFrame -> DataFrame operators."""

from .centrality import degree_centrality, pagerank
from .graph import (build_graph, dominant_sentiment, edges, graph_summary,
                    pair_occurrences, post_pairs, tag_counts, tag_occurrences,
                    tag_sentiment_counts, vertices)
from .sentiment import confusion_counts, sentiment_distribution, with_sentiment
from .views import (subgraph_elements, top_bar, top_subgraph, top_subgraph_edges,
                    top_subgraph_nodes, top_vertices, vertex_sentiment_split)

__all__ = [
    "degree_centrality", "pagerank", "build_graph", "dominant_sentiment", "edges",
    "graph_summary", "pair_occurrences", "post_pairs", "tag_counts", "tag_occurrences",
    "tag_sentiment_counts", "vertices", "confusion_counts", "sentiment_distribution",
    "with_sentiment", "subgraph_elements", "top_bar", "top_subgraph",
    "top_subgraph_edges", "top_subgraph_nodes", "top_vertices", "vertex_sentiment_split",
]
