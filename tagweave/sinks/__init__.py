"""Sinks: graph directories, JSON documents (complete, or the top-N excerpt), chunked post files."""

from .graph import (export_graph_json, export_top_json, json_array_document, read_json_document, write_chunks,
                    write_graph, write_json_document)

__all__ = ["export_graph_json", "export_top_json", "json_array_document", "read_json_document", "write_chunks",
           "write_graph", "write_json_document"]
