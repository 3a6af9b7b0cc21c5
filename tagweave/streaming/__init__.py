"""Structured Streaming: wire format, event time, file stream, live graph."""

from .event_time import once_each, windowed_tag_counts
from .files import read_wire_stream, start_stream
from .live_graph import compact, live_edges, live_vertices, start_graph_stream, write_deltas
from .wire import decode_wire, event_time, to_wire

__all__ = ["read_wire_stream", "start_stream", "live_edges", "live_vertices",
           "start_graph_stream", "write_deltas", "compact", "decode_wire", "event_time", "to_wire", "once_each", "windowed_tag_counts"]
