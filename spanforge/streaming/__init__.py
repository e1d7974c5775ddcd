"""Structured Streaming entry points for the stateless operators."""

from .labels import label_stream, start_label_sink

__all__ = ["label_stream", "start_label_sink"]
