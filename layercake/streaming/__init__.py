"""Structured Streaming variants of the layer flows."""

from .silver import bronze_stream, stream_silver

__all__ = ["bronze_stream", "stream_silver"]
