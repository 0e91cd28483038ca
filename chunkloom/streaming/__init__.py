"""Structured Streaming over arriving files."""

from chunkloom.streaming.index_stream import read_file_stream, read_stream_index, stream_index

__all__ = ["read_file_stream", "read_stream_index", "stream_index"]
