"""Streaming: the stateless melt on streaming frames, with a file sink."""

from cellfold.streaming.melt import start_key_value_stream, stream_key_value

__all__ = ["start_key_value_stream", "stream_key_value"]
