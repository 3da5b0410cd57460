"""Images in bounded chunks as a stream, each chunk durable before the next."""

from .extract import stream_extract, stream_summary

__all__ = ["stream_extract", "stream_summary"]
