"""Incremental runs over the Bronze landing with Structured Streaming."""

from hirelake.streaming.incremental import incremental_pipeline

__all__ = ["incremental_pipeline"]
